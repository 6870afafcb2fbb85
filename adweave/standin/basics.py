"""Scans, scalar expressions, predicates and date windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions import calendar as C
from adweave.functions import scalars as X
from adweave.operators import attach as A
from adweave.operators import dedupe as D
from adweave.operators import rollup as R
from adweave.sources import payloads as P
from adweave.sources.warehouse import existing_between, included_accounts
from adweave.standin import frames as T
from adweave.standin.catalog import query


@query("account_scan", f"""
select ad_account_id, ad_account_name, ad_account_client, ad_account_brand, ad_account_timezone
from ({T.ACCOUNT}) a where ad_account_include_ind = 'YES'
""")
def account_scan(spark, sf):
    return included_accounts(T.frame(spark, sf, T.ACCOUNT))


_RAW_AD = """
select cast(o_orderkey as string) as id, cast(o_custkey as string) as ad_squad_id,
       'ad ' || cast(o_orderkey as string) as name, o_orderstatus as status,
       o_orderpriority as type, cast(o_orderdate as date) as created_at from orders
"""


@query("entity_rename", f"""
select id as ad_id, ad_squad_id, name as ad_name, status as ad_status, type as ad_type,
       created_at as ad_created_at, 'LIFETIME' as granularity from ({_RAW_AD}) o
""")
def entity_rename(spark, sf):
    raw = T.frame(spark, sf, _RAW_AD).withColumnsRenamed(S.entity_renames("ad"))
    return raw.withColumn("granularity", F.lit(S.LIFETIME))


@query("entity_union", """
select c_name as name, c_nationkey as nation, c_mktsegment as segment,
       cast(null as bigint) as supplier_key from customer
union all
select s_name, s_nationkey, null, s_suppkey from supplier
""")
def entity_union(spark, sf):
    t = T.tables(spark, sf)
    c = t["customer"].select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                             F.col("c_mktsegment").alias("segment"))
    s = t["supplier"].select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
                             F.col("s_suppkey").alias("supplier_key"))
    return A.stack_frames([c, s])


_ISO = """
select cast(o_orderkey as string) as ad_id,
       cast(cast(o_orderdate as date) as string) || 'T13:45:00.123Z' as stamp from orders
"""


@query("date_reformat", """
select cast(o_orderkey as string) as ad_id, cast(o_orderdate as date) as created_day,
       cast(o_orderdate as date) as stats_day, cast(o_orderdate as date) as reread_day,
       strftime(o_orderdate, '%m/%d/%Y') || ' 0:00' as created_text from orders
""")
def date_reformat(spark, sf):
    day = X.entity_day(F.col("stamp"))
    rows = T.frame(spark, sf, _ISO).select(
        "ad_id", day.alias("created_day"), X.iso_day(F.col("stamp")).alias("stats_day"),
        X.extract_day_text(day).alias("created_text"))
    return rows.withColumn("reread_day", X.entity_day(F.col("created_text")))


_ZONED_ADS = f"""
select a.ad_id, a.ad_created_at, t.ad_account_timezone as timezone
from ({T.AD}) a join ({T.AD_SQUAD}) s on a.ad_squad_id = s.ad_squad_id
join ({T.CAMPAIGN}) c on s.campaign_id = c.campaign_id
join ({T.ACCOUNT}) t on c.ad_account_id = t.ad_account_id
"""


def _utc_sql(day: str) -> str:
    ts = f"((cast({day} as timestamp) at time zone timezone) at time zone 'UTC')"
    return f"strftime({ts}, '%Y-%m-%dT') || hour({ts}) || strftime({ts}, ':%M:%S.000-00:00')"


@query("utc_bounds", f"""
select ad_id, {_utc_sql('ad_created_at')} as start_time from ({_ZONED_ADS}) z
""")
def utc_bounds(spark, sf):
    return T.frame(spark, sf, _ZONED_ADS).select(
        "ad_id", C.utc_bound(F.col("ad_created_at"), F.col("timezone")).alias("start_time"))


@query("metric_clean", f"""
select ad_id, stats_date, impressions, swipes, quartile_1, quartile_2, quartile_3,
       view_time_millis, cast(frequency as double) as frequency,
       cast(swipe_up_percent as double) as swipe_up_percent from ({T.DAY_RAW}) d
""")
def metric_clean(spark, sf):
    counts = ["impressions", "swipes", "quartile_1", "quartile_2", "quartile_3",
              "view_time_millis"]
    return T.readable(T.frame(spark, sf, T.DAY_TEXT).select(
        "ad_id", X.iso_day(F.col("adstats_date")).alias("stats_date"),
        *[X.count_metric(F.col(c)).alias(c) for c in counts],
        *[X.ratio_metric(F.col(c)).alias(c) for c in ("frequency", "swipe_up_percent")]))


_FLAGS = """
select cast(c_custkey as string) as ad_squad_id,
       case c_mktsegment when 'BUILDING' then 'True' when 'MACHINERY' then 'False'
                         when 'FURNITURE' then '' when 'HOUSEHOLD' then 'true' end as auto_bid
from customer
"""


@query("flag_text", """
select cast(c_custkey as string) as ad_squad_id,
       case when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then 'TRUE' else 'FALSE' end as auto_bid
from customer
""")
def flag_text(spark, sf):
    return T.frame(spark, sf, _FLAGS).withColumn("auto_bid", X.flag_text(F.col("auto_bid")))


_END_TEXT = """
select cast(o_orderkey as string) as ad_id,
       case o_orderstatus when 'P' then ' ' when 'F' then ''
                          else cast(cast(o_orderdate as date) as string) end as end_time
from orders
"""


@query("blank_end_null", f"""
select ad_id, nullif(trim(end_time), '') as end_time, try_cast(end_time as date) as end_day
from ({_END_TEXT}) e
""")
def blank_end_null(spark, sf):
    return T.frame(spark, sf, _END_TEXT).select(
        "ad_id", X.blank_to_null(F.col("end_time")).alias("end_time"),
        X.entity_day(X.blank_to_null(F.col("end_time"))).alias("end_day"))


@query("surrogate_keys", f"""
select ad_id, stats_date, ad_id || strftime(stats_date, '%Y-%m-%d') || 'DAY' as day_key,
       ad_id || '2001-12-31LIFETIME' as lifetime_key,
       ad_id || strftime(stats_date, '%Y-%m-01') || 'MONTH' as month_key,
       ad_id || 'dma ' || cast(saves as string) || '2001-12-31LIFETIME' as geo_key
from ({T.DAY_RAW}) d
""")
def surrogate_keys(spark, sf):
    ad, day, run = F.col("ad_id"), F.col("stats_date"), F.lit(dt.date(2001, 12, 31))
    dma = F.concat(F.lit("dma "), F.col("saves").cast("string"))
    return T.frame(spark, sf, T.DAY_RAW).select(
        "ad_id", "stats_date", X.stats_key(ad, day, S.DAY).alias("day_key"),
        X.stats_key(ad, run, S.LIFETIME).alias("lifetime_key"),
        X.stats_key(ad, C.month_first(day), S.MONTH).alias("month_key"),
        X.geo_key(ad, dma, run).alias("geo_key"))


_BLANK_KEYS = """
select case o_orderpriority when '1-URGENT' then '' when '2-HIGH' then ' '
                            when '3-MEDIUM' then '  ' when '5-LOW' then null
                            else cast(o_orderkey as string) end as ad_id,
       o_orderpriority as ad_type from orders
"""


@query("nonblank_keys", f"select ad_id, ad_type from ({_BLANK_KEYS}) k where ad_id > ' '")
def nonblank_keys(spark, sf):
    return T.frame(spark, sf, _BLANK_KEYS).where(X.nonblank(F.col("ad_id")))


@query("activity_gate", f"""
select ad_id, stats_date, impressions, spend, video_views from ({T.DAY_RAW}) d where {T.ACTIVE}
""")
def activity_gate(spark, sf):
    return T.frame(spark, sf, T.DAY_RAW).where(X.has_activity()).select(
        "ad_id", "stats_date", *S.GATE_METRICS)


_RETURNED = """
select cast(l_orderkey as string) as ad_id, cast(l_shipdate as date) as stats_date
from lineitem where l_shipdate >= timestamp '1998-02-10 00:00:00'
                and l_shipdate < timestamp '1998-05-20 00:00:00' and l_returnflag = 'R'
"""
_FACTS = f"select *, 'DAY' as granularity, {'substr(cast(stats_date as string), 1, 7)'} " \
         f"as stats_month from ({T.DAY_RAW}) f"


@query("stats_range", f"""
with incoming as ({_RETURNED})
select ad_id, stats_date, granularity, impressions, spend from ({_FACTS}) f
where granularity = 'DAY' and stats_date between (select min(stats_date) from incoming)
                                             and (select max(stats_date) from incoming)
""")
def stats_range(spark, sf):
    facts, incoming = T.frame(spark, sf, _FACTS), T.frame(spark, sf, _RETURNED)
    return existing_between(facts, incoming).select(
        "ad_id", "stats_date", "granularity", "impressions", "spend")


_RESPONSES = """
select cast(null as string) as account_id, cast(event_id as string) as ad_id,
       cast(null as date) as window_start,
       case event_type when 'error' then 500 when 'signup' then 401 else 200 end as status,
       case event_type when 'view' then 'oops'
            else '{"lifetime_stats":[{"lifetime_stat":{"stats":{"spend":1}}}]}' end as body
from events
"""


@query("response_triage", """
select cast(event_id as string) as ad_id,
       case event_type when 'error' then 'status 500' when 'signup' then 'status 401'
                       when 'view' then 'no payload' end as reject_reason
from events
""")
def response_triage(spark, sf):
    return P.triage(T.frame(spark, sf, _RESPONSES), "lifetime").select("ad_id", "reject_reason")


@query("ad_timezone", f"select ad_id, timezone from ({_ZONED_ADS}) z")
def ad_timezone(spark, sf):
    owner = T.frame(spark, sf, f"""
        select a.ad_id, c.ad_account_id from ({T.AD}) a
        join ({T.AD_SQUAD}) s on a.ad_squad_id = s.ad_squad_id
        join ({T.CAMPAIGN}) c on s.campaign_id = c.campaign_id""")
    accounts = T.frame(spark, sf, T.ACCOUNT).withColumnRenamed("ad_account_timezone", "timezone")
    return A.inherit(owner, accounts).select("ad_id", "timezone")


# --- date windows, all driven by the dates in the tables -----------------------------

@query("window_trailing", """
select cast(o_orderkey as string) as ad_id, cast(o_orderdate as date) - 30 as window_start,
       cast(o_orderdate as date) as window_end from orders
""")
def window_trailing(spark, sf):
    return T.frame(spark, sf, T.AD).select(
        "ad_id", C.trailing_window(F.col("ad_created_at")).alias("w")).select("ad_id", "w.*")


_TILES = f"""
select ad_id, timezone, cast(s as date) as window_start,
       least(cast(s as date) + 30, make_date(year(ad_created_at), 12, 31)) as window_end
from (select *, unnest(generate_series(cast(date_trunc('year', ad_created_at) as timestamp),
             cast(make_date(year(ad_created_at), 12, 30) as timestamp), interval 30 day)) as s
      from ({_ZONED_ADS}) z) t
"""


@query("window_tiles", f"select ad_id, window_start, window_end from ({_TILES}) w")
def window_tiles(spark, sf):
    year = F.year("ad_created_at")
    tiles = C.window_tiles(F.make_date(year, F.lit(1), F.lit(1)),
                           F.make_date(year, F.lit(12), F.lit(31)))
    return T.frame(spark, sf, T.AD).select("ad_id", F.explode(tiles).alias("w")) \
        .select("ad_id", "w.*")


@query("request_plan", f"""
select ad_id, window_start, window_end, {_utc_sql('window_start')} as start_time,
       {_utc_sql('window_end')} as end_time from ({_TILES}) w
""")
def request_plan(spark, sf):
    year = F.year("ad_created_at")
    tiles = C.window_tiles(F.make_date(year, F.lit(1), F.lit(1)),
                           F.make_date(year, F.lit(12), F.lit(31)))
    return C.request_plan(T.frame(spark, sf, _ZONED_ADS), tiles)


@query("month_bounds", f"""
select ad_id, cast(date_trunc('month', ad_created_at) as date) as month_start,
       last_day(ad_created_at) as month_end from ({T.AD}) a
""")
def month_bounds(spark, sf):
    return T.frame(spark, sf, T.AD).select(
        "ad_id", C.month_bounds(F.col("ad_created_at")).alias("m")).select("ad_id", "m.*")


@query("month_list", f"""
select ad_id, cast(m as date) as month_start, last_day(cast(m as date)) as month_end
from (select ad_id, unnest(generate_series(
          cast(date_trunc('month', min(stats_date)) as timestamp),
          cast(date_trunc('month', max(stats_date)) as timestamp), interval 1 month)) as m
      from ({T.DAY_RAW}) d group by ad_id) x
""")
def month_list(spark, sf):
    spans = T.frame(spark, sf, T.DAY_RAW).groupBy("ad_id").agg(
        F.min("stats_date").alias("a"), F.max("stats_date").alias("b"))
    return spans.select("ad_id", F.explode(C.months_between(F.col("a"), F.col("b"))).alias("m")) \
        .select("ad_id", "m.*")


# --- one row per key, distinct -------------------------------------------------------

@query("dedupe_key", f"""
select ad_id, stats_date, {', '.join(m for m in S.COUNT_METRICS)} from ({T.DAY}) d
""")
def dedupe_key(spark, sf):
    raw = T.frame(spark, sf, T.DAY_RAW)
    return D.latest_per_key(raw, ["ad_id", "stats_date"], S.STATS_METRICS).select(
        "ad_id", "stats_date", *S.COUNT_METRICS)


@query("distinct_ids", "select distinct cast(l_orderkey as string) as ad_id from lineitem")
def distinct_ids(spark, sf):
    return D.distinct_ids(T.frame(spark, sf, T.DAY_RAW), "ad_id")


@query("distinct_rows", """
select distinct cast(c_nationkey as string) as campaign_id, c_mktsegment as ad_squad_status
from customer
""")
def distinct_rows(spark, sf):
    return D.distinct_rows(T.frame(spark, sf, T.AD_SQUAD).select("campaign_id",
                                                                 "ad_squad_status"))


# --- roll-up -------------------------------------------------------------------------

MONTH_SQL = f"""
select ad_id, cast(date_trunc('month', stats_date) as date) as month_start,
       {', '.join(f'cast(sum({m}) as bigint) as {m}' for m in S.ROLLUP_METRICS
                  if m != 'frequency')}, sum(frequency) as frequency
from ({T.DAY_GATED}) d group by 1, 2
"""


@query("month_rollup", f"""
select * replace (round(frequency, 4) as frequency) from ({MONTH_SQL}) m
""")
def month_rollup(spark, sf):
    """DAY text -> clean -> one per (ad, day) -> gate -> month sums."""
    from adweave.sources.extract import day_rows

    day = day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity())
    return T.readable(R.month_sums(day), {"frequency": 4})


@query("month_is_new", f"""
select a.stats_month, count(m.stats_month) = 0 as is_new
from (select distinct strftime(ad_created_at, '%Y-%m') as stats_month from ({T.AD}) x) a
left join (select stats_month from ({T.DAY}) d) m on a.stats_month = m.stats_month
group by a.stats_month
""")
def month_is_new(spark, sf):
    """For every month an ad was created in: does the table hold no row of it yet?"""
    months = T.frame(spark, sf, T.AD).select(
        X.month_text(F.col("ad_created_at")).alias("stats_month")).distinct()
    loaded = T.frame(spark, sf, T.DAY_RAW).select(
        X.month_text(F.col("stats_date")).alias("stats_month")).distinct() \
        .withColumn("loaded", F.lit(True))
    return months.join(loaded, "stats_month", "left").select(
        "stats_month", F.col("loaded").isNull().alias("is_new"))
