"""Whole jobs: extracts, loads, roll-ups, files and the incremental stream.

Every run works in fresh folders under the session's shared folder.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions import scalars as X
from adweave.operators import attach as A
from adweave.plans import extracts, loads
from adweave.session import fresh_path, staged, state_on_disk
from adweave.sources import extract as E
from adweave.sources.bucketed import BucketedDimension
from adweave.sources.warehouse import Warehouse, account_rows, account_seed, months_of
from adweave.standin import frames as T
from adweave.standin import payloads, upserts
from adweave.standin.catalog import query
from adweave.streaming.dayload import archive_report, archived, ledger_of, load_new_extracts
from adweave.streaming.landed import ads_outer_stats, watch_landing
from adweave.streaming.ordered import load_in_version_order

RUN = upserts.RUN


def _warehouse(spark) -> Warehouse:
    return Warehouse(spark, fresh_path(spark, "warehouse")).create()


def _wide_text(spark, sf, stats_text):
    """Wide extract of the stand-in hierarchy around some DAY text rows."""
    dims = [T.frame(spark, sf, text).drop("created_on", "updated_on")
            for text in (T.CAMPAIGN, T.AD_SQUAD, T.AD)]
    return A.wide_extract(*dims, stats_text)


# --- files ----------------------------------------------------------------------------

# Names with line breaks, quotes, commas, edge blanks and backslashes.
_ODD_NAME = """case cast(ad_id as bigint) % 6 when 0 then 'two' || chr(10) || 'lines'
when 1 then '"quoted", ' || ad_name when 2 then ' edge ' when 3 then 'a' || chr(92) || 'n' || chr(92)
when 4 then chr(13) || chr(10) || chr(92) || chr(92) else ad_name end"""


@query("csv_roundtrip", f"""
with a as (select * replace ({_ODD_NAME} as ad_name) from ({T.AD}) a0),
d as (select cast(l_orderkey as string) as ad_id, case when l_linenumber = 3 then null else
             cast(cast(round(l_discount * 100) as bigint) as string) end as impressions,
             cast(l_linenumber - 1 as string) as video_views from lineitem),
j as (select coalesce(a.ad_id, d.ad_id) as ad_id, a.* exclude (ad_id), d.* exclude (ad_id)
      from a full join d on a.ad_id = d.ad_id),
k as (select coalesce(s.ad_squad_id, j.ad_squad_id) as ad_squad_id, s.campaign_id,
             s.reserved_debug_message, j.* exclude (ad_squad_id)
      from ({T.AD_SQUAD}) s full join j on s.ad_squad_id = j.ad_squad_id)
select coalesce(c.campaign_id, k.campaign_id) as campaign_id, campaign_name, ad_squad_id, ad_id,
       strftime(ad_created_at, '%m/%d/%Y') || ' 0:00' as ad_created_at,
       strftime(ad_updated_at, '%m/%d/%Y') || ' 0:00' as ad_updated_at, ad_name,
       reserved_debug_message, impressions, video_views,
       cast(null as string) as reach_and_frequency_debug_message
from ({T.CAMPAIGN}) c full join k on c.campaign_id = k.campaign_id
""")
def csv_roundtrip(spark, sf):
    """Wide extract written as CSV and read back: every row, whatever its texts hold."""
    path = fresh_path(spark, "extract")
    stats = T.frame(spark, sf, T.DAY_TEXT).withColumn("impressions", F.when(
        F.col("impressions") != "", F.col("impressions").try_cast("double").cast("bigint")
        .cast("string")).otherwise(""))
    dims = [T.frame(spark, sf, text).drop("created_on", "updated_on")
            for text in (T.CAMPAIGN, T.AD_SQUAD, T.AD)]
    dims[2] = dims[2].withColumn("ad_name", F.expr(_ODD_NAME))
    E.write_extract(A.wide_extract(*dims, stats), path)
    return E.read_extract(spark, path).select(
        "campaign_id", "campaign_name", "ad_squad_id", "ad_id", "ad_created_at", "ad_updated_at",
        "ad_name", "reserved_debug_message", "impressions", "video_views",
        "reach_and_frequency_debug_message")


@query("window_files", f"""
select ad_id, cast(date_trunc('month', stats_date) as date) as window_start,
       strftime(stats_date, '%Y-%m-%d') || 'T00:00:00.000-05:00' as adstats_date,
       cast(video_views as string) as video_views from ({T.DAY_RAW}) d
""")
def window_files(spark, sf):
    """Backfill output: one CSV folder per window."""
    path = fresh_path(spark, "windows")
    rows = T.frame(spark, sf, T.DAY_TEXT)
    rows = rows.withColumn("window_start", F.trunc(X.iso_day(F.col("adstats_date")), "month")
                           .cast("string"))
    E.write_extract(rows, path, by_window="window_start")
    return E.read_extract(spark, path).select(
        "ad_id", F.col("window_start").cast("date").alias("window_start"), "adstats_date",
        "video_views")


@query("partition_merge_write", upserts.DAY_SQL)
def partition_merge_write(spark, sf):
    """The DAY upsert against a stored, partitioned table."""
    wh = _warehouse(spark)
    old, new = upserts._day_tables(spark, sf)
    wh.publish("ad_stats", old)
    wh.upsert("day_stats", new)
    return T.readable(wh.facts("ad_stats", S.DAY))


# --- extracts ---------------------------------------------------------------------------

_AD_ID = "cast(l_orderkey as string)"
_KEPT = f"select ad_account_id, ad_account_timezone from ({T.ACCOUNT}) a " \
        "where ad_account_include_ind = 'YES'"


def _extract_sql(kept: str | None, zone: str, facts: str, shown: str) -> str:
    """Campaigns, squads and ads of the landed bodies around some facts."""
    only = f"where account_id in (select ad_account_id from ({kept}) k)" if kept else ""
    return f"""
with c as (select * from (
    select cast(n_regionkey as string) as account_id, cast(n_nationkey as string) as campaign_id,
           n_name as campaign_name from nation
    union all
    select cast(n_regionkey as string), 'bare ' || cast(n_nationkey as string), null from nation)
    c0 {only}),
s as (select * from (
    select cast(c_nationkey % 5 as string) as account_id, cast(c_custkey as string) as ad_squad_id,
           cast(c_nationkey as string) as campaign_id, c_name as ad_squad_name from customer)
    s0 {only}),
a as (select a0.*, {zone} from (
    select cast(c_nationkey % 5 as string) as account_id, cast(o_orderkey as string) as ad_id,
           cast(o_custkey as string) as ad_squad_id, cast(o_orderdate as date) as ad_created_at
    from orders join customer on o_custkey = c_custkey) a0
    left join ({T.ACCOUNT}) t on a0.account_id = t.ad_account_id {only}),
f as ({facts}),
j0 as (select coalesce(a.ad_id, f.ad_id) as ad_id, a.* exclude (ad_id, account_id),
              f.* exclude (ad_id) from a full join f on a.ad_id = f.ad_id),
j1 as (select coalesce(s.ad_squad_id, j0.ad_squad_id) as ad_squad_id,
              s.* exclude (ad_squad_id, account_id), j0.* exclude (ad_squad_id)
       from s full join j0 on s.ad_squad_id = j0.ad_squad_id),
j2 as (select coalesce(c.campaign_id, j1.campaign_id) as campaign_id,
              c.* exclude (campaign_id, account_id), j1.* exclude (campaign_id)
       from c full join j1 on c.campaign_id = j1.campaign_id)
select campaign_id, campaign_name, ad_squad_id, ad_squad_name, ad_id, ad_created_at, {shown}
from j2"""


_DIMENSIONS = ["campaign_id", "campaign_name", "ad_squad_id", "ad_squad_name", "ad_id",
               "ad_created_at"]
# Stats of the excluded account were landed, too, and must not come out.
_DAY_FACTS = f"""
select ad_id, window_start, stats_date, cast(impressions as string) as impressions,
       cast(spend as string) as spend, cast(swipes as string) as swipes,
       cast(shares as string) as shares from ({payloads.carried_sql(_AD_ID)}) x
where cast(cast(ad_id as bigint) % 5 as string) in (select ad_account_id from ({_KEPT}) k)
"""


def _landing(spark, sf, *texts):
    return [T.frame(spark, sf, t) for t in texts]


_ENTITIES = (payloads.CAMPAIGN_LANDING, payloads.SQUAD_LANDING, payloads.AD_LANDING)


@query("daily_extract", _extract_sql(
    _KEPT, "t.ad_account_timezone as timezone", _DAY_FACTS,
    "timezone, stats_date, impressions, spend, swipes, shares"))
def daily_extract(spark, sf):
    wide = extracts.daily_extract(
        T.frame(spark, sf, T.ACCOUNT),
        *_landing(spark, sf, *_ENTITIES, payloads.day_landing(_AD_ID)))
    return wide.select(*_DIMENSIONS, "timezone",
                       X.iso_day(F.col("adstats_date")).alias("stats_date"),
                       "impressions", "spend", "swipes", "shares")


# The backfill asks for 30-day windows from 1995 to the end of 2000, for known ads of included
# accounts; responses of other windows and ads lie in the landing zone as well.
_START, _LIMIT = dt.date(1995, 1, 1), dt.date(2000, 12, 31)
_HISTORY_FACTS = f"""
select f.* replace (date '{_START}' + cast(floor((window_start - date '{_START}') / 30) as integer)
                    * 30 as window_start)
from ({_DAY_FACTS}) f
join (select o_orderkey, c_nationkey % 5 as c from orders join customer on o_custkey = c_custkey) a
  on f.ad_id = cast(a.o_orderkey as string)
where cast(a.c as string) in (select ad_account_id from ({_KEPT}) k)
  and date '{_START}' + cast(floor((window_start - date '{_START}') / 30) as integer) * 30
      < date '{_LIMIT}'
"""


def _history(spark, sf):
    tile = F.expr(f"date_add(date'{_START}', cast(floor(datediff(window_start, date'{_START}') / 30)"
                  " as int) * 30)")
    landed = T.frame(spark, sf, payloads.day_landing(_AD_ID)).withColumn("window_start", tile)
    path = fresh_path(spark, "history")
    missing = extracts.history_job(
        T.frame(spark, sf, T.ACCOUNT), *_landing(spark, sf, *_ENTITIES), landed, _START, _LIMIT, path)
    return path, missing


@query("history_extract", _extract_sql(
    _KEPT, "t.ad_account_timezone as timezone", _HISTORY_FACTS,
    "window_start, stats_date, impressions, spend, swipes, shares"))
def history_extract(spark, sf):
    """Windows -> requests -> their responses -> one folder per window, read back."""
    path, _ = _history(spark, sf)
    rows = E.read_extract(spark, path)
    return rows.select(
        *_DIMENSIONS[:-1], X.entity_day(F.col("ad_created_at")).alias("ad_created_at"),
        F.col("window_start").cast("date").alias("window_start"),
        X.iso_day(F.col("adstats_date")).alias("stats_date"), "impressions", "spend", "swipes",
        "shares")


@query("history_missing", f"""
select cast(a.o_orderkey as string) as ad_id, cast(w as date) as window_start,
       cast(least(cast(w as date) + 30, date '{_LIMIT}') as date) as window_end
from (select o_orderkey, c_nationkey % 5 as c from orders join customer on o_custkey = c_custkey) a,
     (select unnest(range(date '{_START}', date '{_LIMIT}', interval 30 day)) as w) t
where cast(a.c as string) in (select ad_account_id from ({_KEPT}) k)
  and not exists (select 1 from lineitem l where l.l_orderkey = a.o_orderkey and
      date '{_START}' + cast(floor((cast(l_shipdate as date) - date '{_START}') / 30) as integer) * 30
      = cast(w as date))
""")
def history_missing(spark, sf):
    """Requests of the backfill that no response answers."""
    return _history(spark, sf)[1].select("ad_id", "window_start", "window_end")


@query("history_requests_inclusive", f"""
select cast(o_orderkey as string) as ad_id, cast(w as date) as window_start,
       cast(least(cast(w as date) + 30, date '2000-01-01') as date) as window_end
from orders, (select unnest(range(date '1999-01-01', date '2000-01-01', interval 30 day)) as w) t
""")
def history_requests_inclusive(spark, sf):
    """A year of windows whose last end is the day after the limit."""
    ads = T.frame(spark, sf, "select cast(o_orderkey as string) as ad_id, 'UTC' as timezone from orders")
    return extracts.history_requests(ads, dt.date(1999, 1, 1), dt.date(1999, 12, 31),
                                     inclusive_end=True).select("ad_id", "window_start", "window_end")


@query("daily_requests", """
select cast(c_custkey as string) as ad_id, date '2020-02-16' as window_start,
       date '2020-03-17' as window_end, '2020-02-16T5:00:00.000-00:00' as start_time,
       '2020-03-17T4:00:00.000-00:00' as end_time
from customer
""")
def daily_requests(spark, sf):
    """A daily run's window over a clock change: the end bound has the run's own offset."""
    ads = T.frame(spark, sf, "select cast(c_custkey as string) as ad_id, "
                             "'America/New_York' as timezone from customer")
    return extracts.day_requests(ads, dt.date(2020, 3, 17), now=dt.datetime(2020, 3, 17, 9, 30))


_LIFE_FACTS = """
select ad_id, cast(user_id as string) as impressions, cast(event_id % 7 as string) as spend
from (select *, cast(event_id as string) as ad_id from events) e
"""
_LIFE_LANDING = """
select cast(event_id % 5 as string) as account_id, cast(event_id as string) as ad_id,
       cast(null as date) as window_start, 200 as status,
       '{"lifetime_stats":[{"lifetime_stat":{"stats":{"impressions":' || cast(user_id as string)
       || ',"spend":' || cast(event_id % 7 as string) || ',"conversion_save":'
       || cast(event_id % 3 as string) || '}}}]}' as body
from events
"""


@query("lifetime_extract", _extract_sql(
    _KEPT, "1 as one", f"""
select * from ({_LIFE_FACTS}) x where cast(cast(ad_id as bigint) % 5 as string) in (
  select ad_account_id from ({_KEPT}) k)""", "impressions, spend"))
def lifetime_extract(spark, sf):
    wide = extracts.lifetime_extract(*_landing(spark, sf, *_ENTITIES, _LIFE_LANDING),
                                     seed=T.frame(spark, sf, _KEPT))
    return wide.select(*_DIMENSIONS, "impressions", "spend")


_GEO_FACTS = f"""
select coalesce(l.ad_id, g.ad_id) as ad_id, dma, region, geo_impressions, impressions, spend,
       conversion_save
from (select cast(event_id as string) as ad_id, dma, region,
             cast(geo_impressions as string) as geo_impressions
      from ({payloads._GEO_ITEMS}) i where event_type <> 'error') g
full join (select *, cast(cast(ad_id as bigint) % 3 as string) as conversion_save
           from ({_LIFE_FACTS}) f0) l on g.ad_id = l.ad_id
"""


@query("geo_extract", _extract_sql(
    None, "1 as one", _GEO_FACTS,
    "dma, region, geo_impressions, impressions, spend, conversion_save"))
def geo_extract(spark, sf):
    wide = extracts.geo_extract(*_landing(spark, sf, *_ENTITIES, _LIFE_LANDING,
                                          payloads.GEO_LANDING))
    return wide.select(*_DIMENSIONS, "dma", "region", "geo_impressions", "impressions", "spend",
                       "conversion_save")


# --- loads ------------------------------------------------------------------------------

def _stacked_sql(tables: dict[str, str]) -> str:
    """All columns of several tables, one below the other."""
    return " union all by name ".join(
        f"select '{t}' as table_name, * from ({sql}) x" for t, sql in tables.items())


def _stacked(wh: Warehouse, tables: list[str]):
    parts = [T.readable(wh.table(t)).withColumn("table_name", F.lit(t)) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _seen(entity: str) -> str:
    """The wide extract brings every entity once loaded through its children or alone."""
    return f"select * replace (date '2020-05-17' as created_on, date '2020-05-17' as updated_on) " \
           f"from ({upserts._BASE[entity]}) z"


_NAMES = {"campaign": "campaign_name", "ad_squad": "ad_squad_name", "ad": "ad_name"}


def _old_named(entity: str) -> str:
    """Stored entities before the load, under an older name."""
    label = _NAMES[entity]
    return f"select * replace ('old ' || {label} as {label}) from ({upserts._old(entity)}) q"


def _store_old(wh: Warehouse, spark, sf) -> None:
    for t, label in _NAMES.items():
        wh.publish(t, T.frame(spark, sf, upserts._old(t)).withColumn(
            label, F.concat(F.lit("old "), label)))


@query("daily_load", _stacked_sql({
    "campaign": upserts.merge_sql("campaign_name", _old_named("campaign"), _seen("campaign")),
    "ad_squad": upserts.merge_sql("squad_name", _old_named("ad_squad"), upserts._known(
        "ad_squad", upserts._DAY_SQUAD, _seen("ad_squad"))),
    "ad": upserts.merge_sql("ad_name", _old_named("ad"), _seen("ad")),
    "ad_stats": T.doubles_sql(T.DAY_GATED)}))
def daily_load(spark, sf):
    """Wide extract as CSV -> names and new rows of three dimensions, DAY facts: all columns."""
    wh, path = _warehouse(spark), fresh_path(spark, "extract")
    _store_old(wh, spark, sf)
    E.write_extract(_wide_text(spark, sf, T.frame(spark, sf, T.DAY_TEXT)), path)
    loads.daily_load(wh, E.read_extract(spark, path), RUN)
    return _stacked(wh, ["campaign", "ad_squad", "ad", "ad_stats"])


def _lifetime(spark, sf):
    """Lifetime totals, written once as the extract jobs do: an outer join reads its facts twice."""
    return staged(upserts._lifetime_text(spark, sf).drop("last_day"), "lifetime-stats")


_LIFETIME_NEW = f"select * from ({upserts._lifetime_sql(upserts._RUN, upserts._METRICS)}) n " \
                f"where {T.ACTIVE}"


@query("lifetime_load", _stacked_sql({
    "ad_account": upserts.merge_sql("account_seed", T.ACCOUNT, upserts._SEED_ROWS),
    "campaign": upserts.merge_sql("campaign_full", _old_named("campaign"), _seen("campaign")),
    "ad_squad": upserts.merge_sql("squad_full", _old_named("ad_squad"), _seen("ad_squad")),
    "ad": upserts.merge_sql("ad_full", _old_named("ad"), _seen("ad")),
    "ad_stats": T.doubles_sql(_LIFETIME_NEW)}))
def lifetime_load(spark, sf):
    """Seed accounts, full dimensions and LIFETIME facts out of one wide extract: all columns."""
    wh = _warehouse(spark)
    wh.publish("ad_account", T.frame(spark, sf, T.ACCOUNT))
    _store_old(wh, spark, sf)
    wide = _wide_text(spark, sf, _lifetime(spark, sf))
    raw = E.as_extract(wide, S.WIDE_LIFETIME_COLUMNS)
    loads.lifetime_load(wh, raw, RUN, T.frame(spark, sf, upserts._SEED), dimensions=True)
    return _stacked(wh, ["ad_account", "campaign", "ad_squad", "ad", "ad_stats"])


# The trial load has no key guard: rows of squads without ads bring the blank ad, whose
# squad is the largest of those. Nor is it gated: an ad without stats gets an empty row.
_BLANK_AD = f"""
select * from (select * replace (cast(null as date) as created_on, cast(null as date) as updated_on)
               from ({T.AD}) a)
union all by name
select * from (select '' as ad_id, max(ad_squad_id) as ad_squad_id from ({T.AD_SQUAD}) s
               where ad_squad_id not in (select ad_squad_id from ({T.AD}) a)) b
where ad_squad_id is not null
"""
_TRIAL_FACTS = f"""
select * from ({upserts._lifetime_sql(upserts._RUN, upserts._TRIAL)}) f
union all by name
select ad_id || '2020-05-17LIFETIME' as ad_id_date_granul, ad_id, date '2020-05-17' as stats_date,
       'LIFETIME' as granularity, 'all' as stats_month
from ({_BLANK_AD}) b where ad_id not in (select ad_id from ({T.DAY_RAW}) d)
"""


@query("trial_load", _stacked_sql({
    "ad_account": upserts.merge_sql("account_absent", T.ACCOUNT, upserts._SEED_ROWS),
    "ad": upserts.merge_sql("ad_trial", _old_named("ad"), _BLANK_AD),
    "ad_stats": T.doubles_sql(_TRIAL_FACTS)}))
def trial_load(spark, sf):
    """Absent accounts, unguarded dimensions and 12 lifetime metrics."""
    wh = _warehouse(spark)
    wh.publish("ad_account", T.frame(spark, sf, T.ACCOUNT))
    _store_old(wh, spark, sf)
    wide = _wide_text(spark, sf, _lifetime(spark, sf))
    loads.trial_load(wh, E.as_extract(wide, S.WIDE_LIFETIME_COLUMNS), RUN,
                     T.frame(spark, sf, upserts._SEED), geo=False)
    return _stacked(wh, ["ad_account", "ad", "ad_stats"])


@query("account_seed_rows", """
select cast(c_custkey as string) as ad_account_id, c_name as ad_account_name,
       case when c_nationkey < 12 then 'client ' || c_mktsegment end as ad_account_client,
       case when c_nationkey < 12 then 'brand' end as ad_account_brand, 'YES' as ad_account_include_ind,
       date '2020-05-17' as created_on
from customer
""")
def account_seed_rows(spark, sf):
    """A seed file of accounts, some with client and brand, some with a name only."""
    path = fresh_path(spark, "seed")
    T.frame(spark, sf, """
        select cast(c_custkey as string) as ad_account_id, c_name as ad_account_name,
               case when c_nationkey < 12 then 'client ' || c_mktsegment end as ad_account_client,
               case when c_nationkey < 12 then 'brand' end as ad_account_brand
        from customer""").write.json(path)
    return account_rows(account_seed(spark, path), F.lit(RUN)).select(
        "ad_account_id", "ad_account_name", "ad_account_client", "ad_account_brand",
        "ad_account_include_ind", "created_on")


@query("geo_load", upserts.merge_sql(
    "geo", upserts.geo_sql(upserts._OLD_GEO_RAW, upserts._FIRST_RUN),
    upserts.geo_sql(upserts._NEW_GEO_RAW, upserts._RUN)))
def geo_load(spark, sf):
    """Two geo loads into a stored table; the second restates and extends the first."""
    wh = _warehouse(spark)
    raw = T.frame(spark, sf, T.GEO_RAW)
    loads.geo_load(wh, raw.where(F.col("dma").isin("click", "view")), dt.date(2020, 4, 1))
    loads.geo_load(wh, raw.where(F.col("dma") != "click").withColumn(
        "geo_spend", F.col("geo_spend") + 1), RUN)
    return wh.table("ad_geo")


# --- roll-ups -----------------------------------------------------------------------------

_JULY = "stats_date between date '1999-07-01' and date '1999-07-31'"
_JULY_OLD = f"select * exclude (refreshed_on) from ({upserts.month_sql(
    f'select * from ({T.DAY_GATED}) e where day(stats_date) < 20 and {_JULY}')}) m where {T.ACTIVE}"
_JULY_NEW = upserts.month_sql(f"select * from ({T.DAY_GATED}) e where {_JULY}",
                              "date '1999-07-25'")


@query("monthly_load", upserts.month_check(
    upserts.merge_sql("month_refresh", _JULY_OLD, _JULY_NEW)))
def monthly_load(spark, sf):
    """The current month, first on the 19th and again on the 25th with all its days."""
    wh = _warehouse(spark)
    text = T.frame(spark, sf, T.DAY_TEXT)
    day = E.day_rows(text).where(X.has_activity())
    wh.publish("ad_stats", day.where(F.dayofmonth("stats_date") < 20))
    loads.monthly_load(wh, dt.date(1999, 7, 19))
    wh.upsert("day_stats", day, months_of(E.days_of(text)))
    loads.monthly_load(wh, dt.date(1999, 7, 25))
    return T.readable(wh.facts("ad_stats", S.MONTH), {"frequency": 4})


@query("month_history_load", upserts.month_check(
    f"select * exclude (refreshed_on) from ({upserts._ALL_MONTHS}) m where {T.ACTIVE}"))
def month_history_load(spark, sf):
    """All months of the table in one pass, loaded twice: the second run changes nothing."""
    wh = _warehouse(spark)
    wh.publish("ad_stats", E.day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity()))
    for _ in range(2):
        loads.month_history_load(wh, dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    return T.readable(wh.facts("ad_stats", S.MONTH), {"frequency": 4})


_TOUCHED_DAYS = "stats_date between date '1999-06-01' and date '1999-08-31'"
_TOUCHED_OLD = f"select * exclude (refreshed_on) from ({upserts.month_sql(
    f'select * from ({T.DAY_GATED}) e where month(stats_date) < 8 and {_TOUCHED_DAYS}')}) m " \
    f"where {T.ACTIVE}"
_TOUCHED_NEW = upserts.month_sql(f"""
select * replace (spend + 3 as spend) from ({T.DAY_GATED}) e where {_TOUCHED_DAYS}""",
                                 "date '1999-09-02'")


@query("touched_months_load", upserts.month_check(f"""
select * from ({upserts.merge_sql('month_refresh', _TOUCHED_OLD,
    f"select * from ({_TOUCHED_NEW}) n where stats_month < '1999-08'")}) r
union all by name
select * exclude (refreshed_on) from ({_TOUCHED_NEW}) f where stats_month = '1999-08' and {T.ACTIVE}
"""))
def touched_months_load(spark, sf):
    """Restated days of three months: two are refreshed, the third is loaded first."""
    wh = _warehouse(spark)
    day = E.day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity()) \
        .where(F.col("stats_date").between(dt.date(1999, 6, 1), dt.date(1999, 8, 31)))
    wh.publish("ad_stats", day.where(F.month("stats_date") < 8))
    loads.month_history_load(wh, dt.date(1999, 6, 1), dt.date(1999, 7, 31))
    wh.upsert("day_stats", day.withColumn("spend", F.col("spend") + 3))
    loads.touched_months_load(wh, dt.date(1999, 6, 9), dt.date(1999, 8, 2), dt.date(1999, 9, 2))
    return T.readable(wh.facts("ad_stats", S.MONTH), {"frequency": 4})


# Some ads are restated, some of them without swipes; August comes new.
_IS_RESTATED = "(cast(ad_id as bigint) % 2 = 0 or month(stats_date) = 8)"
_IN_STEP_NEW = upserts.month_sql(f"""
select * replace (case when {_IS_RESTATED} then spend + 3 else spend end as spend,
                  case when not ({_IS_RESTATED} and cast(ad_id as bigint) % 5 = 0) then swipes end as swipes)
from ({T.DAY_GATED}) e where {_TOUCHED_DAYS}""", "date '1999-09-02'")


@query("month_from_changes", upserts.month_check(f"""
select * from ({upserts.merge_sql('month_refresh', _TOUCHED_OLD,
    f"select * from ({_IN_STEP_NEW}) n where stats_month < '1999-08'")}) r
union all by name
select * exclude (refreshed_on) from ({_IN_STEP_NEW}) f where stats_month = '1999-08' and {T.ACTIVE}
"""))
def month_from_changes(spark, sf):
    """Restated days whose MONTH rows follow by what changed: sums, lost values, a new month."""
    wh = _warehouse(spark)
    day = E.day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity()) \
        .where(F.col("stats_date").between(dt.date(1999, 6, 1), dt.date(1999, 8, 31)))
    wh.publish("ad_stats", day.where(F.month("stats_date") < 8))
    loads.month_history_load(wh, dt.date(1999, 6, 1), dt.date(1999, 7, 31))
    restated = day.where(F.expr(_IS_RESTATED)).withColumns({
        "spend": F.col("spend") + 3,
        "swipes": F.when(F.col("ad_id").cast("bigint") % 5 != 0, F.col("swipes"))})
    loads.restate_days(wh, restated, dt.date(1999, 9, 2))
    return T.readable(wh.facts("ad_stats", S.MONTH), {"frequency": 4})


# --- files that cannot be read as a whole, buckets ----------------------------------------------

@query("extract_rejects", """
select case when o_orderkey % 7 in (3, 5) then 'rejected' else 'loaded' end as kind,
       cast(o_orderkey as string) as ad_id,
       case when o_orderkey % 7 not in (3, 5) then o_custkey end as spend
from orders
""")
def extract_rejects(spark, sf):
    """Lines with too few or too many fields are told apart from the rows that are loaded."""
    folder, rejects = fresh_path(spark, "torn"), fresh_path(spark, "rejects")
    fields = [{"ad_id": "cast(o_orderkey as string)", "spend": "cast(o_custkey as string)"}.get(c, "''")
              for c in S.WIDE_DAY_COLUMNS]
    line = f"""case o_orderkey % 7 when 3 then concat_ws(',', {', '.join(fields[:10])})
               when 5 then concat_ws(',', {', '.join(fields)}, 'one', 'too many')
               else concat_ws(',', {', '.join(fields)}) end"""
    lines = T.frame(spark, sf, f"select {line} as line from orders")
    head = spark.range(1).select(F.lit(",".join(S.WIDE_DAY_COLUMNS)).alias("line"))
    # Every file needs its header: one a task, before the task's lines.
    named = lines.withColumn("part", F.pmod(F.xxhash64("line"), F.lit(4)))
    heads = head.select("line", F.explode(F.array(*map(F.lit, range(4)))).alias("part"))
    named.withColumn("place", F.lit(1)).unionByName(heads.withColumn("place", F.lit(0))) \
        .repartition(4, "part").sortWithinPartitions("part", "place").select("part", "line") \
        .write.partitionBy("part").text(folder)
    good = E.split_extract(spark, folder, rejects)
    lost = spark.read.parquet(rejects).select(
        F.lit("rejected").alias("kind"), F.split("line", ",")[S.WIDE_DAY_COLUMNS.index("ad_id")].alias("ad_id"),
        F.lit(None).cast("bigint").alias("spend"))
    return good.select(F.lit("loaded").alias("kind"), "ad_id", F.col("spend").cast("bigint").alias("spend")) \
        .unionByName(lost)


@query("upsert_bucketed", upserts.merge_sql("ad_full", upserts._old("ad"), upserts._CHANGED["ad"]))
def upsert_bucketed(spark, sf):
    """A full load of ads into a dimension that lies in buckets."""
    ads = BucketedDimension(spark, fresh_path(spark, "bucketed"), "ad")
    ads.publish(T.frame(spark, sf, upserts._old("ad")), 4)
    ads.upsert("ad_full", E.entity_rows(upserts._extract_text(spark, sf, "ad"), "ad", F.lit(RUN)))
    return ads.read()


# --- incremental stream ---------------------------------------------------------------------

@query("stream_day_load", T.doubles_sql(f"""
select *, 'fact' as kind, cast(null as date) as loaded, cast(null as string) as name_start
from ({T.DAY_GATED}) g
union all by name
select 'archive' as kind, date '2020-05-17' as loaded, 'drop=1/part' as name_start
union all by name
select 'dimension' as kind, ad_id, ad_squad_id as name_start from ({T.AD}) a
"""))
def stream_day_load(spark, sf):
    """One drop of extract files, loaded by the stream and archived under its run's date.

    Facts, the ads with their squads, and what the archive holds after a single run.
    """
    wh = _warehouse(spark)
    inbox, archive = fresh_path(spark, "inbox"), fresh_path(spark, "archive")
    state = fresh_path(spark, "state")
    E.write_extract(_wide_text(spark, sf, T.frame(spark, sf, T.DAY_TEXT)), f"{inbox}/drop=1")
    load_new_extracts(wh, inbox, state, RUN, archive=archive)
    facts = T.readable(wh.facts("ad_stats", S.DAY)).withColumn("kind", F.lit("fact"))
    moved = archived(spark, archive).select(
        F.lit("archive").alias("kind"), "loaded",
        F.regexp_extract("name", "^(.*part)-", 1).alias("name_start")).distinct()
    ads = wh.table("ad").select(F.lit("dimension").alias("kind"), "ad_id",
                                F.col("ad_squad_id").alias("name_start"))
    return facts.unionByName(moved, allowMissingColumns=True) \
        .unionByName(ads, allowMissingColumns=True)


# The restated text is what gets deduplicated, so its check changes the rows first.
_RESTATED = f"""
select * replace (impressions + 100 as impressions, cast(null as bigint) as swipes)
from ({T.DAY_RAW}) d where stats_date >= date '1998-12-01'
"""


@query("stream_restatement", T.doubles_sql(upserts.merge_sql(
    "day_stats", upserts._OLD_DAY,
    f"select * from ({T.day_sql(_RESTATED)}) n where {T.ACTIVE}")))
def stream_restatement(spark, sf):
    """A second drop restates a month of days that the first one has loaded."""
    wh = _warehouse(spark)
    inbox, state = fresh_path(spark, "inbox"), fresh_path(spark, "state")
    text = T.frame(spark, sf, T.DAY_TEXT)
    day = X.iso_day(F.col("adstats_date"))
    again = text.where(day >= dt.date(1998, 12, 1)).withColumns({
        "swipes": F.lit(""), "impressions": F.when(
            F.col("impressions") != "", (F.col("impressions").try_cast("double") + 100)
            .cast("string")).otherwise("")})
    drops = [text.where(day < dt.date(1999, 1, 1)), again]
    for n, rows in enumerate(drops):
        E.write_extract(rows, f"{inbox}/drop={n}")
        load_new_extracts(wh, inbox, state, RUN)
    return T.readable(wh.facts("ad_stats", S.DAY))


# A row counts by its newest version with activity, whichever drop arrives first.
_ACTIVE_TEXT = f"select * from ({T.DAY_RAW}) r where {T.ACTIVE}"
_NEWER = T.day_sql(f"select * from ({_RESTATED}) r where {T.ACTIVE}")
_NEWEST = f"""
select * from ({_NEWER}) n
union all by name
select * from ({T.day_sql(_ACTIVE_TEXT)}) o where not exists (
  select 1 from ({_NEWER}) n where n.ad_id = o.ad_id and n.stats_date = o.stats_date)
"""


@query("stream_version_order", T.doubles_sql(f"""
select v.*, arrival from ({_NEWEST}) v, (select unnest(['in order', 'reversed']) as arrival) a
"""))
def stream_version_order(spark, sf):
    """Two drops, the newer one arriving last and first: the same table."""
    text = T.frame(spark, sf, T.DAY_TEXT)
    again = text.where(X.iso_day(F.col("adstats_date")) >= dt.date(1998, 12, 1)).withColumns({
        "swipes": F.lit(""), "impressions": F.when(
            F.col("impressions") != "", (F.col("impressions").try_cast("double") + 100)
            .cast("string")).otherwise("")})
    drops, out = [text, again], []
    for arrival, order in (("in order", (0, 1)), ("reversed", (1, 0))):
        wh, inbox, state = _warehouse(spark), fresh_path(spark, "inbox"), fresh_path(spark, "state")
        for n in order:
            E.write_extract(drops[n], f"{inbox}/drop={n}")
            load_in_version_order(wh, inbox, state, RUN)
        out.append(T.readable(wh.facts("ad_stats", S.DAY)).withColumn("arrival", F.lit(arrival)))
    return out[0].unionByName(out[1])


@query("archive_report", """
select distinct strftime(cast(l_shipdate as date), '%Y-%m') || '-01' as window_start,
       date '2020-05-17' as loaded, 'moved' as outcome, true as in_archive
from lineitem
""")
def archive_report_rows(spark, sf):
    """What became of every loaded file, and whether it is where the report says."""
    wh, inbox, state, archive = _warehouse(spark), *(
        fresh_path(spark, name) for name in ("inbox", "state", "archive"))
    rows = T.frame(spark, sf, T.DAY_TEXT)
    month = F.trunc(X.iso_day(F.col("adstats_date")), "month").cast("string")
    E.write_extract(rows.withColumn("window_start", month), f"{inbox}/drop=1", by_window="window_start")
    load_new_extracts(wh, inbox, state, RUN, archive=archive)
    moves = archive_report(spark, ledger_of(state)).select(
        "loaded", "outcome", F.regexp_extract("target", "/(drop=1/.*)$", 1).alias("name"))
    there = archived(spark, archive).select("name", F.lit(True).alias("there"))
    return moves.join(there, "name", "left").select(
        F.regexp_extract("name", "window_start=([^/]*)/", 1).alias("window_start"), "loaded", "outcome",
        F.coalesce("there", F.lit(False)).alias("in_archive")).distinct()


# Stats land when they were shipped, ads when they were ordered; stats of more than 60 days
# later come too late for their ad.
_ADS_LANDED = f"""
select *, cast(substr(body, position('"created_at":"' in body) + 14, 10) as timestamp) as landed_at
from ({payloads.AD_LANDING}) l
"""


@query("stream_ads_outer_stats", f"""
select a.ad_id, a.ad_name, s.stats_date, cast(s.impressions as string) as impressions,
       cast(s.spend as string) as spend
from ({T.AD}) a left join ({payloads.carried_sql(_AD_ID)}) s
  on a.ad_id = s.ad_id and s.window_start between a.ad_created_at and a.ad_created_at + 60
""")
def stream_ads_outer_stats(spark, sf):
    """Ads and stats as they land; a later pair of responses lets the watermark pass."""
    path = {n: fresh_path(spark, n) for n in ("ads", "stats", "out", "state")}
    ads = T.frame(spark, sf, _ADS_LANDED)
    stats = T.frame(spark, sf, payloads.day_landing(_AD_ID)).withColumn(
        "landed_at", F.col("window_start").cast("timestamp"))
    later = F.lit("2030-01-01").cast("timestamp")
    drops = [(ads, stats), tuple(
        f.limit(1).withColumns({"landed_at": later, "body": F.lit(body)}) for f, body in (
            (ads, '{"ads":[{"ad":{"id":"later"}}]}'), (stats, payloads.EMPTY_SERIES)))]
    for a, s in drops:
        a.write.mode("append").parquet(path["ads"])
        s.write.mode("append").parquet(path["stats"])
        joined = ads_outer_stats(watch_landing(spark, path["ads"]), watch_landing(spark, path["stats"]),
                                 "60 days", "1 day")
        with state_on_disk(spark):
            run = joined.writeStream.option("checkpointLocation", path["state"]) \
                .trigger(availableNow=True).start(path["out"])
        run.awaitTermination()
    return spark.read.parquet(path["out"]).select(
        "ad_id", "ad_name", X.iso_day(F.col("adstats_date")).alias("stats_date"), "impressions", "spend")
