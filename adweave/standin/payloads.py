"""Landed responses: bodies are built as JSON text from table rows and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.sources import drift as D
from adweave.sources import payloads as P
from adweave.standin import frames as T
from adweave.standin.catalog import query

_HEAD = "cast(null as date) as window_start, 200 as status"


# --- entities: a body holds the entity and a bare copy without optional keys ----------

CAMPAIGN_LANDING = f"""
select cast(n_regionkey as string) as account_id, cast(null as string) as ad_id, {_HEAD},
       '{{"campaigns":[{{"campaign":{{"id":"' || cast(n_nationkey as string) || '","name":"'
       || n_name || '","ad_account_id":"' || cast(n_regionkey as string)
       || '","status":"ACTIVE","created_at":"2019-01-02T03:04:05.678Z"'
       || case when n_regionkey = 2 then '' else ',"end_time":"2020-02-29T00:00:00.000Z"' end
       || ',"daily_budget_micro":' || cast(n_nationkey * 1000 + 16777217 as string)
       || ',"unknown_key":{{"a":1}}}}}},{{"campaign":{{"id":"bare ' || cast(n_nationkey as string)
       || '","created_at":"2019-12-31T23:59:59.999Z"}}}}]}}' as body
from nation
"""


@query("payload_campaigns", """
select cast(n_regionkey as string) as account_id, cast(n_nationkey as string) as campaign_id,
       n_name as campaign_name, cast(n_regionkey as string) as ad_account_id,
       'ACTIVE' as campaign_status, date '2019-01-02' as campaign_created_at,
       case when n_regionkey = 2 then null else date '2020-02-29' end as campaign_end_time,
       cast(n_nationkey * 1000 + 16777217 as string) as campaign_daily_budget_micro
from nation
union all
select cast(n_regionkey as string), 'bare ' || cast(n_nationkey as string), null, null, null,
       date '2019-12-31', null, null
from nation
""")
def payload_campaigns(spark, sf):
    return P.read_entity(T.frame(spark, sf, CAMPAIGN_LANDING), "campaign").select(
        "account_id", "campaign_id", "campaign_name", "ad_account_id", "campaign_status",
        "campaign_created_at", "campaign_end_time", "campaign_daily_budget_micro")


SQUAD_LANDING = f"""
select cast(c_nationkey % 5 as string) as account_id, cast(null as string) as ad_id, {_HEAD},
       '{{"adsquads":[{{"adsquad":{{"id":"' || cast(c_custkey as string) || '","campaign_id":"'
       || cast(c_nationkey as string) || '","name":"' || c_name || '","type":"SINGLE_ADS"'
       || ',"status":"' || c_mktsegment || '","created_at":"2019-01-02T03:04:05.678Z"'
       || ',"auto_bid":' || case when c_mktsegment = 'BUILDING' then 'true' else 'false' end
       || ',"bid_micro":' || cast(cast(round(c_acctbal * 100) as bigint) as string)
       || '}}}}]}}' as body
from customer
"""


@query("payload_squads", """
select cast(c_nationkey % 5 as string) as account_id, cast(c_custkey as string) as ad_squad_id,
       cast(c_nationkey as string) as campaign_id, c_name as ad_squad_name,
       'SINGLE_ADS' as ad_squad_type, c_mktsegment as ad_squad_status,
       '01/02/2019 0:00' as ad_squad_created_at, cast(null as string) as ad_squad_end_time,
       case when c_mktsegment = 'BUILDING' then 'true' else 'false' end as auto_bid,
       cast(cast(round(c_acctbal * 100) as bigint) as string) as bid_micro
from customer
""")
def payload_squads(spark, sf):
    return P.read_entity(T.frame(spark, sf, SQUAD_LANDING), "ad_squad", render_dates=True).select(
        "account_id", "ad_squad_id", "campaign_id", "ad_squad_name", "ad_squad_type",
        "ad_squad_status", "ad_squad_created_at", "ad_squad_end_time", "auto_bid", "bid_micro")


AD_LANDING = f"""
select cast(c_region as string) as account_id, cast(null as string) as ad_id, {_HEAD},
       '{{"ads":[{{"ad":{{"id":"' || cast(o_orderkey as string) || '","ad_squad_id":"'
       || cast(o_custkey as string) || '","name":"ad ' || cast(o_orderkey as string)
       || '","creative_id":"creative ' || cast(o_custkey as string)
       || '","status":"' || o_orderstatus || '","type":"' || o_orderpriority
       || '","render_type":"STATIC","review_status":"APPROVED","created_at":"'
       || cast(cast(o_orderdate as date) as string) || 'T00:00:00.000Z"'
       || case when o_orderstatus = 'P' then '' else ',"updated_at":"'
               || cast(cast(o_orderdate as date) + 7 as string) || 'T00:00:00.000Z"' end
       || '}}}}]}}' as body
from (select o.*, c_nationkey % 5 as c_region from orders o join customer on o_custkey = c_custkey)
     o
"""


@query("payload_ads", f"""
select a.ad_id, a.ad_squad_id, a.ad_name, a.creative_id, a.ad_status, a.ad_type, a.ad_created_at,
       a.ad_updated_at, t.ad_account_timezone as timezone
from ({T.AD}) a join customer on a.ad_squad_id = cast(c_custkey as string)
join ({T.ACCOUNT}) t on t.ad_account_id = cast(c_nationkey % 5 as string)
""")
def payload_ads(spark, sf):
    ads = P.read_ads(T.frame(spark, sf, AD_LANDING), T.frame(spark, sf, T.ACCOUNT))
    return ads.select("ad_id", "ad_squad_id", "ad_name", "creative_id", "ad_status", "ad_type",
                      "ad_created_at", "ad_updated_at", "timezone")


# --- time series: three days per response. Day 2 lacks spend, day 3 has spend null ------
# and no swipes; every other metric appears once.

_LINE = "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' " \
        "|| cast(l_partkey as string) || '-' || cast(l_suppkey as string)"


def _day(n: int) -> str:
    return f"cast(cast(l_shipdate as date) + {n} as string) || 'T00:00:00.000-05:00\",\"stats\":'"


def day_landing(ad_id: str) -> str:
    return f"""
select cast(l_orderkey % 5 as string) as account_id, {ad_id} as ad_id,
       cast(l_shipdate as date) as window_start, 200 as status,
       '{{"timeseries_stats":[{{"timeseries_stat":{{"timeseries":[{{"start_time":"' || {_day(0)}
       || '{{"impressions":' || cast(l_linenumber as string)
       || ',"spend":' || cast(cast(round(l_tax * 100) as bigint) as string)
       || ',"swipes":' || cast(cast(floor(l_quantity) as bigint) as string)
       || ',"frequency":' || cast(l_tax as string) || '}}}},{{"start_time":"' || {_day(1)}
       || '{{"impressions":' || cast(l_linenumber + 1 as string)
       || ',"swipes":' || cast(cast(floor(l_quantity) as bigint) + 1 as string)
       || ',"shares":' || cast(l_partkey % 7 as string) || '}}}},{{"start_time":"' || {_day(2)}
       || '{{"impressions":' || cast(l_linenumber + 2 as string)
       || ',"spend":null}}}}]}}}},{{"timeseries_stat":{{"timeseries":[]}}}}]}}' as body
from lineitem
"""


DAY_LANDING = day_landing(_LINE)
EMPTY_SERIES = ('{"timeseries_stats":[{"timeseries_stat":{"timeseries":['
                '{"start_time":"2030-01-01T00:00:00.000-05:00","stats":{}}]}}]}')


def _day_sql(ad_id: str, n: int, spend: str, swipes: str, shares: str) -> str:
    return f"""
select {ad_id} as ad_id, cast(l_shipdate as date) as window_start,
       cast(l_shipdate as date) + {n} as stats_date,
       cast(l_linenumber + {n} as bigint) as impressions, {spend} as spend, {swipes} as swipes,
       {shares} as shares, cast(l_tax as double) as frequency, cast(null as bigint) as saves
from lineitem"""


_SPEND, _SWIPES = "cast(round(l_tax * 100) as bigint)", "cast(floor(l_quantity) as bigint)"
_SHARES, _NONE = "cast(l_partkey % 7 as bigint)", "cast(null as bigint)"


def carried_sql(ad_id: str) -> str:
    return " union all ".join([
        _day_sql(ad_id, 0, _SPEND, _SWIPES, _NONE),
        _day_sql(ad_id, 1, _SPEND, f"{_SWIPES} + 1", _SHARES),
        _day_sql(ad_id, 2, _NONE, f"{_SWIPES} + 1", _SHARES)])


@query("payload_day_stats", carried_sql(_LINE))
def payload_day_stats(spark, sf):
    from adweave.functions import scalars as X

    rows = P.read_day_stats(T.frame(spark, sf, DAY_LANDING))
    counts = ["impressions", "spend", "swipes", "shares", "saves"]
    return rows.select("ad_id", "window_start", X.iso_day(F.col("adstats_date")).alias("stats_date"),
                       *[X.count_metric(F.col(m)).alias(m) for m in counts],
                       F.col("frequency").cast("double").alias("frequency"))


# --- lifetime: one row per response, also when its bag is empty -------------------------

_BAG = f"""
'"impressions":' || cast(l_linenumber as string) || ',"video_views":' ||
cast(l_partkey % 100 as string) || ',"conversion_purchases":' || cast(l_suppkey % 5 as string)
|| ',"conversion_add_cart":' || cast(l_partkey % 3 as string) || ',"extra":"x"'
"""
LIFETIME_LANDING = f"""
select cast(null as string) as account_id, {_LINE} as ad_id, cast(null as date) as window_start,
       case when l_linestatus = 'O' and l_returnflag = 'A' then 401 else 200 end as status,
       '{{"lifetime_stats":[{{"lifetime_stat":{{"stats":{{'
       || case when l_returnflag = 'R' then '' else {_BAG} end || '}}}}}}]}}' as body
from lineitem
"""


@query("payload_lifetime", f"""
select {_LINE} as ad_id,
       case when l_returnflag <> 'R' then cast(l_linenumber as string) end as impressions,
       case when l_returnflag <> 'R' then cast(l_partkey % 100 as string) end as video_views,
       cast(null as string) as spend
from lineitem where not (l_linestatus = 'O' and l_returnflag = 'A')
""")
def payload_lifetime(spark, sf):
    return P.read_lifetime_stats(T.frame(spark, sf, LIFETIME_LANDING),
                                 ["impressions", "video_views", "spend"])


@query("payload_conversions", f"""
select {_LINE} as ad_id, {', '.join(
    ("case when l_returnflag <> 'R' then cast(l_suppkey % 5 as string) end"
     if m == "conversion_purchases" else
     "case when l_returnflag <> 'R' then cast(l_partkey % 3 as string) end"
     if m == "conversion_add_cart" else "cast(null as string)") + f" as {m}"
    for m in S.CONVERSION_METRICS)}
from lineitem where not (l_linestatus = 'O' and l_returnflag = 'A')
""")
def payload_conversions(spark, sf):
    return P.read_conversions(T.frame(spark, sf, LIFETIME_LANDING))


# --- geo: three items per response (none for errors); keys carry over between items ------

GEO_LANDING = """
select cast(null as string) as account_id, cast(event_id as string) as ad_id,
       cast(null as date) as window_start, 200 as status,
       '{"lifetime_stats":[{"lifetime_stat":{"dimension_stats":[' ||
       case when event_type = 'error' then '' else
       '{"country":"us","region":"' || event_type || '","dma":"501","impressions":'
       || cast(user_id as string) || ',"spend":' || cast(event_id % 100 as string) || '},'
       || '{"dma":"502","impressions":' || cast(user_id + 1 as string) || ',"uniques":3},'
       || '{"region":"other","dma":"503","spend":null,"impression_composition":0.5}' end
       || ']}}]}' as body
from events
"""
_GEO_ITEMS = """
select *, 0 as pos, '501' as dma, event_type as region, user_id as geo_impressions,
       event_id % 100 as geo_spend, null as geo_uniques, null as geo_impression_composition
from events
union all
select *, 1, '502', event_type, user_id + 1, event_id % 100, '3', null from events
union all
select *, 2, '503', 'other', user_id + 1, null, '3', '0.5' from events
"""


@query("payload_geo", f"""
select cast(event_id as string) as ad_id, dma, 'us' as country, region,
       cast(geo_impressions as string) as geo_impressions, cast(geo_spend as string) as geo_spend,
       cast(geo_uniques as string) as geo_uniques,
       cast(geo_impression_composition as string) as geo_impression_composition
from ({_GEO_ITEMS}) g where event_type <> 'error'
""")
def payload_geo(spark, sf):
    return P.read_geo(T.frame(spark, sf, GEO_LANDING)).select(
        "ad_id", "dma", "country", "region", "geo_impressions", "geo_spend", "geo_uniques",
        "geo_impression_composition")


@query("geo_carry_forward", f"""
select cast(event_id as string) as ad_id, cast(pos as integer) as pos, dma,
       last_value(given_region ignore nulls) over w as region,
       last_value(given_impressions ignore nulls) over w as geo_impressions
from (select event_id, event_type, pos, dma, case when pos <> 1 then region end as given_region,
             case when pos <> 2 then cast(geo_impressions as string) end as given_impressions
      from ({_GEO_ITEMS}) g where event_type <> 'error') i
window w as (partition by event_id order by pos rows between unbounded preceding and current row)
""")
def geo_carry_forward(spark, sf):
    return P.read_geo(T.frame(spark, sf, GEO_LANDING)).select(
        "ad_id", "pos", "dma", "region", "geo_impressions")


# --- what cannot be read, and repeated keys -------------------------------------------------

_BROKEN_ADS = f"""
select account_id, ad_id, window_start,
       case when k % 11 = 3 then 500 when k % 11 = 4 then null else status end as status,
       case when k % 11 = 5 then 'oops' when k % 11 = 6 then '{{"other":[]}}' when k % 11 = 7 then null
            when k % 11 = 8 then replace(body, '"id":"', '"was":"') else body end as body
from (select *, cast(substr(body, 22, position('"' in substr(body, 22)) - 1) as bigint) as k
      from ({AD_LANDING}) l) b
"""


@query("payload_rejects", """
select kind, reject_reason, count(*) as n from (
  select 'ad' as kind, case o_orderkey % 11 when 3 then 'status 500' when 4 then 'status missing'
         when 8 then 'no id' else 'no payload' end as reject_reason
  from orders where o_orderkey % 11 between 3 and 8
  union all
  select 'lifetime', case when event_id % 7 = 1 then 'status 401' else 'no payload' end
  from events where event_id % 7 in (1, 2)
  union all
  select 'accepted', 'ad' from orders where o_orderkey % 11 not between 3 and 8
  union all
  select 'accepted', 'lifetime' from events where event_id % 7 not in (1, 2)) r
group by all
""")
def payload_rejects(spark, sf):
    """Rejects of two kinds of landing as the jobs write them, and what the readers return."""
    ads, life, path, _ = _taken(spark, sf)
    read = [P.read_ads(ads).select("ad_id").withColumn("reject_reason", F.lit("ad")),
            P.read_lifetime_stats(life).select("ad_id").withColumn("reject_reason", F.lit("lifetime"))]
    good = read[0].unionByName(read[1]).select(F.lit("accepted").alias("kind"), "reject_reason")
    return spark.read.parquet(path).select("kind", "reject_reason").unionByName(good) \
        .groupBy("kind", "reject_reason").agg(F.count("*").alias("n"))


_BROKEN_LIFE = """
select cast(event_id % 5 as string) as account_id, cast(event_id as string) as ad_id,
       cast(null as date) as window_start, case when event_id % 7 = 1 then 401 else 200 end
       as status, case when event_id % 7 = 2 then 'oops' else
       '{"lifetime_stats":[{"lifetime_stat":{"stats":{}}}]}' end as body from events
"""


def _taken(spark, sf):
    """Ads and lifetime landings taken in once, the rejects folder and the counts folder."""
    from adweave.plans.extracts import intake
    from adweave.session import fresh_path

    path, counts = fresh_path(spark, "rejects"), fresh_path(spark, "counts")
    frames = intake({"ad": T.frame(spark, sf, _BROKEN_ADS), "lifetime": T.frame(spark, sf, _BROKEN_LIFE)},
                    path, counts)
    return *frames.values(), path, counts


@query("extract_counts", """
select 'ad' as kind, 'accepted' as reason,
       count(*) filter (o_orderkey % 11 not in (3, 4, 5, 6, 7)) as n from orders
union all
select 'ad', 'status', count(*) filter (o_orderkey % 11 in (3, 4)) from orders
union all
select 'ad', 'no payload', count(*) filter (o_orderkey % 11 in (5, 6, 7)) from orders
union all
select 'ad', 'no id', count(*) filter (o_orderkey % 11 = 8) from orders
union all
select 'lifetime', 'accepted', count(*) filter (event_id % 7 not in (1, 2)) from events
union all
select 'lifetime', 'status', count(*) filter (event_id % 7 = 1) from events
union all
select 'lifetime', 'no payload', count(*) filter (event_id % 7 = 2) from events
""")
def extract_counts(spark, sf):
    """How the responses fared, observed while they were taken in."""
    *_, counts = _taken(spark, sf)
    return spark.read.schema("kind string, reason string, n bigint").json(counts)


# Ads with keys outside the schema: in the body, in an item and in the ad itself.
_MORE = """
select account_id, ad_id, window_start, status,
       '{"request_id":"r' || cast(k as string) || '",' || substr(body, 2, length(body) - 5)
       || case cast(k % 5 as integer) when 0 then ',"priority":' || cast(k as string)
          when 1 then ',"priority":"high"' when 2 then ',"brief":{"a":1,"b":[1,2]}'
          when 3 then ',"tags":["x","y"],"archived":null' else '' end || '}'
       || case when k % 3 = 0 then ',"sub_request_status":"SUCCESS"' else '' end || '}]}' as body
from (select *, cast(substr(body, 22, position('"' in substr(body, 22)) - 1) as bigint) as k
      from (ADS) l) b
""".replace("ADS", AD_LANDING)


@query("payload_drift", """
select 'ad' as kind, place, key, type, schema, count(*) as n from (
  select 'body' as place, 'request_id' as key, 'STRING' as type, 'STRING' as schema from orders
  union all
  select 'item', 'sub_request_status', 'STRING', 'STRING' from orders where o_orderkey % 3 = 0
  union all
  select 'ad', 'priority', case o_orderkey % 5 when 0 then 'BIGINT' else 'STRING' end,
         case o_orderkey % 5 when 0 then 'BIGINT' else 'STRING' end
  from orders where o_orderkey % 5 < 2
  union all
  select 'ad', 'brief', 'OBJECT', 'OBJECT<a: BIGINT, b: ARRAY<BIGINT>>' from orders where o_orderkey % 5 = 2
  union all
  select 'ad', 'tags', 'ARRAY', 'ARRAY<STRING>' from orders where o_orderkey % 5 = 3
  union all
  select 'ad', 'archived', 'VOID', 'VOID' from orders where o_orderkey % 5 = 3) k
group by all
""")
def payload_drift(spark, sf):
    """Every key outside the schema, with its type and how often it came."""
    return D.drift(T.frame(spark, sf, _MORE), "ad")


@query("payload_unknown_kept", """
select cast(o_orderkey as string) as ad_id, 'ad ' || cast(o_orderkey as string) as ad_name,
       case o_orderkey % 5 when 0 then '{"priority":' || cast(o_orderkey as string) || '}'
            when 1 then '{"priority":"high"}' when 2 then '{"brief":{"a":1,"b":[1,2]}}'
            when 3 then '{"tags":["x","y"],"archived":null}' end as unknown,
       case when o_orderkey % 5 = 0 then o_orderkey end as priority,
       case when o_orderkey % 5 = 2 then cast(1 as integer) end as brief_a
from orders
""")
def payload_unknown_kept(spark, sf):
    """Unknown keys carried with their ad, two of them made columns."""
    ads = P.read_entity(T.frame(spark, sf, _MORE), "ad", rest="unknown")
    wide = D.promoted(ads, "unknown", {"priority": "bigint", "brief": "struct<a: int>"})
    return wide.select("ad_id", "ad_name", "unknown", "priority", F.col("brief.a").alias("brief_a"))


_TWICE = """
select cast(event_id % 5 as string) as account_id, cast(event_id as string) as ad_id,
       cast(null as date) as window_start, 200 as status,
       '{"timeseries_stats":[{"timeseries_stat":{"timeseries":[{"start_time":"2020-01-01T00:00","stats":'
       || '{"spend":1,"impressions":' || cast(user_id as string) || ',"spend":'
       || cast(event_id as string) || '}},{"start_time":"2020-01-02T00:00","stats":{"spend":5,"swipes":2,'
       || '"spend":null}}]}}]}' as body
from events
"""


@query("payload_repeated_key", """
select cast(event_id as string) as ad_id, carried, d as day,
       case when d = 1 then cast(event_id as string) end as spend,
       case when d = 1 or carried then cast(user_id as string) end as impressions,
       case when d = 2 then '2' end as swipes
from events, (select unnest([1, 2]) as d) x, (select unnest([true, false]) as carried) y
""")
def payload_repeated_key(spark, sf):
    """A key twice in one bag: the last value counts, with and without carrying."""
    landing = T.frame(spark, sf, _TWICE)
    parts = [P.read_day_stats(landing, carry_forward=c).withColumn("carried", F.lit(c))
             for c in (True, False)]
    return parts[0].unionByName(parts[1]).select(
        "ad_id", "carried", F.substring("adstats_date", 10, 1).cast("int").alias("day"), "spend",
        "impressions", "swipes")
