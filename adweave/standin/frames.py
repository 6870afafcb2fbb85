"""Star-schema tables in the role of the advertising tables.

region -> accounts, nation -> campaigns, customer -> ad squads, orders -> ads,
lineitem -> DAY stats, events -> geo items and long-form series. Each text below is
plain SQL that Spark and DuckDB both run, so a query and its check start from the
same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SOURCES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]

ACCOUNT = """
select cast(r_regionkey as string) as ad_account_id, r_name as ad_account_name,
       'client ' || r_name as ad_account_client,
       'brand ' || cast(r_regionkey as string) as ad_account_brand,
       case r_name when 'AFRICA' then 'Africa/Lagos' when 'AMERICA' then 'America/Chicago'
                   when 'ASIA' then 'Asia/Kolkata' when 'EUROPE' then 'Europe/London'
                   else 'America/Los_Angeles' end as ad_account_timezone,
       case when r_name = 'EUROPE' then 'NO' else 'YES' end as ad_account_include_ind,
       date '2019-01-01' as created_on, date '2019-01-01' as updated_on
from region
"""

CAMPAIGN = """
select cast(n_nationkey as string) as campaign_id, n_name as campaign_name,
       cast(n_regionkey as string) as ad_account_id,
       case when n_regionkey < 2 then 'ACTIVE' else 'PAUSED' end as campaign_status,
       'objective ' || cast(n_regionkey as string) as objective,
       case when n_regionkey = 1 then null else 'AUCTION' end as buy_model,
       date '2019-01-01' + n_nationkey as campaign_created_at,
       date '2019-02-01' + n_nationkey as campaign_updated_at,
       date '2019-03-01' + n_nationkey as campaign_start_time,
       case when n_regionkey = 2 then null else date '2019-09-01' + n_nationkey end
           as campaign_end_time,
       cast(n_nationkey as bigint) * 1000000000 + 16777217 as lifetime_spend_cap_micro,
       case when n_regionkey = 3 then null else cast(n_nationkey as bigint) * 1000000 + 20000001
           end as campaign_daily_budget_micro,
       date '2019-01-01' as created_on, date '2019-01-01' as updated_on
from nation
"""

AD_SQUAD = """
select cast(c_custkey as string) as ad_squad_id, cast(c_nationkey as string) as campaign_id,
       c_name as ad_squad_name, c_mktsegment as ad_squad_status,
       case when c_acctbal < 0 then 'STORY' else 'SINGLE' end as ad_squad_type,
       'VALID' as targeting_reach_status, 'placement ' || c_mktsegment as placement,
       'IMPRESSION' as billing_event, 'SWIPES' as optimization_goal,
       case when c_acctbal > 9000 then null else 'DAILY_BUDGET' end as delivery_constraint,
       'STANDARD' as pacing_type,
       case when c_mktsegment = 'BUILDING' then 'TRUE' else 'FALSE' end as auto_bid,
       case when c_mktsegment = 'MACHINERY' then 'TRUE' else 'FALSE' end as target_bid,
       'PENDING' as reach_and_frequency_status,
       cast(null as string) as reach_and_frequency_debug_message,
       'NONE' as reserved_status, c_mktsegment || ', "' || c_name || '"' as reserved_debug_message,
       date '2019-01-01' + c_nationkey as ad_squad_created_at,
       date '2019-06-01' + c_nationkey as ad_squad_updated_at,
       date '2019-03-01' + c_nationkey as ad_squad_start_time,
       case when c_mktsegment = 'FURNITURE' then null else date '2019-12-01' + c_nationkey end
           as ad_squad_end_time,
       cast(round(c_acctbal * 100) as bigint) as bid_micro,
       cast(round(c_acctbal * 100) as bigint) * 10000 as ad_squad_daily_budget_micro,
       case when c_acctbal < 1000 then null else cast(round(c_acctbal) as bigint) * 1000000 end
           as lifetime_budget_micro,
       cast(c_nationkey as bigint) * 1000 as impression_goal,
       cast(c_nationkey as bigint) * 10 as reach_goal,
       cast(null as bigint) as reach_and_frequency_rate_micro,
       cast(c_nationkey as bigint) as reserved_rate_micro,
       date '2019-01-01' as created_on, date '2019-01-01' as updated_on
from customer
"""

AD = """
select cast(o_orderkey as string) as ad_id, cast(o_custkey as string) as ad_squad_id,
       'ad ' || cast(o_orderkey as string) as ad_name,
       'creative ' || cast(o_custkey as string) as creative_id, o_orderstatus as ad_status,
       o_orderpriority as ad_type, 'STATIC' as render_type,
       case when o_orderstatus = 'P' then 'PENDING' else 'APPROVED' end as review_status,
       cast(o_orderdate as date) as ad_created_at,
       case when o_orderstatus = 'P' then null else cast(o_orderdate as date) + 7 end
           as ad_updated_at,
       date '2019-01-01' as created_on, date '2019-01-01' as updated_on
from orders
"""

# Line items before cleaning: several rows per (ad, day), blank impressions on line 3.
DAY_RAW = """
select cast(l_orderkey as string) as ad_id, cast(l_shipdate as date) as stats_date,
       case when l_linenumber = 3 then null else cast(round(l_discount * 100) as bigint) end
           as impressions,
       cast(floor(l_quantity) as bigint) as swipes,
       cast(l_discount as float) as swipe_up_percent,
       cast(floor(l_extendedprice) as bigint) as view_time_millis,
       cast(floor(l_extendedprice) as bigint) + cast(floor(l_quantity) as bigint)
           as screen_time_millis,
       cast(floor(l_quantity * 0.75) as bigint) as quartile_1,
       cast(floor(l_quantity * 0.5) as bigint) as quartile_2,
       cast(floor(l_quantity * 0.25) as bigint) as quartile_3,
       cast(floor(l_quantity * 0.1) as bigint) as view_completion,
       cast(round(l_tax * 100) as bigint) as spend,
       cast(l_linenumber - 1 as bigint) as video_views,
       cast(l_partkey % 7 as bigint) as shares, cast(l_suppkey % 5 as bigint) as saves,
       cast(l_tax as float) as frequency, cast(0 as bigint) as total_installs,
       cast(floor(l_quantity) as bigint) as uniques
from lineitem
"""

# The same line items as extract text: decimals, blanks, offsets.
DAY_TEXT = """
select cast(l_orderkey as string) as ad_id,
       cast(cast(l_shipdate as date) as string) || 'T00:00:00.000-05:00' as adstats_date,
       case when l_linenumber = 3 then '' else cast(round(l_discount * 100) as string) end
           as impressions,
       cast(l_quantity + 0.5 as string) as swipes,
       cast(l_discount as string) as swipe_up_percent,
       cast(l_extendedprice as string) as view_time_millis,
       cast(cast(floor(l_extendedprice) as bigint) + cast(floor(l_quantity) as bigint) as string)
           as screen_time_millis,
       cast(l_quantity * 0.75 as string) as quartile_1,
       cast(l_quantity * 0.5 as string) as quartile_2,
       cast(l_quantity * 0.25 as string) as quartile_3,
       cast(l_quantity * 0.1 as string) as view_completion,
       cast(round(l_tax * 100) as string) as spend,
       cast(l_linenumber - 1 as string) as video_views,
       cast(l_partkey % 7 as string) as shares, cast(l_suppkey % 5 as string) as saves,
       cast(l_tax as string) as frequency, '0' as total_installs,
       cast(l_quantity as string) as uniques
from lineitem
"""

GEO_RAW = """
select cast(user_id as string) as ad_id, event_type as dma, 'us' as country,
       'region ' || cast(user_id % 9 as string) as region,
       cast(floor(value) as bigint) as geo_impressions,
       cast(event_id % 50 as bigint) as geo_swipes,
       cast(event_id % 1000 as bigint) as geo_uniques,
       cast(round(value * 100) as bigint) as geo_spend,
       value / 500 as geo_impression_composition, value / 1000 as geo_unique_composition
from events
"""

# Stated for the checks, so that they do not follow the library's lists (fixed values).
METRICS = ["impressions", "swipes", "swipe_up_percent", "view_time_millis", "screen_time_millis",
           "quartile_1", "quartile_2", "quartile_3", "view_completion", "spend", "video_views",
           "shares", "saves", "frequency", "total_installs", "uniques"]
RATIOS = ["swipe_up_percent", "frequency"]

# Checks: one row per (ad, day), and the rows that pass the gate.
_RANKED = ", ".join(f"{m} desc nulls last" for m in METRICS)


def day_sql(raw: str) -> str:
    """DAY rows in table shape out of uncleaned rows: one per (ad, day)."""
    return f"""
select ad_id || cast(stats_date as string) || 'DAY' as ad_id_date_granul, ad_id, stats_date,
       {', '.join(METRICS)}, 'DAY' as granularity,
       substr(cast(stats_date as string), 1, 7) as stats_month
from (select *, row_number() over (partition by ad_id, stats_date order by {_RANKED}) as place
      from ({raw}) r) d
where place = 1
"""


DAY = day_sql(DAY_RAW)
ACTIVE = ("(coalesce(impressions, 0) <> 0 or coalesce(spend, 0) <> 0 "
          "or coalesce(video_views, 0) <> 0)")
DAY_GATED = f"select * from ({DAY}) g where {ACTIVE}"


def doubles_sql(sql: str) -> str:
    """Ratios of a stats query as doubles (see ``readable``)."""
    casts = ", ".join(f"cast({m} as double) as {m}" for m in RATIOS)
    return f"select * replace ({casts}) from ({sql}) d"


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The source tables of one folder."""
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES}


def frame(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the texts above (or a query on top of them) over a folder's tables.

    Tables are handed over as arguments, so nothing is registered in the session.
    """
    used = [t for t in SOURCES if re.search(rf"\b(from|join)\s+{t}\b", text)]
    named = re.sub(rf"\b(from|join)(\s+)({'|'.join(SOURCES)})\b", r"\1\2{\3}",
                   text.replace("{", "{{").replace("}", "}}"))
    return spark.sql(named, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def readable(df: DataFrame, rounded: dict[str, int] | None = None) -> DataFrame:
    """32-bit floats as doubles, optionally rounded, for comparison with a check."""
    rounded = rounded or {}
    floats = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
              if f.dataType.typeName() in ("float", "double")}
    return df.withColumns({c: F.round(v, rounded[c]) if c in rounded else v
                           for c, v in floats.items()}) if floats else df
