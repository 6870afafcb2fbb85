"""Hierarchy joins, membership and carry-forward."""

from __future__ import annotations

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.operators import attach as A
from adweave.operators import carry as K
from adweave.standin import frames as T
from adweave.standin.catalog import query

# Returned items belong to ads that are not in the ad list any more.
_STATS = f"""
select case when l_returnflag = 'R' then 'gone ' || cast(l_orderkey as string)
            else cast(l_orderkey as string) end as ad_id,
       cast(l_shipdate as date) as stats_date, l_linenumber as line,
       cast(round(l_discount * 100) as bigint) as impressions,
       cast(round(l_tax * 100) as bigint) as spend
from lineitem
"""
_ADS = f"select ad_id, ad_squad_id, ad_name, ad_status, ad_created_at from ({T.AD}) a"


@query("ads_outer_stats", f"""
select coalesce(a.ad_id, s.ad_id) as ad_id, ad_squad_id, ad_name, ad_status, ad_created_at,
       stats_date, line, impressions, spend
from ({_ADS}) a full join ({_STATS}) s on a.ad_id = s.ad_id
""")
def ads_outer_stats(spark, sf):
    return A.outer_attach(T.frame(spark, sf, _STATS), T.frame(spark, sf, _ADS), "ad_id")


# Squads of one segment have lost their campaign; both sides carry audit dates.
_LOOSE_SQUADS = f"""
select ad_squad_id, case when ad_squad_status = 'MACHINERY' then null else campaign_id end
           as campaign_id, ad_squad_name, created_on, updated_on from ({T.AD_SQUAD}) s
"""
_LOOSE_CAMPAIGNS = f"""
select case when campaign_status = 'PAUSED' and ad_account_id = '4' then null else campaign_id end
           as campaign_id, campaign_name, created_on, updated_on from ({T.CAMPAIGN}) c
"""


@query("null_safe_outer", f"""
select coalesce(s.campaign_id, c.campaign_id) as campaign_id, ad_squad_id, ad_squad_name,
       campaign_name, s.created_on as created_on_y, s.updated_on as updated_on_y,
       c.created_on as created_on_x, c.updated_on as updated_on_x
from ({_LOOSE_CAMPAIGNS}) c full join ({_LOOSE_SQUADS}) s
  on c.campaign_id is not distinct from s.campaign_id
""")
def null_safe_outer(spark, sf):
    return A.outer_attach(T.frame(spark, sf, _LOOSE_SQUADS), T.frame(spark, sf, _LOOSE_CAMPAIGNS),
                          "campaign_id", null_safe=True)


_DIMS = {t: [c for c in S.columns_of(t) if c not in ("created_on", "updated_on")]
         for t in ("campaign", "ad_squad", "ad")}
_FACTS = f"""
select case when saves = 4 then 'gone ' || ad_id else ad_id end as ad_id,
       stats_date as adstats_date, {', '.join(S.COUNT_METRICS)} from ({T.DAY_RAW}) d
"""
_WIDE_COLUMNS = [
    "coalesce(j1.campaign_id, c.campaign_id) as campaign_id",
    *[f"c.{x}" for x in _DIMS["campaign"] if x != "campaign_id"],
    *[f"j1.{x}" for x in _DIMS["ad_squad"] if x != "campaign_id"],
    *[f"j1.{x}" for x in _DIMS["ad"] if x != "ad_squad_id"],
    "j1.adstats_date", *[f"j1.{m}" for m in S.COUNT_METRICS],
]
WIDE_SQL = f"""
with j0 as (
  select coalesce(a.ad_id, f.ad_id) as ad_id, a.* exclude (ad_id), f.* exclude (ad_id)
  from ({T.AD}) a full join ({_FACTS}) f on a.ad_id = f.ad_id),
j1 as (
  select coalesce(j0.ad_squad_id, s.ad_squad_id) as ad_squad_id, s.* exclude (ad_squad_id),
         j0.* exclude (ad_squad_id)
  from ({T.AD_SQUAD}) s full join j0 on s.ad_squad_id is not distinct from j0.ad_squad_id)
select {', '.join(_WIDE_COLUMNS)}
from ({T.CAMPAIGN}) c full join j1 on c.campaign_id is not distinct from j1.campaign_id
"""


@query("wide_extract", WIDE_SQL)
def wide_extract(spark, sf):
    dims = [T.frame(spark, sf, text).select(*_DIMS[t]) for t, text in
            (("campaign", T.CAMPAIGN), ("ad_squad", T.AD_SQUAD), ("ad", T.AD))]
    return A.wide_extract(*dims, T.frame(spark, sf, _FACTS))


_LIFETIME = f"""
select ad_id, sum(impressions) as impressions, sum(spend) as spend from ({T.DAY_RAW}) d
group by ad_id
"""
_GEO = f"""
select ad_id, dma, country, region, geo_impressions, geo_swipes, geo_uniques, geo_spend
from ({T.GEO_RAW}) g
"""


@query("geo_outer_stats", f"""
select coalesce(g.ad_id, l.ad_id) as ad_id, dma, country, region, geo_impressions, geo_swipes,
       geo_uniques, geo_spend, cast(impressions as bigint) as impressions,
       cast(spend as bigint) as spend
from ({_GEO}) g full join ({_LIFETIME}) l on g.ad_id = l.ad_id
""")
def geo_outer_stats(spark, sf):
    return A.geo_with_lifetime(T.frame(spark, sf, _GEO), T.frame(spark, sf, _LIFETIME))


@query("matched_ids", f"""
select ad_id, ad_name from ({_ADS}) a where exists (select 1 from ({_STATS}) s
                                                    where s.ad_id = a.ad_id)
""")
def matched_ids(spark, sf):
    return A.already_loaded(T.frame(spark, sf, _ADS), T.frame(spark, sf, _STATS),
                            ["ad_id"]).select("ad_id", "ad_name")


@query("new_ids", f"""
select ad_id, stats_date, line from ({_STATS}) s where not exists (
  select 1 from ({_ADS}) a where a.ad_id = s.ad_id)
""")
def new_ids(spark, sf):
    return A.not_yet_loaded(T.frame(spark, sf, _STATS), T.frame(spark, sf, _ADS),
                            ["ad_id"]).select("ad_id", "stats_date", "line")


# Each event reports one metric of its user; small values are explicit nulls.
_KINDS = ["click", "error", "purchase", "signup", "view"]


_LAST = ", ".join(
    f"last_value(case when event_type = '{k}' then struct_pack(v := case when value >= 5 "
    f"then value end) end ignore nulls) over w as {k}" for k in _KINDS)


@query("carry_forward", f"""
select event_id, ad_id, {', '.join(f'{k}.v as {k}' for k in _KINDS)}
from (select event_id, cast(user_id as string) as ad_id, {_LAST} from events
      window w as (partition by user_id order by ts, event_id
                   rows between unbounded preceding and current row)) e
""")
def carry_forward(spark, sf):
    rows = T.frame(spark, sf, """
        select event_id, cast(user_id as string) as ad_id, ts, event_type, value from events""")
    rows = rows.select("event_id", "ad_id", "ts", F.create_map(
        "event_type", F.when(F.col("value") >= 5, F.col("value"))).alias("stats"))
    return K.carry_rows(rows, ["ad_id"], ["ts", "event_id"], "stats", _KINDS) \
        .select("event_id", "ad_id", *_KINDS)
