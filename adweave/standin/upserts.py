"""Upserts: what a table holds after a load, checked against a full join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions import scalars as X
from adweave.operators.merge import apply_policy
from adweave.operators.rollup import in_range, month_rows, split_new_months
from adweave.sources import extract as E
from adweave.sources.warehouse import account_rows, empty_table
from adweave.standin import frames as T
from adweave.standin.catalog import query

RUN = dt.date(2020, 5, 17)
_RUN = "date '2020-05-17'"


# What each load assigns on a match, stated here once more so that the checks do not follow
# the policies (fixed values): table, key columns, assigned columns (target=source).
_ASSIGNED = {
    "campaign_name": ("campaign", "campaign_id", "campaign_name"),
    "squad_name": ("ad_squad", "ad_squad_id", "ad_squad_name"),
    "ad_name": ("ad", "ad_id", "ad_name"),
    "campaign_full": ("campaign", "campaign_id",
                      "campaign_updated_at campaign_end_time campaign_status ad_account_id "
                      "lifetime_spend_cap_micro campaign_daily_budget_micro objective buy_model "
                      "campaign_name updated_on"),
    "squad_full": ("ad_squad", "ad_squad_id",
                   "campaign_id ad_squad_name ad_squad_status ad_squad_type targeting_reach_status "
                   "placement billing_event optimization_goal delivery_constraint pacing_type "
                   "auto_bid target_bid reach_and_frequency_status "
                   "reach_and_frequency_debug_message reserved_status reserved_debug_message "
                   "ad_squad_created_at ad_squad_updated_at ad_squad_start_time ad_squad_end_time "
                   "bid_micro ad_squad_daily_budget_micro lifetime_budget_micro impression_goal "
                   "reach_goal reach_and_frequency_rate_micro reserved_rate_micro updated_on"),
    "ad_full": ("ad", "ad_id",
                "ad_updated_at ad_created_at ad_name ad_squad_id creative_id ad_status ad_type "
                "render_type review_status updated_on"),
    "account_seed": ("ad_account", "ad_account_id",
                     "ad_account_name ad_account_client ad_account_brand updated_on"),
    "account_absent": ("ad_account", "ad_account_id", ""),
    "day_stats": ("ad_stats", "ad_id stats_date",
                  "impressions swipes swipe_up_percent view_time_millis screen_time_millis "
                  "quartile_1 quartile_2 quartile_3 view_completion spend video_views shares saves "
                  "frequency total_installs uniques"),
    "lifetime_stats": ("ad_stats", "ad_id",
                       "impressions swipes swipe_up_percent view_time_millis screen_time_millis "
                       "quartile_1 quartile_2 quartile_3 view_completion spend video_views shares "
                       "saves frequency total_installs uniques stats_date"),
    "lifetime_trial": ("ad_stats", "ad_id",
                       "impressions swipes quartile_1 quartile_2 quartile_3 view_completion spend "
                       "view_time_millis video_views screen_time_millis shares saves"),
    "month_refresh": ("ad_stats", "ad_id stats_month",
                      "impressions swipes quartile_1 quartile_2 quartile_3 view_completion spend "
                      "video_views shares saves frequency uniques stats_date=refreshed_on"),
    "geo": ("ad_geo", "ad_id dma",
            "geo_impressions geo_swipes geo_uniques geo_spend geo_impression_composition "
            "geo_unique_composition country region"),
}
_ASSIGNED |= {f"{e}_trial": (t, k, c.removesuffix(" updated_on"))
              for e in ("campaign", "squad", "ad") for t, k, c in [_ASSIGNED[f"{e}_full"]]}
_METRICS = T.METRICS
_TRIAL = _ASSIGNED["lifetime_trial"][2].split()
_ROLLUP = _ASSIGNED["month_refresh"][2].split()[:-1]
_RATIOS = T.RATIOS
_GEO = _ASSIGNED["geo"][2].split()[:-2]
_DAY_SQUAD = ("ad_squad_id ad_squad_updated_at ad_squad_created_at ad_squad_name ad_squad_status "
              "ad_squad_type campaign_id targeting_reach_status placement billing_event bid_micro "
              "auto_bid target_bid ad_squad_start_time ad_squad_end_time optimization_goal "
              "delivery_constraint pacing_type lifetime_budget_micro").split()


def merge_sql(policy: str, old: str, new: str) -> str:
    """The check of an upsert: full join plus a choice per column."""
    table, keys, assigned = _ASSIGNED[policy]
    keys = keys.split()
    update = dict((x.split("=") * 2)[:2] for x in assigned.split())
    on = " and ".join(f"o.{k} = n.{k}" for k in keys)
    cols = []
    for c in S.columns_of(table):
        if c in keys:
            cols.append(f"coalesce(o.{c}, n.{c}) as {c}")
        elif c in update:
            cols.append(f"case when n.{keys[0]} is null then o.{c} "
                        f"when o.{keys[0]} is null then n.{c} else n.{update[c]} end as {c}")
        else:
            cols.append(f"case when o.{keys[0]} is null then n.{c} else o.{c} end as {c}")
    return f"select {', '.join(cols)} from ({old}) o full join ({new}) n on {on}"


# --- dimensions ---------------------------------------------------------------------
# The table holds what was created before a cut; the extract brings every entity, renamed,
# with new dates and states, twice (the older version must lose).

_CHANGED = {
    "campaign": f"""
select * replace (campaign_name || ' v2' as campaign_name,
                  campaign_updated_at + 30 as campaign_updated_at,
                  campaign_start_time + 30 as campaign_start_time,
                  case when ad_account_id = '1' then null else 'AUCTION 2' end as buy_model,
                  campaign_daily_budget_micro + 1 as campaign_daily_budget_micro,
                  {_RUN} as created_on, {_RUN} as updated_on) from ({T.CAMPAIGN}) c""",
    "ad_squad": f"""
select * replace (ad_squad_name || ' v2' as ad_squad_name,
                  ad_squad_updated_at + 30 as ad_squad_updated_at,
                  case when ad_squad_status = 'BUILDING' then null
                       else ad_squad_end_time end as ad_squad_end_time,
                  bid_micro + 5 as bid_micro,
                  {_RUN} as created_on, {_RUN} as updated_on) from ({T.AD_SQUAD}) s""",
    "ad": f"""
select * replace (ad_name || ' v2' as ad_name,
                  case when ad_status = 'F' then null else ad_updated_at + 30 end
                      as ad_updated_at,
                  'creative 2' as creative_id,
                  {_RUN} as created_on, {_RUN} as updated_on) from ({T.AD}) a""",
}
_BASE = {"campaign": T.CAMPAIGN, "ad_squad": T.AD_SQUAD, "ad": T.AD}
_CUT = {"campaign": "campaign_created_at < date '2019-01-15'",
        "ad_squad": "ad_squad_created_at < date '2019-01-15'",
        "ad": "ad_created_at < date '1998-01-01'"}


def _old(entity: str) -> str:
    return f"select * from ({_BASE[entity]}) b where {_CUT[entity]}"


def _spark_changed(spark, sf, entity: str):
    """The same change as in ``_CHANGED``, written with DataFrame calls."""
    df = T.frame(spark, sf, _BASE[entity])
    name = f"{entity}_name"
    changes = {name: F.concat(name, F.lit(" v2"))}
    if entity == "campaign":
        changes |= {
            "campaign_updated_at": F.date_add("campaign_updated_at", 30),
            "campaign_start_time": F.date_add("campaign_start_time", 30),
            "buy_model": F.when(F.col("ad_account_id") != "1", "AUCTION 2"),
            "campaign_daily_budget_micro": F.col("campaign_daily_budget_micro") + 1}
    elif entity == "ad_squad":
        changes |= {
            "ad_squad_updated_at": F.date_add("ad_squad_updated_at", 30),
            "ad_squad_end_time": F.when(F.col("ad_squad_status") != "BUILDING",
                                        F.col("ad_squad_end_time")),
            "bid_micro": F.col("bid_micro") + 5}
    else:
        changes |= {
            "ad_updated_at": F.when(F.col("ad_status") != "F", F.date_add("ad_updated_at", 30)),
            "creative_id": F.lit("creative 2")}
    return df.withColumns(changes)


def _extract_text(spark, sf, entity: str):
    """Extract rows of one entity: text, each entity in two versions, blank end times."""
    own = [c for c in S.columns_of(entity) if c not in ("created_on", "updated_on")]
    new = E.as_extract(_spark_changed(spark, sf, entity), own)
    # The stale version has no updated_at, so it loses to any dated one; where both
    # lack it the larger remaining columns win, which the "v2" names are.
    stale = new.withColumns({f"{entity}_updated_at": F.lit(""),
                             f"{entity}_name": F.lit("")})
    rows = new.unionByName(stale)
    end = f"{entity}_end_time"
    return rows.withColumn(end, F.coalesce(end, F.lit(" "))) if end in own else rows


def _dimension(policy: str, entity: str, columns: list[str] | None = None,
               trial: bool = False):
    def run(spark, sf):
        incoming = E.entity_rows(_extract_text(spark, sf, entity), entity, F.lit(RUN), columns,
                                 trial=trial)
        return apply_policy(policy, T.frame(spark, sf, _old(entity)), incoming)

    return run


def _known(entity: str, columns: list[str], rows: str | None = None) -> str:
    """Rows of which only some columns are known."""
    types = {"string": "string", "long": "bigint", "date": "date"}
    keep = set(columns) | {"created_on", "updated_on"}
    cols = [c.name if c.name in keep else
            f"cast(null as {types[c.dataType.typeName()]}) as {c.name}"
            for c in S.table_schema(entity).fields]
    return f"select {', '.join(cols)} from ({rows or _CHANGED[entity]}) k"


query("upsert_campaign_name", merge_sql("campaign_name", _old("campaign"),
                                        _CHANGED["campaign"]))(
    _dimension("campaign_name", "campaign"))
query("upsert_squad_name", merge_sql("squad_name", _old("ad_squad"),
                                     _known("ad_squad", _DAY_SQUAD)))(
    _dimension("squad_name", "ad_squad", S.DAY_SQUAD_COLUMNS))
query("upsert_ad_name", merge_sql("ad_name", _old("ad"), _CHANGED["ad"]))(
    _dimension("ad_name", "ad"))
query("upsert_campaign_full", merge_sql("campaign_full", _old("campaign"),
                                        _CHANGED["campaign"]))(
    _dimension("campaign_full", "campaign"))
query("upsert_squad_full", merge_sql("squad_full", _old("ad_squad"), _CHANGED["ad_squad"]))(
    _dimension("squad_full", "ad_squad"))
query("upsert_ad_full", merge_sql("ad_full", _old("ad"), _CHANGED["ad"]))(
    _dimension("ad_full", "ad"))

for _entity, _policy in (("campaign", "campaign_trial"), ("ad_squad", "squad_trial"),
                         ("ad", "ad_trial")):
    query(f"upsert_{_policy}", merge_sql(_policy, _old(_entity), f"""
        select * replace (cast(null as date) as created_on, cast(null as date) as updated_on)
        from ({_CHANGED[_entity]}) t"""))(_dimension(_policy, _entity, trial=True))


# --- accounts -----------------------------------------------------------------------

_SEED = """
select cast(n_regionkey * 2 as string) as ad_account_id, 'seed ' || min(n_name) as ad_account_name,
       'client ' || max(n_name) as ad_account_client, 'brand 2' as ad_account_brand
from nation group by n_regionkey
"""
_SEED_ROWS = f"""
select ad_account_id, ad_account_name, ad_account_client, ad_account_brand,
       cast(null as string) as ad_account_timezone, 'YES' as ad_account_include_ind,
       {_RUN} as created_on, {_RUN} as updated_on from ({_SEED}) s
"""


@query("upsert_account", merge_sql("account_seed", T.ACCOUNT, _SEED_ROWS))
def upsert_account(spark, sf):
    return apply_policy("account_seed", T.frame(spark, sf, T.ACCOUNT),
                        account_rows(T.frame(spark, sf, _SEED), F.lit(RUN)))


@query("insert_account_absent", merge_sql("account_absent", T.ACCOUNT, _SEED_ROWS))
def insert_account_absent(spark, sf):
    return apply_policy("account_absent", T.frame(spark, sf, T.ACCOUNT),
                        account_rows(T.frame(spark, sf, _SEED), F.lit(RUN)))


# --- DAY facts ----------------------------------------------------------------------
# The table holds days before 1999; the load restates December 1998 and brings the rest.
# Incoming swipes become NULL, impressions grow, one status is restated to zero.

_OLD_DAY = f"select * from ({T.DAY_GATED}) d where stats_date < date '1999-01-01'"
_NEW_DAY = f"""
select * from (select * replace (impressions + 100 as impressions, cast(null as bigint) as swipes)
               from ({T.DAY}) d where stats_date >= date '1998-12-01') n where {T.ACTIVE}
"""
DAY_SQL = T.doubles_sql(merge_sql("day_stats", _OLD_DAY, _NEW_DAY))


def _day_tables(spark, sf):
    day = E.day_rows(T.frame(spark, sf, T.DAY_TEXT))
    old = day.where((F.col("stats_date") < dt.date(1999, 1, 1)) & X.has_activity())
    new = day.where(F.col("stats_date") >= dt.date(1998, 12, 1)).withColumns({
        "impressions": F.col("impressions") + 100, "swipes": F.lit(None).cast("bigint")})
    return old, new


@query("upsert_day_stats", DAY_SQL)
def upsert_day_stats(spark, sf):
    old, new = _day_tables(spark, sf)
    return T.readable(apply_policy("day_stats", old, new))


# --- LIFETIME facts ------------------------------------------------------------------

_LIFETIME = f"""
select ad_id, max(stats_date) as last_day,
       {', '.join(f'cast(sum({m}) as bigint) as {m}' for m in S.COUNT_METRICS)},
       max(frequency) as frequency, max(swipe_up_percent) as swipe_up_percent
from ({T.DAY_RAW}) d group by ad_id
"""


def _lifetime_sql(run: str, metrics: list[str], extra: str = "") -> str:
    shown = [m if m in metrics else
             f"cast(null as {'float' if m in _RATIOS else 'bigint'}) as {m}"
             for m in _METRICS]
    return f"""select ad_id || cast({run} as string) || 'LIFETIME' as ad_id_date_granul, ad_id,
       {run} as stats_date, {', '.join(shown)}, 'LIFETIME' as granularity, 'all' as stats_month
from ({_LIFETIME}) l {extra}"""


_FIRST_RUN = "date '2020-04-01'"
_OLD_LIFETIME = _lifetime_sql(_FIRST_RUN, _METRICS,
                              f"where last_day < date '2000-01-01' and {T.ACTIVE}")
_NEW_LIFETIME = f"""select * from (select * replace (impressions + 7 as impressions)
                    from ({_lifetime_sql(_RUN, _METRICS)}) x) n where {T.ACTIVE}"""


def _lifetime_text(spark, sf, bump: int = 0):
    return T.frame(spark, sf, f"select * from ({_LIFETIME}) l").withColumn(
        "impressions", F.concat((F.col("impressions") + bump).cast("string"), F.lit(".9")))


@query("upsert_lifetime", T.doubles_sql(merge_sql("lifetime_stats", _OLD_LIFETIME, _NEW_LIFETIME)))
def upsert_lifetime(spark, sf):
    first = _lifetime_text(spark, sf).where(F.col("last_day") < dt.date(2000, 1, 1))
    old = E.lifetime_rows(first, F.lit(dt.date(2020, 4, 1))).where(X.has_activity())
    new = E.lifetime_rows(_lifetime_text(spark, sf, 7), F.lit(RUN))
    return T.readable(apply_policy("lifetime_stats", old, new))


_OLD_TRIAL = _lifetime_sql(_FIRST_RUN, _TRIAL, "where last_day < date '2000-01-01'")
_NEW_TRIAL = f"""select * replace (impressions + 7 as impressions)
                 from ({_lifetime_sql(_RUN, _TRIAL)}) x"""


@query("upsert_lifetime_trial",
       T.doubles_sql(merge_sql("lifetime_trial", _OLD_TRIAL, _NEW_TRIAL)))
def upsert_lifetime_trial(spark, sf):
    first = _lifetime_text(spark, sf).where(F.col("last_day") < dt.date(2000, 1, 1))
    old = E.lifetime_rows(first, F.lit(dt.date(2020, 4, 1)), S.TRIAL_METRICS, guarded=False)
    new = E.lifetime_rows(_lifetime_text(spark, sf, 7), F.lit(RUN), S.TRIAL_METRICS,
                          guarded=False)
    return T.readable(apply_policy("lifetime_trial", old, new))


# --- MONTH facts ---------------------------------------------------------------------

def month_sql(day: str, refreshed: str = "cast(null as date)") -> str:
    """MONTH rows of DAY rows, in table shape."""
    shown = [f"cast(sum({m}) as {'float' if m in _RATIOS else 'bigint'}) as {m}"
             if m in _ROLLUP else
             f"cast(null as {'float' if m in _RATIOS else 'bigint'}) as {m}"
             for m in _METRICS]
    return f"""
select ad_id || cast(month_start as string) || 'MONTH' as ad_id_date_granul, ad_id,
       month_start as stats_date, {', '.join(_METRICS)}, 'MONTH' as granularity,
       substr(cast(month_start as string), 1, 7) as stats_month,
       greatest(month_start, least({refreshed}, last_day(month_start))) as refreshed_on
from (select ad_id, cast(date_trunc('month', stats_date) as date) as month_start,
             {', '.join(shown)} from ({day}) d group by 1, 2) m"""


def month_check(sql: str) -> str:
    return f"select * replace (round(frequency, 4) as frequency) from ({T.doubles_sql(sql)}) r"


_ALL_MONTHS = month_sql(T.DAY_GATED)


@query("month_first_load", month_check(
    f"select * exclude (refreshed_on) from ({_ALL_MONTHS}) m where {T.ACTIVE}"))
def month_first_load(spark, sf):
    """First load of every month: gated inserts into an empty table."""
    day = E.day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity())
    return T.readable(apply_policy("month_first", empty_table(spark, "ad_stats"),
                                   month_rows(day)), {"frequency": 4})


@query("month_history", month_check(
    f"select * exclude (refreshed_on) from ({_ALL_MONTHS}) m where {T.ACTIVE} "
    "and stats_date between date '1998-01-01' and date '1999-04-30'"))
def month_history(spark, sf):
    """16 listed months in one grouped pass."""
    day = E.day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity())
    day = in_range(day, S.DAY, F.lit(dt.date(1998, 1, 1)), F.lit(dt.date(1999, 4, 30)))
    return T.readable(apply_policy("month_first", empty_table(spark, "ad_stats"),
                                   month_rows(day)), {"frequency": 4})


# Later run: the table was loaded from days before the 20th, now every day is there.
_EARLY = f"select * from ({T.DAY_GATED}) e where day(stats_date) < 20"
_MONTHS_OLD = f"select * exclude (refreshed_on) from ({month_sql(_EARLY)}) m where {T.ACTIVE}"
_REFRESH = "date '1999-07-25'"
_MONTHS_NEW = month_sql(T.DAY_GATED, _REFRESH)


def _month_tables(spark, sf):
    day = E.day_rows(T.frame(spark, sf, T.DAY_TEXT)).where(X.has_activity())
    old = month_rows(day.where(F.dayofmonth("stats_date") < 20)).where(X.has_activity())
    return old, month_rows(day, F.lit(dt.date(1999, 7, 25)))


@query("month_refresh", month_check(merge_sql("month_refresh", _MONTHS_OLD, _MONTHS_NEW)))
def month_refresh(spark, sf):
    old, new = _month_tables(spark, sf)
    return T.readable(apply_policy("month_refresh", old, new), {"frequency": 4})


_PARTLY_OLD = f"select * from ({_MONTHS_OLD}) p where stats_month < '1999-01'"


@query("month_dispatch", month_check(f"""
select * from ({merge_sql('month_refresh', _PARTLY_OLD, _MONTHS_NEW)}) m
where stats_month in (select stats_month from ({_PARTLY_OLD}) k)
union all by name
select * exclude (refreshed_on) from ({_MONTHS_NEW}) f
where stats_month not in (select stats_month from ({_PARTLY_OLD}) k) and {T.ACTIVE}
"""))
def month_dispatch(spark, sf):
    """Months without any row get the gated first load, all others a refresh."""
    old, new = _month_tables(spark, sf)
    old = old.where(F.col("stats_month") < "1999-01")
    first, again = split_new_months(new, old)
    refreshed = apply_policy("month_refresh", old, again)
    first = first.where(X.has_activity())
    return T.readable(refreshed.unionByName(first.select(*refreshed.columns)),
                      {"frequency": 4})


# --- geo facts -----------------------------------------------------------------------

_GEO_RANK = ", ".join(f"{c} desc nulls last" for c in
                      [*_GEO, "country", "region"])


def geo_sql(raw: str, run: str) -> str:
    return f"""
select ad_id || dma || cast({run} as string) || 'LIFETIME' as ad_id_dma_granul_date, ad_id, dma,
       country, region, {run} as geo_date, {', '.join(_GEO)},
       'LIFETIME' as granularity
from (select *, row_number() over (partition by ad_id, dma order by {_GEO_RANK}) as place
      from ({raw}) r) g where place = 1"""


_OLD_GEO_RAW = f"select * from ({T.GEO_RAW}) g where dma in ('click', 'view')"
_NEW_GEO_RAW = f"select * replace (geo_spend + 1 as geo_spend) from ({T.GEO_RAW}) g " \
               "where dma <> 'click'"


@query("upsert_geo", merge_sql("geo", geo_sql(_OLD_GEO_RAW, _FIRST_RUN),
                               geo_sql(_NEW_GEO_RAW, _RUN)))
def upsert_geo(spark, sf):
    raw = T.frame(spark, sf, T.GEO_RAW)
    old = E.geo_rows(raw.where(F.col("dma").isin("click", "view")), F.lit(dt.date(2020, 4, 1)))
    new = raw.where(F.col("dma") != "click").withColumn("geo_spend", F.col("geo_spend") + 1)
    return apply_policy("geo", old, E.geo_rows(new, F.lit(RUN)))
