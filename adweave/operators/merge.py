"""Set-based upserts: one generic merge, policies as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions.scalars import has_activity, nonblank


def merge_upsert(existing: DataFrame, incoming: DataFrame, keys: list[str],
                 update: dict[str, str]) -> DataFrame:
    """Existing rows, updated and extended by ``incoming``; nothing is deleted.

    Both sides hold at most one row per key. On a match the columns named in
    ``update`` (target -> incoming column) take the incoming value even when it is
    NULL, all others are kept. Unmatched incoming rows are inserted.

    Keys are unique on both sides, so the full outer join cannot be skewed by one
    key, and an incoming side that was just deduplicated by the same keys is not
    shuffled again.
    """
    columns = existing.columns
    old = existing.withColumnsRenamed({c: f"_old_{c}" for c in columns if c not in keys}) \
        .withColumn("_in_old", F.lit(True))
    wanted = [c for c in incoming.columns if c not in keys]
    new = incoming.withColumnsRenamed({c: f"_new_{c}" for c in wanted}) \
        .withColumn("_in_new", F.lit(True))
    joined = old.join(new, keys, "full_outer")

    def value(c: str) -> str:
        if c in keys:
            return c
        added = f"_new_{c}" if c in wanted else "NULL"
        if c not in update:
            return f"if(_in_old is null, {added}, _old_{c}) as {c}"
        source = update[c] if update[c] in keys else f"_new_{update[c]}"
        return f"case when _in_old is null then {added} when _in_new is null then _old_{c} " \
               f"else {source} end as {c}"

    return joined.selectExpr(*[value(c) for c in columns])


@dataclass(frozen=True)
class UpsertPolicy:
    """What a load does to one table.

    ``update``: columns assigned on a match (target -> incoming column).
    ``guard``: key columns that must be non-blank for a row to be loaded.
    ``gated``: incoming rows without activity are ignored.
    ``granularity``: the slice of a fact table the load works on.
    """

    table: str
    keys: tuple[str, ...]
    update: dict[str, str] = field(default_factory=dict)
    guard: tuple[str, ...] = ()
    gated: bool = False
    granularity: str | None = None


def _same(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


_STAMPED = {"updated_on": "updated_on"}
_CAMPAIGN_UPDATE = [
    "campaign_updated_at", "campaign_end_time", "campaign_status", "ad_account_id",
    "lifetime_spend_cap_micro", "campaign_daily_budget_micro", "objective", "buy_model",
    "campaign_name"]
_AD_UPDATE = ["ad_updated_at", "ad_created_at", "ad_name", "ad_squad_id", "creative_id",
              "ad_status", "ad_type", "render_type", "review_status"]
_SQUAD_UPDATE = [c for c in S.columns_of("ad_squad")
                 if c not in ("ad_squad_id", "created_on", "updated_on")]

POLICIES: dict[str, UpsertPolicy] = {
    # DAY load: known dimensions only follow renames, audit dates stay.
    "campaign_name": UpsertPolicy("campaign", ("campaign_id",), _same("campaign_name"),
                                  guard=("campaign_id",)),
    "squad_name": UpsertPolicy("ad_squad", ("ad_squad_id",), _same("ad_squad_name"),
                               guard=("ad_squad_id",)),
    "ad_name": UpsertPolicy("ad", ("ad_id",), _same("ad_name"), guard=("ad_id",)),
    # Full load. A campaign keeps its first created_at and start_time.
    "campaign_full": UpsertPolicy("campaign", ("campaign_id",),
                                  _same(*_CAMPAIGN_UPDATE) | _STAMPED, guard=("campaign_id",)),
    "squad_full": UpsertPolicy("ad_squad", ("ad_squad_id",), _same(*_SQUAD_UPDATE) | _STAMPED,
                               guard=("ad_squad_id",)),
    "ad_full": UpsertPolicy("ad", ("ad_id",), _same(*_AD_UPDATE) | _STAMPED,
                            guard=("ad_id",)),
    # Trial load: the same columns, no guard, no audit dates.
    "campaign_trial": UpsertPolicy("campaign", ("campaign_id",), _same(*_CAMPAIGN_UPDATE)),
    "squad_trial": UpsertPolicy("ad_squad", ("ad_squad_id",), _same(*_SQUAD_UPDATE)),
    "ad_trial": UpsertPolicy("ad", ("ad_id",), _same(*_AD_UPDATE)),
    # Accounts from the seed; the older form only adds what is missing.
    "account_seed": UpsertPolicy(
        "ad_account", ("ad_account_id",),
        _same("ad_account_name", "ad_account_client", "ad_account_brand") | _STAMPED),
    "account_absent": UpsertPolicy("ad_account", ("ad_account_id",)),
    # Facts. Text keys are never rewritten, so they keep the first run's date.
    "day_stats": UpsertPolicy("ad_stats", ("ad_id", "stats_date"), _same(*S.STATS_METRICS),
                              guard=("ad_id",), gated=True, granularity=S.DAY),
    "lifetime_stats": UpsertPolicy(
        "ad_stats", ("ad_id",), _same(*S.STATS_METRICS, "stats_date"),
        guard=("ad_id",), gated=True, granularity=S.LIFETIME),
    "lifetime_trial": UpsertPolicy("ad_stats", ("ad_id",), _same(*S.TRIAL_METRICS),
                                   granularity=S.LIFETIME),
    # MONTH: a first load gates its inserts, a refresh gates nothing and moves stats_date.
    "month_first": UpsertPolicy("ad_stats", ("ad_id", "stats_month"), _same(*S.ROLLUP_METRICS),
                                gated=True, granularity=S.MONTH),
    "month_refresh": UpsertPolicy(
        "ad_stats", ("ad_id", "stats_month"),
        _same(*S.ROLLUP_METRICS) | {"stats_date": "refreshed_on"}, granularity=S.MONTH),
    "geo": UpsertPolicy(
        "ad_geo", ("ad_id", "dma"),
        _same(*S.GEO_COUNTS, *S.GEO_RATIOS, "country", "region"), granularity=S.LIFETIME),
}


def policy_rows(p: UpsertPolicy, incoming: DataFrame) -> DataFrame:
    """The incoming rows a policy lets through."""
    for c in p.guard:
        incoming = incoming.where(nonblank(F.col(c)))
    return incoming.where(has_activity()) if p.gated else incoming


def apply_policy(policy: str | UpsertPolicy, existing: DataFrame,
                 incoming: DataFrame) -> DataFrame:
    """Merge already cleaned, deduplicated rows into a table (or its slice).

    ``existing`` holds every row of the policy's slice that a key may match, and
    nothing of another granularity.
    """
    p = POLICIES[policy] if isinstance(policy, str) else policy
    return merge_upsert(existing, policy_rows(p, incoming), list(p.keys), p.update)
