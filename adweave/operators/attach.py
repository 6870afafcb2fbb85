"""Outer joins of the account -> campaign -> ad squad -> ad -> stats hierarchy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave.session import counted, packed


def _same(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    pair = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b,
                  [l.eqNullSafe(r) if null_safe else l == r for l, r in pair])


def outer_attach(child: DataFrame, parent: DataFrame, keys: str | list[str],
                 suffixes: tuple[str, str] = ("_y", "_x"),
                 null_safe: bool = False) -> DataFrame:
    """``child FULL OUTER JOIN parent`` on ``keys``, planned to survive a hot parent.

    A full outer join can neither broadcast nor split a skewed partition. It equals
    the left join from the child plus the parents no child points to. The left join
    broadcasts when Spark measures the parent as small, and otherwise AQE splits a
    hot parent's children over several tasks; the anti join needs only the distinct
    child keys, combined before the shuffle. Those are as many as the child has, so they
    are not broadcast whatever their estimate.

    Non-key columns present on both sides get ``suffixes`` (child, parent).
    ``null_safe`` lets missing keys match missing keys.
    """
    keys = [keys] if isinstance(keys, str) else keys
    both = (set(child.columns) & set(parent.columns)) - set(keys)
    child_names = {c: c + suffixes[0] if c in both else c for c in child.columns}
    parent_names = {c: c + suffixes[1] if c in both else c for c in parent.columns}
    c, p = child.withColumnsRenamed(child_names).alias("c"), \
        parent.withColumnsRenamed(parent_names).alias("p")

    child_cols = [F.col(f"c.{child_names[x]}") for x in child.columns]
    parent_cols = [F.col(f"p.{parent_names[x]}") for x in parent.columns if x not in keys]
    attached = c.join(p, _same("c", "p", keys, null_safe), "left").select(
        *child_cols, *parent_cols)

    used = child.select(*keys).distinct().hint("merge").alias("u")
    childless = p.join(used, _same("p", "u", keys, null_safe), "left_anti")
    return attached.unionByName(childless, allowMissingColumns=True)


def inherit(ads: DataFrame, accounts: DataFrame, key: str = "ad_account_id",
            columns: list[str] | None = None) -> DataFrame:
    """Many-to-one lookup: each row gets its account's columns (timezone by default).

    No hint: Spark broadcasts the accounts when it measures them as small.
    """
    columns = columns or ["timezone"]
    return ads.join(accounts.select(key, *columns), key, "inner")


def attach_hierarchy(campaigns: DataFrame, squads: DataFrame, ads: DataFrame) -> DataFrame:
    """Dimensions joined: every ad, plus childless squads and campaigns.

    Both joins read their inputs twice, so each level is written once and read back.
    """
    parents = packed(outer_attach(squads, counted(campaigns), "campaign_id"), "parents")
    return packed(outer_attach(ads, counted(parents), "ad_squad_id").select(
        "ad_squad_id", *[c for c in ads.columns if c != "ad_squad_id"],
        *[c for c in parents.columns if c != "ad_squad_id"]), "hierarchy")


def wide_extract(campaigns: DataFrame, squads: DataFrame, ads: DataFrame,
                 stats: DataFrame) -> DataFrame:
    """Grain (ad, day) plus childless campaigns, squads and ads, plus orphan stats.

    The facts take part in a single join. Joining the dimensions first gives the
    same rows as joining them one by one onto the facts as long as dimension ids are
    never missing and come once; readers of payloads see to both, others must.
    """
    return attach_facts(stats, attach_hierarchy(campaigns, squads, ads))


def attach_facts(facts: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Facts around an already joined and written hierarchy."""
    return outer_attach(facts, counted(hierarchy), "ad_id")


def geo_with_lifetime(geo: DataFrame, lifetime: DataFrame) -> DataFrame:
    """Grain (ad, geo item); the ad's lifetime metrics repeat on each item.

    Both are facts, a row an ad or more, so neither is broadcast.
    """
    return outer_attach(geo, lifetime.hint("merge"), "ad_id", suffixes=("_x", "_y"))


def stack_frames(frames: list[DataFrame], ordered: bool = True) -> DataFrame:
    """Union by name, missing columns become NULL; columns alphabetical by default."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*sorted(out.columns)) if ordered else out


def already_loaded(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key exists. Existing keys shrink to one each before the shuffle."""
    return incoming.join(existing.select(*keys).distinct(), keys, "left_semi")


def not_yet_loaded(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key does not exist."""
    return incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
