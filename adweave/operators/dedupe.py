"""One row per key, distinct ids and distinct rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the largest by ``order``, then by every other column.

    The winner is the maximum of one struct, so it is deterministic (NULL sorts
    lowest) and the aggregate combines before the shuffle: a key holding a third of
    the rows sends one row per input task, never its whole group.
    """
    order = order or []
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = order + rest
    if not ranked:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[c if c in keys else f"_best.{c}" for c in df.columns])


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
