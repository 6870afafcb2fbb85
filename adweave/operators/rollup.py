"""DAY facts to MONTH facts, and range reads of existing facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions import scalars as X
from adweave.functions.calendar import month_first


def month_sums(day: DataFrame) -> DataFrame:
    """Every (ad, month) in one pass; partial sums combine before the shuffle."""
    return _month_sums(day).drop("stats_month")


def _month_sums(day: DataFrame) -> DataFrame:
    """Grouped by the key of every MONTH merge, so that a merge does not shuffle the sums again."""
    start = month_first(F.col("stats_date"))
    return day.groupBy("ad_id", X.month_text(start).alias("stats_month")).agg(
        F.min(start).alias("month_start"), *[F.sum(m).alias(m) for m in S.ROLLUP_METRICS])


def month_rows(day: DataFrame, refreshed_on: Column | None = None) -> DataFrame:
    """MONTH rows in table shape, one per (ad, month) with DAY rows.

    ``refreshed_on`` is the stats_date a refresh assigns to a known row; it is kept
    inside the month so that a refresh never moves a row to another partition.
    """
    sums = _month_sums(day)
    types = {f.name: f.dataType for f in S.table_schema("ad_stats").fields}
    metrics = [(F.col(m) if m in S.ROLLUP_METRICS else F.lit(None)).cast(types[m]).alias(m)
               for m in S.STATS_METRICS]
    start = F.col("month_start")
    rows = sums.select(
        X.stats_key(F.col("ad_id"), start, S.MONTH).alias("ad_id_date_granul"),
        "ad_id", start.alias("stats_date"), *metrics, F.lit(S.MONTH).alias("granularity"),
        "stats_month")
    if refreshed_on is None:
        return rows
    return rows.withColumn("refreshed_on", F.greatest(
        "stats_date", F.least(refreshed_on, F.last_day("stats_date"))))


def day_changes(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """ad_id, month_start, old, new: DAY rows a merge adds or whose summed metrics it changes.

    ``old`` and ``new`` are structs of the summed metrics, ``old`` null for a new row.
    """
    key = ["ad_id", "stats_date"]
    metrics = F.struct(*S.ROLLUP_METRICS)
    old = existing.select(*key, metrics.alias("old"))
    return incoming.select(*key, metrics.alias("new")).join(old, key, "left") \
        .where(F.isnull("old") | ~F.col("old").eqNullSafe(F.col("new"))) \
        .select("ad_id", month_first(F.col("stats_date")).alias("month_start"), "old", "new")


def month_deltas(changes: DataFrame) -> DataFrame:
    """Per (ad, month) a struct for every metric: ``by`` (new less old), ``some`` (a new value
    is there) and ``lost`` (a value went away, so the sum may have become empty)."""
    def one(m: str) -> Column:
        old, new = F.col(f"old.{m}"), F.col(f"new.{m}")
        by = F.sum(F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0)))
        return F.struct(by.alias("by"), F.max(new.isNotNull()).alias("some"),
                        F.max(old.isNotNull() & new.isNull()).alias("lost")).alias(m)

    return changes.groupBy("ad_id", "month_start").agg(*[one(m) for m in S.ROLLUP_METRICS])


def months_moved(month: DataFrame, deltas: DataFrame, run_date: Column) -> DataFrame:
    """MONTH rows of the touched months with the deltas added, in table shape.

    A sum that had no value takes the new ones; every row's date moves as a refresh moves it.
    An ad without a MONTH row gets one out of its deltas.
    """
    types = {f.name: f.dataType for f in S.table_schema("ad_stats").fields}
    old = month.withColumn("month_start", F.to_date(F.concat("stats_month", F.lit("-01")))) \
        .withColumnsRenamed({c: f"_{c}" for c in month.columns if c != "ad_id"})
    both = old.withColumn("_in", F.lit(True)).join(deltas, ["ad_id", "month_start"], "full_outer")
    start, known = F.col("month_start"), F.col("_in").isNotNull()
    moved = F.greatest("_stats_date", F.least(run_date, F.last_day(start)), start)

    def value(m: str) -> Column:
        if m not in S.ROLLUP_METRICS:
            return F.col(f"_{m}")
        d, was = F.col(m), F.col(f"_{m}")
        return F.when(d.isNull(), was).when(was.isNotNull() | d["some"], F.coalesce(was, F.lit(0)) + d["by"])

    made = {"ad_id_date_granul": F.coalesce("_ad_id_date_granul", X.stats_key(F.col("ad_id"), start, S.MONTH)),
            "ad_id": F.col("ad_id"), "stats_date": F.when(known, moved).otherwise(start),
            "granularity": F.lit(S.MONTH), "stats_month": X.month_text(start)}
    return both.select(*[(made[c] if c in made else value(c)).cast(types[c]).alias(c) for c in month.columns])


def split_new_months(months: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of months without any existing row, rows of all other months).

    The known months are at most twelve rows per calendar year of data, whatever the
    table holds; broadcasting them keeps a dominant month from gathering in one task.
    """
    known = F.broadcast(existing.select("stats_month").distinct())
    return (months.join(known, "stats_month", "left_anti").select(*months.columns),
            months.join(known, "stats_month", "left_semi").select(*months.columns))


def in_range(facts: DataFrame, granularity: str, first: Column, last: Column) -> DataFrame:
    """Facts of one granularity with first <= stats_date <= last.

    The same bounds go to the partition column, so only the months concerned are read.
    """
    return facts.where(
        (F.col("granularity") == granularity)
        & F.col("stats_month").between(X.month_text(first), X.month_text(last))
        & F.col("stats_date").between(first, last))


def date_bounds(incoming: DataFrame) -> DataFrame:
    """One row: smallest and largest incoming day (blank days take no part)."""
    return incoming.where(F.col("stats_date").isNotNull()).agg(
        F.min("stats_date").alias("first_day"), F.max("stats_date").alias("last_day"))
