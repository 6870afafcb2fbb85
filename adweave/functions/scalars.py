"""Cleaning expressions: text in, typed value or NULL out.

The extract is text and a blank means "missing". ANSI casts throw on blanks, so
every conversion here is a ``try_`` variant.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from adweave.schemas import DAY, GATE_METRICS, LIFETIME, MONTH


def count_metric(c: Column) -> Column:
    """``"12.9"`` -> 12, ``"-3.9"`` -> -3, blank -> NULL (truncation toward zero)."""
    return c.cast("string").try_cast("double").try_cast("bigint")


def ratio_metric(c: Column) -> Column:
    """Narrow to 32 bits, blank -> NULL."""
    return c.cast("string").try_cast("float")


def money_micro(c: Column) -> Column:
    """Money stays integral in micro units; whole numbers never pass through a float."""
    text = c.cast("string")
    return F.coalesce(text.try_cast("bigint"), count_metric(text))


def flag_text(c: Column) -> Column:
    return F.when(F.coalesce(c.cast("string").try_cast("boolean"), F.lit(False)), "TRUE") \
        .otherwise("FALSE")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def nonblank(c: Column) -> Column:
    """``> ' '``: drops NULL, the empty string and a single space."""
    return c > F.lit(" ")


def iso_day(c: Column) -> Column:
    """Day of an ISO timestamp text (its first ten characters)."""
    return F.substring(c, 1, 10).try_cast("date")


def entity_day(c: Column) -> Column:
    """Entity date, from ISO text or from the extract's ``MM/DD/YYYY 0:00``."""
    iso = F.substring_index(c, "T", 1).try_cast("date")
    us = F.regexp_replace(F.substring_index(F.trim(c), " ", 1),
                          r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2").try_cast("date")
    return F.coalesce(iso, us)


def extract_day_text(d: Column) -> Column:
    """Date as the extract renders it: ``MM/DD/YYYY 0:00``."""
    return F.date_format(d.cast("date"), "MM/dd/yyyy' 0:00'")


def has_activity(columns: list[str] | None = None) -> Column:
    """False only when every gate metric is zero or missing."""
    return reduce(lambda a, b: a | b,
                  [F.coalesce(F.col(c), F.lit(0)) != 0 for c in columns or GATE_METRICS])


def month_text(d: Column) -> Column:
    """Partition value of a date, ``YYYY-MM``."""
    return F.substring(d.cast("string"), 1, 7)


def stats_key(ad_id: Column, day: Column, granularity: str) -> Column:
    """Text key kept for readers of the table; joins use the typed columns."""
    if granularity not in (DAY, MONTH, LIFETIME):
        raise ValueError(granularity)
    return F.concat(ad_id, day.cast("string"), F.lit(granularity))


def geo_key(ad_id: Column, dma: Column, day: Column, granularity: str = LIFETIME) -> Column:
    return F.concat(ad_id, dma, day.cast("string"), F.lit(granularity))
