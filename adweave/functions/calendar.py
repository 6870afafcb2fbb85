"""Date windows, month bounds and local-midnight-to-UTC bounds.

All of these are per-row expressions, so a window list never needs a cross join:
each row carries its own array and explodes it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trailing_window(run_day: Column, days: int = 30) -> Column:
    """struct(window_start, window_end) for the ``days`` before ``run_day``."""
    return F.struct(F.date_sub(run_day, days).alias("window_start"),
                    run_day.alias("window_end"))


def window_tiles(start: Column, limit: Column, days: int = 30,
                 inclusive_end: bool = False) -> Column:
    """array<struct(window_start, window_end)> tiling ``start``..``limit``.

    The next start is the previous end and the last end is clamped to ``limit``.
    With ``inclusive_end`` the clamp is the day after, for readers whose end bound
    is exclusive. Empty windows are never produced.
    """
    last = F.date_add(limit, 1) if inclusive_end else limit
    starts = F.sequence(start, F.date_sub(last, 1), F.expr(f"interval {days} days"))
    tiles = F.transform(starts, lambda s: F.struct(
        s.alias("window_start"),
        F.least(F.date_add(s, days), last).alias("window_end")))
    return F.when(start < last, tiles)


def starts_tile(day: Column, start: dt.date, limit: dt.date, days: int = 30,
                inclusive_end: bool = False) -> Column:
    """Whether one of ``window_tiles`` starts on a day, without making them."""
    gap = F.date_diff(day, F.lit(start))
    last = limit + dt.timedelta(days=1) if inclusive_end else limit
    return (gap >= 0) & (gap % days == 0) & (day < F.lit(last))


def month_first(d: Column) -> Column:
    return F.trunc(d, "month")


def month_bounds(d: Column) -> Column:
    return F.struct(month_first(d).alias("month_start"), F.last_day(d).alias("month_end"))


def months_between(first: Column, last: Column) -> Column:
    """array<struct(month_start, month_end)> of every month from ``first`` to ``last``."""
    starts = F.sequence(month_first(first), month_first(last), F.expr("interval 1 month"))
    return F.transform(starts, lambda m: F.struct(
        m.alias("month_start"), F.last_day(m).alias("month_end")))


def midnight_utc(day: Column, zone: Column) -> Column:
    """Local midnight as a zone-less UTC timestamp; independent of the session zone."""
    return F.convert_timezone(zone, F.lit("UTC"), day.cast("timestamp_ntz"))


def utc_text(ts: Column) -> Column:
    """``YYYY-MM-DDTh:mm:ss.000-00:00`` with an unpadded hour."""
    day = ts.cast("date").cast("string")
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(day, F.lit("T"), F.hour(ts).cast("string"), F.lit(":"), pad(F.minute(ts)),
                    F.lit(":"), pad(F.second(ts).cast("int")), F.lit(".000-00:00"))


def utc_bound(day: Column, zone: Column, offset_at: dt.datetime | None = None) -> Column:
    """Request bound for a local day.

    By default the zone's offset on that day applies. ``offset_at`` (a wall-clock
    time) applies the offset of that moment instead, which is what a daily run does
    for its end bound; the two differ only across a clock change.
    """
    if offset_at is None:
        return utc_text(midnight_utc(day, zone))
    moment = F.lit(offset_at.isoformat(sep=" ")).cast("timestamp_ntz")
    shift = F.convert_timezone(zone, F.lit("UTC"), moment) - moment
    return utc_text(day.cast("timestamp_ntz") + shift)


def request_plan(ads: DataFrame, windows: Column, zone: str = "timezone",
                 end_offset_at: dt.datetime | None = None) -> DataFrame:
    """One row per (ad, window): what has to be requested from the reporting service."""
    w = ads.select("ad_id", zone, F.explode(windows).alias("w")) \
        .select("ad_id", zone, "w.window_start", "w.window_end")
    return w.select(
        "ad_id", "window_start", "window_end",
        utc_bound(F.col("window_start"), F.col(zone)).alias("start_time"),
        utc_bound(F.col("window_end"), F.col(zone), end_offset_at).alias("end_time"))
