import datetime as dt

from pyspark.sql import functions as F

from adweave.functions import calendar as C
from adweave.functions import scalars as X


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


def values(spark, texts, fn):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("c"))).collect()]


def test_counts_truncate_toward_zero(spark):
    assert values(spark, ["12.0", "12.9", "-3.9", "", " ", None, "x", "1e3"],
                  X.count_metric) == [12, 12, -3, None, None, None, None, 1000]


def test_ratio_is_32_bit(spark):
    got = values(spark, ["0.05", ""], X.ratio_metric)
    assert got == [0.05000000074505806, None]


def test_money_above_2_24_is_exact(spark):
    assert values(spark, ["16777217", "9007199254740993", "20000001.0", ""],
                  X.money_micro) == [16777217, 9007199254740993, 20000001, None]


def test_flags(spark):
    assert values(spark, ["True", "False", "", None, "true"], X.flag_text) == \
        ["TRUE", "FALSE", "FALSE", "FALSE", "TRUE"]


def test_nonblank_keeps_two_spaces(spark):
    assert values(spark, ["", " ", "  ", "a"], X.nonblank) == [False, False, True, True]


def test_blank_to_null(spark):
    assert values(spark, ["", " ", "x", None], X.blank_to_null) == [None, None, "x", None]


def test_entity_day_reads_both_forms(spark):
    day = dt.date(2020, 2, 29)
    assert values(spark, ["2020-02-29T23:59:59.999Z", "02/29/2020 0:00", "2/29/2020 0:00",
                          "2020-02-29", "", "02/30/2020 0:00"], X.entity_day) == \
        [day, day, day, day, None, None]


def test_extract_day_text(spark):
    assert one(spark, X.extract_day_text(F.lit(dt.date(2020, 2, 9)))) == "02/09/2020 0:00"


def test_gate(spark):
    rows = spark.createDataFrame(
        [(0, 0, 0), (None, None, None), (0, None, 0), (1, 0, 0), (0, 0, 5)],
        "impressions long, spend long, video_views long")
    assert [r[0] for r in rows.select(X.has_activity()).collect()] == \
        [False, False, False, True, True]


def _tiles(spark, a, b, **kw):
    rows = spark.range(1).select(F.explode(C.window_tiles(F.lit(a), F.lit(b), **kw)).alias("w"))
    return [tuple(r) for r in rows.select("w.*").collect()]


def test_year_2019_gives_13_tiles(spark):
    got = _tiles(spark, dt.date(2019, 1, 1), dt.date(2019, 12, 31))
    assert len(got) == 13 and got[-1] == (dt.date(2019, 12, 27), dt.date(2019, 12, 31))
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_tile_on_the_limit_and_empty_range(spark):
    a = dt.date(2019, 1, 1)
    assert _tiles(spark, a, dt.date(2019, 1, 31)) == [(a, dt.date(2019, 1, 31))]
    assert _tiles(spark, a, a) == []
    assert _tiles(spark, a, a, inclusive_end=True) == [(a, dt.date(2019, 1, 2))]


def test_leap_february(spark):
    assert tuple(one(spark, C.month_bounds(F.lit(dt.date(2020, 2, 10))))) == \
        (dt.date(2020, 2, 1), dt.date(2020, 2, 29))


def test_sixteen_months(spark):
    got = one(spark, C.months_between(F.lit(dt.date(2019, 1, 5)), F.lit(dt.date(2020, 4, 1))))
    assert len(got) == 16 and tuple(got[-1]) == (dt.date(2020, 4, 1), dt.date(2020, 4, 30))


def test_utc_bounds_of_all_zones(spark):
    def bound(day, zone, **kw):
        return one(spark, C.utc_bound(F.lit(day), F.lit(zone), **kw))

    winter, summer = dt.date(2020, 1, 10), dt.date(2020, 7, 10)
    assert bound(winter, "America/New_York") == "2020-01-10T5:00:00.000-00:00"
    assert bound(summer, "America/New_York") == "2020-07-10T4:00:00.000-00:00"
    assert bound(winter, "UTC") == "2020-01-10T0:00:00.000-00:00"
    assert bound(winter, "Asia/Kolkata") == "2020-01-09T18:30:00.000-00:00"
    # Clock change on 2020-03-08 at 02:00: midnight is still EST, noon is EDT.
    change = dt.date(2020, 3, 8)
    assert bound(change, "America/New_York") == "2020-03-08T5:00:00.000-00:00"
    assert bound(change, "America/New_York", offset_at=dt.datetime(2020, 3, 8, 12)) == \
        "2020-03-08T4:00:00.000-00:00"


def test_request_plan_one_row_per_window(spark):
    from adweave.plans.extracts import day_requests, history_requests

    ads = spark.createDataFrame([("a", "America/Chicago"), ("b", "UTC")],
                                "ad_id string, timezone string")
    day = day_requests(ads, dt.date(2020, 3, 31)).orderBy("ad_id").collect()
    assert [(r.window_start, r.window_end, r.start_time) for r in day] == [
        (dt.date(2020, 3, 1), dt.date(2020, 3, 31), "2020-03-01T6:00:00.000-00:00"),
        (dt.date(2020, 3, 1), dt.date(2020, 3, 31), "2020-03-01T0:00:00.000-00:00")]
    assert history_requests(ads, dt.date(2019, 1, 1), dt.date(2019, 12, 31)).count() == 26
