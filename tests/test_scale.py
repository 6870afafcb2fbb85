"""What large extracts, backfills and streams must not write, make or keep."""

import datetime as dt
import glob

from pyspark.sql import functions as F
from test_loads import day, wide

from adweave.functions.calendar import starts_tile, window_tiles
from adweave.plans import extracts
from adweave.session import STATE, STATE_ON_DISK, fresh_path, packed, state_on_disk
from adweave.sources import extract as E
from adweave.sources import payloads as P
from adweave.streaming.landed import ads_outer_stats, watch_landing

LANDING = "account_id string, ad_id string, window_start date, status int, body string"


def test_an_extract_is_written_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(E, "FILE_ROWS", 2)
    names = ["a\\n\n", "\\", "\r\n", None, " edge ", 'q"q', "", "plain"]
    rows = [day(f"a{i}", "2020-01-05", spend=i) | {"ad_name": n} for i, n in enumerate(names)]
    path = fresh_path(spark, "extract")
    df = wide(spark, rows).withColumn("ad_created_at", F.lit(dt.date(2020, 2, 3)))
    E.write_extract(df.coalesce(1), path)
    files = glob.glob(f"{path}/part-*")
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    got = E.read_extract(spark, path).select("ad_id", "ad_name", "ad_created_at").collect()
    assert sorted(tuple(r) for r in got) == [
        (f"a{i}", n or None, "02/03/2020 0:00") for i, n in enumerate(names)]


def test_windows_are_written_from_rows_as_they_come(spark):
    path = fresh_path(spark, "windows")
    rows = [day(f"a{i}", "2020-01-05", spend=i) | {"w": f"2020-0{i % 3 + 1}-01"} for i in range(9)]
    df = wide(spark, rows, ["ad_id", "adstats_date", "spend", "w"])
    E.write_extract(df, path, by_window="w")
    got = E.read_extract(spark, path).select("ad_id", F.col("w").cast("string"), "spend", "ad_name").collect()
    assert sorted(tuple(r) for r in got) == [(f"a{i}", f"2020-0{i % 3 + 1}-01", f"{i}", None) for i in range(9)]


def test_starts_of_tiles_are_those_of_the_windows(spark):
    days = spark.range(800).select(F.expr("date_add(date'2018-12-01', cast(id as int))").alias("d"))
    for limit, days_each, inclusive in ((dt.date(2019, 12, 27), 30, False), (dt.date(2019, 12, 27), 30, True),
                                        (dt.date(2019, 1, 1), 30, False), (dt.date(2019, 3, 1), 7, True)):
        start = dt.date(2019, 1, 1)
        tiles = spark.range(1).select(F.inline(window_tiles(F.lit(start), F.lit(limit), days_each, inclusive)))
        found = days.where(starts_tile(F.col("d"), start, limit, days_each, inclusive))
        assert {r.d for r in found.collect()} == {r.window_start for r in tiles.collect()}


def test_a_backfill_joins_per_ad_not_per_request(spark):
    accounts = spark.createDataFrame(
        [("1", "n", "c", "b", "UTC", "YES")], "ad_account_id string, ad_account_name string, "
        "ad_account_client string, ad_account_brand string, ad_account_timezone string, "
        "ad_account_include_ind string")
    landing = lambda rows: spark.createDataFrame(rows, LANDING)
    ads = landing([("1", None, None, 200, '{"ads":[{"ad":{"id":"a"}},{"ad":{"id":"b"}}]}')])
    none = landing([])
    body = ('{"timeseries_stats":[{"timeseries_stat":{"timeseries":[{"start_time":"2020-01-01T00:00",'
            '"stats":{"spend":1}}]}}]}')
    first, second, odd = dt.date(2020, 1, 1), dt.date(2020, 1, 31), dt.date(2020, 1, 2)
    stats = landing([("1", "a", first, 200, body), ("1", "a", first, 200, body), ("1", "b", second, 500, body),
                     ("1", "b", odd, 200, body), ("1", "gone", first, 200, body), ("1", "b", None, 200, body)])
    path = fresh_path(spark, "history")
    missing = extracts.history_job(accounts, none, none, ads, stats, first, dt.date(2020, 2, 15), path)
    text = missing._jdf.queryExecution().analyzed().toString()
    assert "LeftAnti" not in text and text.index("explode") < text.index("Join")
    got = missing.select("ad_id", "window_start", "window_end", "start_time").collect()
    assert sorted(tuple(r) for r in got) == [
        ("a", second, dt.date(2020, 2, 15), "2020-01-31T0:00:00.000-00:00"),
        ("b", first, second, "2020-01-01T0:00:00.000-00:00"),
        ("b", second, dt.date(2020, 2, 15), "2020-01-31T0:00:00.000-00:00")]
    rows = E.read_extract(spark, path).select("ad_id", F.col("window_start").cast("string"), "spend").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(
        [("a", "2020-01-01", "1"), ("a", "2020-01-01", "1"), ("b", None, None)], key=repr)


def test_a_series_is_one_row_until_it_has_met_its_ad(spark):
    empty = '{"timeseries_stats":[{"timeseries_stat":{"timeseries":[]}}]}'
    two = ('{"timeseries_stats":[{"timeseries_stat":{"timeseries":[{"start_time":"2020-01-01","stats":{"spend":1}},'
           '{"start_time":"2020-01-02","stats":{"swipes":2}}]}}]}')
    stats = spark.createDataFrame([("1", "a", None, 200, two), ("1", "b", None, 200, empty),
                                   ("1", "c", None, 200, "oops"), ("1", "d", None, 500, two)], LANDING)
    series = P.read_day_series(stats)
    assert [r.ad_id for r in series.collect()] == ["a"]
    flat = series.select("ad_id", "window_start", F.inline("series"))
    assert flat.collect() == P.read_day_stats(stats).collect() and len(flat.collect()) == 2
    folder = fresh_path(spark, "landed")
    stats.withColumn("landed_at", F.current_timestamp()).write.parquet(folder)
    joined = ads_outer_stats(watch_landing(spark, folder), watch_landing(spark, folder))
    text = joined._jdf.queryExecution().analyzed().toString()
    assert text.index("inline") < text.index("Join LeftOuter")
    assert joined.columns[-18:-15] == ["stats_landed_at", "adstats_date", "impressions"]


def test_state_lies_on_disk_in_any_session(spark):
    other = spark.newSession()
    for k in STATE_ON_DISK:
        other.conf.unset(k)
    name = next(iter(STATE_ON_DISK))
    before = other.conf.get(name)
    with state_on_disk(other):
        assert "RocksDB" in other.conf.get(name)
    assert other.conf.get(name) == before
    other.conf.set(name, "mine")
    with state_on_disk(other):
        assert other.conf.get(name) == "mine"


def test_state_of_a_join_holds_texts_in_one_store(spark):
    """Stats wait for their ad as text of what was sent; stores take no disk in advance."""
    folder = fresh_path(spark, "landed-text")
    spark.createDataFrame([], f"{LANDING}, landed_at timestamp").write.parquet(folder)
    joined = ads_outer_stats(watch_landing(spark, folder), watch_landing(spark, folder))
    text = joined._jdf.queryExecution().analyzed().toString()
    assert text.index("from_json") < text.index("Join LeftOuter") < text.index("to_json(series")
    other, join = spark.newSession(), "spark.sql.streaming.join.stateFormatVersion"
    for k in STATE_ON_DISK:
        other.conf.unset(k)
    with state_on_disk(other):
        assert other.conf.get(join) == "3" and other.conf.get(f"{STATE}.rocksdb.allowFAllocate") == "false"
    other.conf.set(f"{STATE}.providerClass", "mine")
    with state_on_disk(other):
        assert other.conf.get(join) == "2"


def test_the_text_of_a_value_is_made_once(spark):
    assert str(P.value_text(F.col("v"))).count("to_json") == 1


def test_staged_tables_are_packed_tightly(spark):
    rows = spark.range(20000).selectExpr("concat_ws('-', id, hash(id), 'name') name").coalesce(1)
    got = packed(rows, "packed")
    assert all(f.endswith(".zstd.parquet") for f in got.inputFiles()) and got.count() == 20000
