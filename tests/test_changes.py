"""Loads as one unit, MONTH from changes, finer buckets, torn lines, archiving, order of versions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_loads import RUN, day, state, wide
from test_plans import plan

from adweave import schemas as S
from adweave.operators import rollup as R
from adweave.plans import loads
from adweave.session import fresh_path
from adweave.sources import bucketed, warehouse
from adweave.sources import extract as E
from adweave.sources.bucketed import BucketedDimension, buckets_for
from adweave.sources.warehouse import Warehouse
from adweave.streaming import dayload
from adweave.streaming.ordered import load_in_version_order


@pytest.fixture
def wh(spark):
    return Warehouse(spark, fresh_path(spark, "test-changes")).create()


def row(i, name, spend):
    return day(f"a{i}", "2020-03-01", spend=spend) | {
        "ad_name": name, "ad_squad_id": "s", "ad_squad_name": name, "campaign_id": "c", "campaign_name": name}


def everything(wh):
    return {t: state(wh, t, *S.columns_of(t)) for t in ("campaign", "ad_squad", "ad", "ad_stats")}


def test_a_load_that_fails_between_tables_shows_nothing_of_itself(spark, wh, monkeypatch):
    loads.daily_load(wh, wide(spark, [row(i, "old", 1) for i in range(3)]), RUN)
    before, real, done = everything(wh), Warehouse.publish, []

    def breaks(self, table, *args, **more):
        if table == "ad_stats":
            raise OSError("the cluster goes away")
        done.append(table)
        return real(self, table, *args, **more)

    new = wide(spark, [row(i, "new", 5) for i in range(4)])
    monkeypatch.setattr(Warehouse, "publish", breaks)
    with pytest.raises(OSError, match="goes away"):
        loads.daily_load(wh, new, RUN)
    assert done == ["campaign", "ad_squad", "ad"] and everything(wh) == before
    monkeypatch.undo()
    loads.daily_load(wh, new, RUN)
    assert state(wh, "ad", "ad_name") == [("new",)] * 4 and state(wh, "campaign", "campaign_name") == [("new",)]
    assert state(wh, "ad_stats", "spend") == [(5,)] * 4


def test_a_unit_sees_its_own_rows_and_nests(spark, wh):
    ads = lambda n: E.entity_rows(wide(spark, [{"ad_id": f"u{n}"}]), "ad", F.lit(RUN))
    with wh.unit() as outer:
        outer.upsert("ad_name", ads(1))
        with outer.unit() as inner:
            inner.upsert("ad_name", ads(2))
        assert outer.table("ad").count() == 2 and wh.table("ad").count() == 0
    assert wh.table("ad").count() == 2
    with pytest.raises(ValueError, match="no table"):
        wh.table("nothing")


def test_dimensions_are_cut_finer_as_they_grow(spark, wh, monkeypatch):
    monkeypatch.setattr(warehouse, "BUCKET_ROWS", 5)
    rows = lambda a, b: E.entity_rows(wide(spark, [
        {"ad_id": f"a{i}", "ad_name": f"n{i}"} for i in range(a, b)]), "ad", F.lit(RUN))
    wh.upsert("ad_name", rows(0, 300))
    assert wh._version("ad").buckets == 16
    wh.upsert("ad_name", rows(300, 310))
    assert wh._version("ad").buckets >= 64 and wh.table("ad").count() == 310
    cut = wh._version("ad").slices
    wh.upsert("ad_name", rows(310, 311))
    assert sum(cut.get(k) != v for k, v in wh._version("ad").slices.items()) == 1
    assert state(wh, "ad", "ad_id") == sorted((f"a{i}",) for i in range(311))


def test_month_follows_what_changed(spark, wh):
    def restate(*rows):
        loads.restate_days(wh, E.day_rows(wide(spark, list(rows))), dt.date(2020, 3, 20))

    def months():
        return state(wh, "ad_stats", "ad_id", "stats_date", "spend", "swipes") and sorted(
            map(tuple, wh.facts("ad_stats", S.MONTH).select(
                "ad_id", "stats_date", "spend", "swipes", "stats_month").collect()))

    d = dt.date
    restate(day("a", "2020-03-01", spend=5, swipes=2), day("a", "2020-03-02", spend=1),
            day("b", "2020-03-01", spend=7), day("a", "2020-02-28", spend=9))
    assert months() == [("a", d(2020, 2, 1), 9, None, "2020-02"), ("a", d(2020, 3, 1), 6, 2, "2020-03"),
                        ("b", d(2020, 3, 1), 7, None, "2020-03")]
    # A new value, a lost one (the sum is empty again), a new ad; dates move as a refresh moves them.
    restate(day("a", "2020-03-01", spend=5), day("b", "2020-03-02", spend=1, swipes=4),
            day("c", "2020-03-09", spend=3))
    want = [("a", d(2020, 2, 1), 9, None, "2020-02"), ("a", d(2020, 3, 20), 6, None, "2020-03"),
            ("b", d(2020, 3, 20), 8, 4, "2020-03"), ("c", d(2020, 3, 1), 3, None, "2020-03")]
    assert months() == want
    before = wh._version("ad_stats").slices
    restate(day("c", "2020-03-09", spend=3), day("c", "2020-03-10", spend=0))  # no change
    assert months() == want
    month = [k for k in before if "MONTH" in k]
    assert all(wh._version("ad_stats").slices[k] == before[k] for k in month)
    # The same as summing the touched months anew.
    again = Warehouse(spark, fresh_path(spark, "summed")).create()
    again.publish("ad_stats", wh.table("ad_stats"))
    loads.touched_months_load(again, d(2020, 2, 1), d(2020, 3, 31), d(2020, 3, 20))
    got = sorted(map(tuple, again.facts("ad_stats", S.MONTH).where("stats_month = '2020-03'").select(
        "ad_id", "spend", "swipes").collect()))
    assert got == [(a, s, w) for a, _, s, w, m in want if m == "2020-03"]


def test_deltas_read_changed_slices_only_and_combine(spark, wh):
    loads.daily_load(wh, wide(spark, [day("a", f"2020-{m:02d}-05", spend=1) for m in range(1, 7)]), RUN)
    stored = wh.facts("ad_stats", S.DAY).where(F.col("stats_month").isin("2020-02"))
    rows = E.day_rows(wide(spark, [day("a", "2020-02-05", spend=2)]))
    changes = R.day_changes(stored, rows)
    filters = plan(changes).split("PartitionFilters: [")[1]
    assert "granularity" in filters and "stats_month" in filters
    assert changes.count() == 1 and "partial_sum" in plan(R.month_deltas(changes))


def test_bucketed_merge_leaves_the_stored_side_in_place(spark, monkeypatch):
    ads = lambda a, b, name: E.entity_rows(wide(spark, [
        {"ad_id": f"a{i}", "ad_name": name} for i in range(a, b)]), "ad", F.lit(RUN))
    dim = BucketedDimension(spark, fresh_path(spark, "buckets"), "ad")
    dim.upsert("ad_name", ads(0, 50, "old"))
    dim.upsert("ad_name", ads(40, 60, "new"))
    assert sorted((r.ad_id, r.ad_name) for r in dim.read().collect()) == sorted(
        (f"a{i}", "new" if i >= 40 else "old") for i in range(60))
    assert [buckets_for(n) for n in (0, 1_000_000, 1_000_001, 9_000_000)] == [1, 1, 2, 16]
    monkeypatch.setattr(bucketed, "ROWS", 4)
    dim.upsert("ad_name", ads(60, 61, "new"))
    assert dim._last()[2] == 16 and dim.read().count() == 61
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(dim.merged("ad_name", ads(5, 9, "again"))).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "Bucketed: true" in x)
    join = next(i for i, x in enumerate(lines) if "FullOuter" in x)
    assert join < scan and not any("Exchange" in x for x in lines[join:scan])


def test_torn_lines_are_kept_apart(spark):
    folder, rejects = fresh_path(spark, "torn"), fresh_path(spark, "torn-rejects")
    os.makedirs(folder)
    line = ",".join(day("a", "2020-03-01", spend=1).get(c, "") for c in S.WIDE_DAY_COLUMNS)
    with open(f"{folder}/x.csv", "w", encoding="utf-8") as f:
        f.write("\n".join([",".join(S.WIDE_DAY_COLUMNS), line, "a,b", line + ",x,y", "", line, '"open']) + "\n")
    got = E.split_extract(spark, folder, rejects)
    assert got.columns == S.WIDE_DAY_COLUMNS
    assert [(r.ad_id, r.spend) for r in got.select("ad_id", "spend").collect()] == [("a", "1")] * 2
    lost = [r.line for r in spark.read.parquet(rejects).collect()]
    assert set(lost) >= {"a,b", line + ",x,y"}
    assert len(lost) == 3
    with open(f"{folder}/y.csv", "w", encoding="utf-8") as f:
        f.write("one,two\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        E.split_extract(spark, folder, fresh_path(spark, "none"))


def drop(folder, name, mtime, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(",".join(S.WIDE_DAY_COLUMNS) + "\n")
        for r in rows:
            f.write(",".join(r.get(c, "") for c in S.WIDE_DAY_COLUMNS) + "\n")
    os.utime(f"{folder}/{name}", (mtime, mtime))


def test_a_failed_move_is_told_and_tried_again(spark, wh):
    inbox, checkpoint, archive = (fresh_path(spark, n) for n in ("inbox", "state", "archive"))
    drop(inbox, "day 1+é.csv", 1_600_000_000, day("a", "2020-03-01", spend=1))
    drop(f"{inbox}/sub", "two.csv", 1_600_000_000, day("b", "2020-03-01", spend=1))
    os.makedirs(f"{archive}/loaded={RUN}")
    with open(f"{archive}/loaded={RUN}/sub", "w", encoding="utf-8") as f:
        f.write("in the way of a folder")
    with pytest.raises(OSError, match="1 of 2 files not archived"):
        dayload.load_new_extracts(wh, inbox, checkpoint, RUN, archive=archive)
    assert state(wh, "ad_stats", "ad_id") == [("a",), ("b",)]
    assert os.listdir(inbox) == ["sub"]
    os.rename(f"{archive}/loaded={RUN}/sub", f"{archive}/loaded={RUN}/was-in-the-way")
    later = dt.date(2020, 4, 2)
    dayload.load_new_extracts(wh, inbox, checkpoint, later, archive=archive)
    assert os.listdir(f"{inbox}/sub") == []
    assert {(str(r.loaded), r.name) for r in dayload.archived(spark, archive).collect()} == {
        (str(RUN), "day 1+é.csv"), (str(RUN), "sub/two.csv"), (str(RUN), "was-in-the-way")}
    report = dayload.archive_report(spark, dayload.ledger_of(checkpoint))
    assert sorted(r.outcome.split(":")[0] for r in report.collect()) == ["failed", "moved", "moved"]


def test_the_newest_version_stays_whatever_comes_first(spark):
    old = day("a", "2020-03-01", spend=1) | {"ad_name": "one"}
    new = day("a", "2020-03-01", spend=9) | {"ad_name": "two"}
    zero = day("a", "2020-03-01", spend=0) | {"ad_name": "three"}
    drops = {"old.csv": (1_600_000_000, old, day("b", "2020-03-01", spend=4)), "new.csv": (1_600_000_500, new),
             "zero.csv": (1_600_000_900, zero)}
    for order in (["old.csv", "new.csv", "zero.csv"], ["zero.csv", "new.csv", "old.csv"]):
        wh = Warehouse(spark, fresh_path(spark, "ordered")).create()
        inbox, checkpoint = fresh_path(spark, "inbox"), fresh_path(spark, "state")
        for name in order:
            mtime, *rows = drops[name]
            drop(inbox, name, mtime, *rows)
            load_in_version_order(wh, inbox, checkpoint, RUN)
        assert state(wh, "ad_stats", "ad_id", "spend") == [("a", 9), ("b", 4)]
        assert state(wh, "ad", "ad_id", "ad_name") == [("a", "three"), ("b", None)]
