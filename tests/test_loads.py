import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.plans import loads
from adweave.session import fresh_path
from adweave.sources import extract as E
from adweave.sources.warehouse import Warehouse, account_seed
from adweave.streaming.dayload import archived, load_new_extracts


def wide(spark, rows, columns=S.WIDE_DAY_COLUMNS):
    """Extract rows: dicts of text, everything else blank."""
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows],
                                 S.text_schema(columns))


def day(ad, date, **metrics):
    return {"ad_id": ad, "adstats_date": f"{date}T00:00:00.000-05:00",
            **{m: str(v) for m, v in metrics.items()}}


@pytest.fixture
def wh(spark):
    return Warehouse(spark, fresh_path(spark, "test-warehouse")).create()


def state(wh, table, *columns):
    return sorted([tuple(r) for r in wh.table(table).select(*columns).collect()], key=repr)


RUN = dt.date(2020, 3, 31)


def test_day_load_rules(spark, wh):
    loads.daily_load(wh, wide(spark, [
        day("a", "2020-03-01", impressions="5.0", spend="1.9"),
        day("a", "2020-03-01", impressions="4"),                   # loses
        day("b", "2020-03-01", impressions=0, spend="", video_views=0),   # no activity
        day("", "2020-03-01", impressions=5), day(" ", "2020-03-01", impressions=5),
        day("c", "", impressions=5)]), RUN)
    assert state(wh, "ad_stats", "ad_id_date_granul", "impressions", "spend", "stats_month") == [
        ("a2020-03-01DAY", 5, 1, "2020-03")]
    # Same date with another offset is the same day; zero restatements are ignored.
    again = [{**day("a", "2020-03-01", impressions=7), "adstats_date":
              "2020-03-01T00:00:00.000-04:00"},
             day("a", "2020-02-01", impressions=1)]
    loads.daily_load(wh, wide(spark, again), RUN)
    loads.daily_load(wh, wide(spark, [day("a", "2020-03-01", impressions=0, spend=0)]), RUN)
    want = [("a", dt.date(2020, 2, 1), 1, None), ("a", dt.date(2020, 3, 1), 7, None)]
    assert state(wh, "ad_stats", "ad_id", "stats_date", "impressions", "spend") == want


def test_day_load_only_renames_known_dimensions(spark, wh):
    row = {"campaign_id": "c", "campaign_name": "one", "campaign_status": "ACTIVE",
           "campaign_end_time": " ", "ad_squad_id": "s", "ad_squad_name": "sq",
           "auto_bid": "False", "target_bid": "True", "lifetime_budget_micro": "20000001",
           "ad_id": "a", "ad_name": "ad", "ad_created_at": "03/01/2020 0:00"}
    loads.daily_load(wh, wide(spark, [row]), RUN)
    loads.daily_load(wh, wide(spark, [{**row, "campaign_name": "two",
                                       "campaign_status": "PAUSED"}]), dt.date(2020, 4, 1))
    assert state(wh, "campaign", "campaign_id", "campaign_name", "campaign_status",
                 "campaign_end_time", "updated_on") == [("c", "two", "ACTIVE", None, RUN)]
    assert state(wh, "ad_squad", "auto_bid", "target_bid", "lifetime_budget_micro",
                 "impression_goal") == [("FALSE", "TRUE", 20000001, None)]
    assert state(wh, "ad", "ad_id", "ad_created_at", "created_on") == [
        ("a", dt.date(2020, 3, 1), RUN)]


def test_loads_are_idempotent(spark, wh):
    raw = wide(spark, [day("a", f"2020-03-{d:02d}", impressions=d, frequency="0.1",
                           ) | {"campaign_id": "c", "ad_squad_id": "s"} for d in range(1, 20)])
    for _ in range(2):
        loads.daily_load(wh, raw, RUN)
        first = {t: state(wh, t, *S.columns_of(t)) for t in S.TABLES}
    loads.daily_load(wh, raw, RUN)
    assert {t: state(wh, t, *S.columns_of(t)) for t in S.TABLES} == first
    assert len(first["ad_stats"]) == 19


def test_lifetime_moves_date_keeps_text_key(spark, wh):
    cols = S.WIDE_LIFETIME_COLUMNS
    seed = account_seed(spark, {"1": ["n", "cl", "br"]})
    loads.lifetime_load(wh, wide(spark, [{"ad_id": "a", "impressions": "3"}], cols), RUN, seed)
    later = dt.date(2020, 5, 2)
    loads.lifetime_load(wh, wide(spark, [{"ad_id": "a", "impressions": "4"},
                                         {"ad_id": "b", "impressions": "0"}], cols), later,
                        account_seed(spark, {"1": ["n2", "cl", "br"], "2": ["m", "", ""]}))
    assert state(wh, "ad_stats", "ad_id_date_granul", "stats_date", "impressions") == [
        ("a2020-03-31LIFETIME", later, 4)]
    assert state(wh, "ad_account", "ad_account_id", "ad_account_name", "created_on",
                 "updated_on", "ad_account_include_ind") == [
        ("1", "n2", RUN, later, "YES"), ("2", "m", later, later, "YES")]


def test_trial_load_only_adds_absent_accounts(spark, wh):
    raw = wide(spark, [{"ad_id": "a", "dma": "d", "geo_spend": "5.5", "impressions": "0",
                        "geo_impression_composition": "0.25"}], S.WIDE_GEO_COLUMNS)
    for name in ("one", "two"):
        loads.trial_load(wh, raw, RUN, account_seed(spark, {"1": name}))
    assert state(wh, "ad_account", "ad_account_id", "ad_account_name") == [("1", "one")]
    # No guard: the blank ids of the file become one row each, without audit dates.
    assert state(wh, "campaign", "campaign_id", "created_on") == [("", None)]
    # Neither the trial lifetime load nor the geo load is gated.
    assert state(wh, "ad_stats", "ad_id", "impressions", "uniques") == [("a", 0, None)]
    assert state(wh, "ad_geo", "ad_id_dma_granul_date", "geo_spend",
                 "geo_impression_composition") == [("ad2020-03-31LIFETIME", 5, 0.25)]


def test_month_first_gated_refresh_not(spark, wh):
    facts = [day("a", "2020-02-03", spend=2), day("a", "2020-02-29", spend=3),
             day("b", "2020-02-03", spend=5), day("b", "2020-02-04", spend=-5)]
    loads.daily_load(wh, wide(spark, facts), RUN)
    assert loads.monthly_load(wh, dt.date(2020, 2, 10)) == "month_first"
    month = ["ad_id_date_granul", "stats_date", "spend", "swipe_up_percent"]
    facts_of = lambda: sorted([tuple(r) for r in wh.facts("ad_stats", S.MONTH)
                               .select(*month).collect()], key=repr)
    first = dt.date(2020, 2, 1)
    assert facts_of() == [("a2020-02-01MONTH", first, 5, None)]
    assert loads.monthly_load(wh, dt.date(2020, 2, 20)) == "month_refresh"
    assert facts_of() == [("a2020-02-01MONTH", dt.date(2020, 2, 20), 5, None),
                          ("b2020-02-01MONTH", first, 0, None)]
    # Each month's rows stay in its own partition; DAY rows are untouched.
    assert wh.facts("ad_stats", S.DAY).count() == 4


def test_touched_months_and_empty_month(spark, wh):
    loads.daily_load(wh, wide(spark, [day("a", "2020-01-31", spend=1),
                                      day("a", "2020-02-01", spend=2)]), RUN)
    loads.monthly_load(wh, dt.date(2020, 2, 10))
    loads.daily_load(wh, wide(spark, [day("a", "2020-01-31", spend=7)]), RUN)
    loads.touched_months_load(wh, dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2020, 2, 20))
    got = sorted(tuple(r) for r in wh.facts("ad_stats", S.MONTH).select(
        "stats_month", "spend", "stats_date").collect())
    assert got == [("2020-01", 7, dt.date(2020, 1, 1)), ("2020-02", 2, dt.date(2020, 2, 20))]
    loads.monthly_load(wh, dt.date(2020, 6, 10))  # no DAY rows at all
    assert wh.facts("ad_stats", S.MONTH).count() == 2


def slices(wh, table):
    return wh._version(table).slices


def test_load_of_far_apart_days_rewrites_only_their_months(spark, wh):
    days = ["1970-01-05", "2019-12-05", "2020-01-05", "2020-02-05", "2020-03-05"]
    loads.daily_load(wh, wide(spark, [day("a", d, spend=1) for d in days]), RUN)
    before = slices(wh, "ad_stats")
    loads.daily_load(wh, wide(spark, [day("a", "1970-01-05", spend=9),
                                      day("a", "2020-03-05", spend=9)]), RUN)
    after = slices(wh, "ad_stats")
    same = {k for k in before if before[k] == after[k]}
    assert same == {f"granularity=DAY/stats_month={m}" for m in ("2019-12", "2020-01", "2020-02")}
    assert state(wh, "ad_stats", "stats_month", "spend") == [
        ("1970-01", 9), ("2019-12", 1), ("2020-01", 1), ("2020-02", 1), ("2020-03", 9)]


def test_dimensions_rewrite_only_changed_buckets(spark, wh):
    rows = [{"ad_id": f"a{i}", "ad_name": f"n{i}"} for i in range(60)]
    loads.daily_load(wh, wide(spark, rows), RUN)
    before = slices(wh, "ad")
    assert len(before) > 8
    loads.daily_load(wh, wide(spark, rows), RUN)
    assert slices(wh, "ad") == before
    rows[7]["ad_name"] = "renamed"
    loads.daily_load(wh, wide(spark, rows), RUN)
    after = slices(wh, "ad")
    assert sum(before[k] != after[k] for k in before) == 1
    assert wh.table("ad").count() == 60
    assert wh.table("ad").where("ad_name = 'renamed'").count() == 1


def test_failed_publish_leaves_all_rows_and_its_rerun_is_complete(spark, wh):
    raw = wide(spark, [day(f"a{i}", "2020-03-01", spend=i + 1) | {"ad_name": f"n{i}"}
                       for i in range(3)])
    loads.daily_load(wh, raw, RUN)
    stored = {t: state(wh, t, *S.columns_of(t)) for t in ("ad", "ad_stats")}
    broken = F.raise_error(F.lit("a write task fails"))
    for table in ("ad", "ad_stats"):
        column = "ad_name" if table == "ad" else "ad_id_date_granul"
        rows = wh.table(table).withColumn(column, F.when(
            F.col("ad_id") == "a2", broken.cast("string")).otherwise("lost"))
        with pytest.raises(Exception, match="a write task fails"):
            wh.publish(table, rows)
        assert state(wh, table, *S.columns_of(table)) == stored[table]
    loads.daily_load(wh, wide(spark, [day("a1", "2020-03-01", spend=50) | {"ad_name": "new"}]), RUN)
    assert state(wh, "ad", "ad_id", "ad_name") == [("a0", "n0"), ("a1", "new"), ("a2", "n2")]
    assert state(wh, "ad_stats", "ad_id", "spend") == [("a0", 1), ("a1", 50), ("a2", 3)]


def test_a_publish_writes_once(spark, wh):
    loads.daily_load(wh, wide(spark, [day("a", "2020-01-05", spend=1)]), RUN)
    data = f"{wh.path('ad_stats')}/data"
    assert len(os.listdir(data)) == 1
    wh.upsert("day_stats", E.day_rows(wide(spark, [day("a", "2020-01-06", spend=1)])))
    assert len(os.listdir(data)) == 2


def test_missing_column_is_an_error(spark):
    path = fresh_path(spark, "bad")
    spark.createDataFrame([("1", "x")], "ad_id string, other string").write \
        .option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header|column"):
        E.read_extract(spark, path).collect()
    with pytest.raises(ValueError, match="campaign_name"):
        E.entity_rows(spark.createDataFrame([("1",)], "campaign_id string"), "campaign",
                      F.lit(RUN))


def _drop_file(folder, name, spend, mtime):
    """One extract as a single file, like the ones an external job drops."""
    os.makedirs(folder, exist_ok=True)
    row = day("a", "2020-03-01", spend=spend)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(",".join(S.WIDE_DAY_COLUMNS) + "\n")
        f.write(",".join(row.get(c, "") for c in S.WIDE_DAY_COLUMNS) + "\n")
    os.utime(f"{folder}/{name}", (mtime, mtime))


def test_stream_newest_file_wins_and_files_are_archived(spark, wh):
    inbox, archive = fresh_path(spark, "inbox"), fresh_path(spark, "archive")
    checkpoint = fresh_path(spark, "state")
    # Two versions in one batch: the newer file wins although it has the smaller value.
    _drop_file(inbox, "day_b.csv", 9, 1_600_000_000)
    _drop_file(inbox, "day_a.csv", 4, 1_600_000_500)
    _drop_file(inbox, "notes.txt", 1, 1_600_000_900)
    load_new_extracts(wh, inbox, checkpoint, RUN, glob="day_*.csv", archive=archive)
    assert state(wh, "ad_stats", "spend") == [(4,)]
    # Loaded files have left the inbox, stamped with the run that loaded them.
    assert os.listdir(inbox) == ["notes.txt"]
    assert sorted(os.listdir(f"{archive}/loaded={RUN}")) == ["day_a.csv", "day_b.csv"]
    _drop_file(inbox, "day_c.csv", 2, 1_600_001_000)
    later = dt.date(2020, 4, 1)
    load_new_extracts(wh, inbox, checkpoint, later, glob="day_*.csv", archive=archive)
    assert state(wh, "ad_stats", "spend") == [(2,)]
    assert os.listdir(f"{archive}/loaded={later}") == ["day_c.csv"]
    assert sorted(map(tuple, archived(spark, archive).collect())) == [
        (RUN, "day_a.csv"), (RUN, "day_b.csv"), (later, "day_c.csv")]
    load_new_extracts(wh, inbox, checkpoint, later, glob="day_*.csv", archive=archive)
    assert os.listdir(inbox) == ["notes.txt"]


TEXTS = ["l1\nl2", "a\r\nb", 'say "hi"', "x, y", " edge ", "back\\slash", "literal \\n", "\\", "\\\\n",
         '"', "\n", "tab\tend", "ünï"]


def test_extract_texts_survive_files_and_loads(spark, wh):
    rows = [{"ad_id": f"a{i}", "ad_name": t, "impressions": "5", "campaign_id": "c",
             "campaign_name": t} for i, t in enumerate(TEXTS)]
    path = fresh_path(spark, "texts")
    E.write_extract(wide(spark, rows, S.WIDE_LIFETIME_COLUMNS), path, S.WIDE_LIFETIME_COLUMNS)
    raw = E.read_extract(spark, path, S.WIDE_LIFETIME_COLUMNS)
    want = sorted((r["ad_id"], r["ad_name"]) for r in rows)
    assert sorted(map(tuple, raw.select("ad_id", "ad_name").collect())) == want
    loads.lifetime_load(wh, raw, RUN, dimensions=True)
    assert state(wh, "ad", "ad_id", "ad_name") == sorted(want, key=repr)
    assert wh.facts("ad_stats", S.LIFETIME).count() == len(TEXTS)


def test_torn_rows_raise_whatever_is_selected(spark):
    folder = fresh_path(spark, "torn")
    os.makedirs(folder)
    head = S.WIDE_DAY_COLUMNS
    row = day("a", "2020-03-01", spend=1) | {"ad_name": '"one\ntwo"'}
    with open(f"{folder}/x.csv", "w", encoding="utf-8") as f:
        f.write(",".join(head) + "\n" + ",".join(row.get(c, "") for c in head) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        E.read_extract(spark, folder).select("ad_id").collect()
    # Files of other writers are read with their line breaks.
    got = E.read_extract(spark, folder, foreign=True).select("ad_id", "ad_name", "spend").collect()
    assert [tuple(r) for r in got] == [("a", "one\ntwo", "1")]
