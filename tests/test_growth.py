"""What keeps shuffles and memory in step with the input."""

import datetime as dt
import re
from unittest.mock import patch

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave import session
from adweave.operators import attach
from adweave.operators.merge import apply_policy
from adweave.operators.rollup import month_rows
from adweave.plans import loads
from adweave.sources import extract as E
from adweave.sources.warehouse import Warehouse, empty_table
from adweave.streaming import dayload
from adweave.streaming.dayload import FILE, RANK, VERSION, _ranked
from adweave.streaming.ordered import newest_versions

SPLIT = "spark.sql.files.maxPartitionBytes"


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_month_sums_are_not_shuffled_again_by_a_merge(spark, tmp_path):
    """One exchange for the sums, one for the stored rows."""
    for name in ("day", "month"):
        empty_table(spark, "ad_stats").write.parquet(f"{tmp_path}/{name}")
    day, month = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("day", "month"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = _plan(apply_policy("month_refresh", month, month_rows(day, F.lit(dt.date(2020, 2, 3)))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2, text


def test_extracts_of_a_batch_are_numbered(spark):
    """Names and times give one small number, in their order; a missing time is the lowest."""
    late, early = dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 1)
    seen = [(late, "a"), (None, "b"), (early, "z"), (None, "a"), (late, "b"), (late, "b")]
    rows = spark.createDataFrame([(*v, "f", str(n)) for n, v in enumerate(seen)],
                                 f"{VERSION[0]} timestamp, {VERSION[1]} string, {FILE} string, ad_id string")
    got = {r.ad_id: r[RANK] for r in _ranked(rows).collect()}
    assert got == {"0": 4, "1": 2, "2": 3, "3": 1, "4": 5, "5": 5}


def test_older_copies_of_an_entity_fall_together(spark):
    """A name that comes again in a later extract wins over one from between."""
    own = [c for c in S.columns_of("campaign") if c not in ("created_on", "updated_on")]
    raw = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("1", "old", 3), ("2", "b", 1), ("2", "a", 1)],
                                "campaign_id string, campaign_name string, extract_rank int")
    raw = raw.withColumns({c: F.lit("") for c in own if c not in raw.columns})
    rows = E.entity_rows(raw, "campaign", F.lit(dt.date(2020, 1, 1)), None, ["extract_rank"])
    assert {(r.campaign_id, r.campaign_name) for r in rows.collect()} == {("1", "old"), ("2", "b")}
    assert "keys=[campaign_id" in _plan(rows) and "extract_rank#" not in _plan(rows).split("keys=[campaign_id", 1)[1] \
        .split("]", 1)[0]


def test_texts_of_a_row_are_escaped_one_by_one(spark):
    wide = spark.createDataFrame([("a\nb", "plain", None), ("x", "y", "z"), (None, "c\\d", "\r"), ("", None, None)],
                                 "ad_name string, ad_type string, ad_status string") \
        .withColumn("ad_created_at", F.to_date(F.lit("0999-02-09")))
    cols = ["ad_name", "ad_type", "ad_status", "ad_created_at"]
    rows = E._as_text(wide, cols, cols[:3]).collect()
    assert [tuple(r) for r in rows] == [(*r, "02/09/0999 0:00") for r in [
        ("a\\nb", "plain", None), ("x", "y", "z"), (None, "c\\\\d", "\\r"), ("", None, None)]]


def test_stream_stages_typed_facts_in_small_splits(spark, tmp_path):
    """Text is converted once, a row names its file only, and tasks get smaller parts of files."""
    inbox, seen = str(tmp_path / "inbox"), []
    rows = [("1", "2020-05-01T00:00:00.000-05:00", "3.9", "0.25"), ("1", "2020-05-02T00", "", "x"),
            ("2", " ", "5", ""), (" ", "2020-05-03", "5", ""), ("3", "no day", "5", "")]
    raw = spark.createDataFrame(rows, "ad_id string, adstats_date string, spend string, frequency string")
    E.write_extract(raw, f"{inbox}/drop=1")
    wh = Warehouse(spark, str(tmp_path / "warehouse")).create()

    def load(wh, raw, *args, **kwargs):
        seen.append((dict(raw.dtypes), spark.conf.get(SPLIT), raw.sparkSession.conf.get(SPLIT)))
        return loads.daily_load(wh, raw, *args, **kwargs)

    before = spark.conf.get(SPLIT)
    with patch.object(dayload, "daily_load", load):
        dayload.load_new_extracts(wh, inbox, str(tmp_path / "state"), dt.date(2020, 5, 17))
    (types, *splits), = seen
    assert (types["spend"], types["frequency"], types["stats_date"]) == ("bigint", "float", "date")
    assert types[RANK] == "int" and not {FILE, *VERSION} & set(types)
    assert splits == ["32m", "32m"] and spark.conf.get(SPLIT) == before
    assert [(r.ad_id, str(r.stats_date), r.spend, r.frequency) for r in wh.facts("ad_stats", S.DAY).collect()] == [
        ("1", "2020-05-01", 3, 0.25)]


def test_files_are_ranked_by_their_extract(spark):
    """Part files of a folder are one extract; single files are newer than those, by their time."""
    early, late = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    files = [("file:/in/b%20x/part-1.csv", late), ("file:/in/b%20x/part-2.csv", early), ("file:/in/a/part-1.csv", late),
             ("file:/in/z.csv", early), ("file:/in/a.csv", late), ("file:/in/a.csv", late)]
    rows = spark.createDataFrame(files, f"{FILE} string, {dayload.MODIFIED} timestamp")
    got = dayload._file_ranks(rows).collect()
    assert sorted((r[RANK], r[FILE].removeprefix("file:/in/")) for r in got) == [
        (1, "a/part-1.csv"), (2, "b%20x/part-1.csv"), (2, "b%20x/part-2.csv"), (3, "z.csv"), (4, "a.csv")]


def test_typed_days_are_the_days_of_the_text(spark):
    """Odd days, ids and numbers end the same whether text or typed rows are loaded."""
    days = ["2020-05-01", "2020-05-01T10:00:00Z", "\t2020-05-01", " ", "", None, "05/01/2020 0:00", "2020-13-01"]
    numbers = ["1.9", "-3.9", "", None, "NaN", "1e30", " 7 ", "abc", "9007199254740993", "Infinity"]
    rows = [(i, d, n) for i in ("a", " ", "", None) for d in days for n in numbers]
    text = spark.createDataFrame(rows, "ad_id string, adstats_date string, n string") \
        .select("ad_id", "adstats_date", *[F.col("n").alias(m) for m in S.STATS_METRICS])
    parts = text.withColumn(RANK, F.length("spend"))
    for raw, version in ((text, None), (parts, [RANK])):
        want, got = E.day_rows(raw, version), E.typed_day_rows(E.with_day_values(raw), version)
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_many_rows_in_small_files_are_not_broadcast(spark, monkeypatch):
    """Files of repeated values are small on disk, what a driver would collect of them is not."""
    monkeypatch.setattr(session, "FEW_ROWS", 50)
    facts = session.staged(spark.range(200).selectExpr("string(id % 90) ad_id", "'x' region"), "few-bytes")
    totals = session.staged(spark.range(100).selectExpr("string(id) ad_id", "'y' spend"), "few-bytes")
    few = session.staged(spark.range(40).selectExpr("string(id) ad_id", "'y' spend"), "few-rows")
    for rows, left in ((attach.geo_with_lifetime(facts, totals), 210), (attach.attach_facts(facts, totals), 210)):
        assert "BroadcastHashJoin" not in _plan(rows) and rows.count() == left
    text = _plan(attach.attach_facts(facts, few))
    assert "BroadcastHashJoin" in text and text.count("BroadcastHashJoin") == 1, text


def test_parts_of_a_row_carry_their_own_values_only(spark):
    """Every part of every row is sorted by key, so none holds what the other parts say."""
    raw = spark.createDataFrame([], S.text_schema(S.WIDE_DAY_COLUMNS)).withColumns(
        {VERSION[0]: F.current_timestamp(), VERSION[1]: F.lit("x")})
    text = newest_versions(raw)._jdf.queryExecution().analyzed().toString()
    assert re.search(r"Project \[k#\d+\]\n", text), text
