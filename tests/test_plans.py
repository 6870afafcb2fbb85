"""The plans are the ones the design relies on."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.operators import attach as A
from adweave.operators import rollup as R
from adweave.operators.dedupe import latest_per_key
from adweave.operators.merge import apply_policy
from adweave.session import fresh_path
from adweave.sources import extract as E
from adweave.sources import payloads as P
from adweave.sources.drift import unknown_keys
from adweave.sources.warehouse import Warehouse, empty_table, included_accounts


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def warehouse(spark):
    wh = Warehouse(spark, fresh_path(spark, "plan-warehouse")).create()
    day = spark.createDataFrame([("a", dt.date(2020, m, 1)) for m in range(1, 7)],
                                "ad_id string, stats_date date")
    rows = day.withColumns({"granularity": F.lit(S.DAY),
                            "stats_month": F.substring(F.col("stats_date").cast("string"), 1, 7)})
    wh.publish("ad_stats", empty_table(spark, "ad_stats").unionByName(
        rows, allowMissingColumns=True))
    return wh


def stored(spark, schema, name):
    path = fresh_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_account_filter_and_columns_reach_the_scan(spark):
    wh = Warehouse(spark, fresh_path(spark, "accounts")).create("ad_account")
    wh.publish("ad_account", empty_table(spark, "ad_account").unionByName(
        spark.createDataFrame([("1",)], "ad_account_id string"), allowMissingColumns=True))
    text = plan(included_accounts(wh.table("ad_account")))
    assert "EqualTo(ad_account_include_ind,YES)" in text
    assert "created_on" not in text.split("ReadSchema")[1]


def test_fact_reads_prune_partitions(spark):
    wh = warehouse(spark)
    feb = F.lit(dt.date(2020, 2, 1))
    ranged = R.in_range(wh.table("ad_stats"), S.DAY, feb, F.last_day(feb)).select("ad_id")
    months = wh.facts("ad_stats", S.DAY).where(F.col("stats_month").isin("2020-02", "2020-05"))
    for df, count in ((ranged, 1), (months, 2)):
        filters = plan(df).split("PartitionFilters: [")[1].split("]")[0]
        assert "granularity" in filters and "stats_month" in filters
        assert df.count() == count
        assert len(df.inputFiles()) >= count


def test_outer_attach_has_no_full_outer_join(spark):
    facts = stored(spark, "ad_id string, spend long", "facts")
    dims = stored(spark, "ad_id string, ad_name string", "dims")
    text = plan(A.outer_attach(facts, dims, "ad_id"))
    assert "FullOuter" not in text and "LeftOuter" in text and "LeftAnti" in text


def test_one_per_key_combines_before_the_shuffle(spark):
    rows = stored(spark, "ad_id string, stats_date date, spend long", "rows")
    text = plan(latest_per_key(rows, ["ad_id", "stats_date"]))
    assert text.index("partial_max") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1 and "Window" not in text


def test_exact_copies_hash_aggregate_first(spark):
    raw = stored(spark, S.text_schema(S.WIDE_DAY_COLUMNS), "wide")
    text = plan(E.entity_rows(raw, "campaign", F.lit(dt.date(2020, 1, 1))))
    assert "HashAggregate" in text and "partial_count" in text
    assert "impressions" not in text.split("ReadSchema")[1]


def test_merge_does_not_shuffle_deduplicated_rows_again(spark):
    raw = stored(spark, S.text_schema(S.WIDE_DAY_COLUMNS), "wide-day")
    merged = apply_policy("day_stats", stored(spark, S.table_schema("ad_stats"), "day"),
                          E.day_rows(raw))
    assert plan(merged).count("Exchange") == 2  # one per side


def test_month_sums_combine_before_the_shuffle(spark):
    text = plan(R.month_sums(stored(spark, S.table_schema("ad_stats"), "facts-day")))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_parsing_never_shuffles(spark):
    landed = stored(spark, S.LANDING, "landing")
    for df in (P.read_day_stats(landed), P.read_geo(landed), P.read_lifetime_stats(landed),
               P.read_entity(landed, "ad")):
        text = plan(df)
        assert "Exchange" not in text and "EqualTo(status,200)" in text
        assert "Python" not in text and text.count("from_json") <= 1


def test_wide_join_scans(spark):
    """At most one scan per dimension and two of the facts; the joined dimensions are read back."""
    dims = [stored(spark, S.text_schema([c for c in S.columns_of(t) if c not in
                                         ("created_on", "updated_on")]), f"dim-{t}")
            for t in ("campaign", "ad_squad", "ad")]
    facts = stored(spark, "ad_id string, adstats_date string, spend long", "wide-facts")
    text = plan(A.wide_extract(*dims, facts))
    assert text.count("FileScan") <= 3 + 2


def test_one_parse_feeds_readers_and_rejects(spark):
    landed = stored(spark, S.LANDING, "landing-once")
    assert plan(P.parsed(landed, "ad")).count("from_json") == 1
    kept = stored(spark, P.parsed(landed, "ad").schema, "parsed-once")
    for df in (P.read_entity(kept, "ad"), P.rejects(kept, "ad")):
        assert "from_json" not in plan(df) and "Exchange" not in plan(df)


def test_drift_opens_bodies_without_a_shuffle(spark):
    landed = stored(spark, S.LANDING, "landing-drift")
    text = plan(unknown_keys(landed, "day"))
    assert "Exchange" not in text and "Join" not in text and text.lower().count("parsejson") == 1
