import contextlib
import datetime as dt
import io
import random
import re
from functools import reduce

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.operators import attach as A
from adweave.operators import carry as K
from adweave.operators.dedupe import latest_per_key
from adweave.operators.merge import POLICIES, merge_upsert
from adweave.standin import upserts


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def brute_carry(items, metrics):
    """items: (key, at, id, {metric: value or None}); the plain loop."""
    out, last = [], {}
    for key, at, i, bag in sorted(items, key=lambda t: (t[0], t[1], t[2])):
        state = last.setdefault(key, {})
        state.update(bag)
        out.append((i, *[state.get(m) for m in metrics]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("moments", [500, 3000, 1])
def test_carry_rows_with_one_hot_key(spark, moments):
    """Nearly all rows in one key, with distinct, repeated and equal times."""
    rng = random.Random(7)
    metrics = ["a", "b", "c"]
    items = []
    for i in range(3000):
        key = "hot" if i % 20 else f"k{rng.randrange(40)}"
        bag = {m: (None if rng.random() < 0.3 else float(rng.randrange(100)))
               for m in metrics if rng.random() < 0.2}
        items.append((key, i if moments == 3000 else rng.randrange(moments), i, bag))
    df = spark.createDataFrame(items, "key string, at long, id long, stats map<string,double>")
    sizes = [r["count"] for r in K.cut_rows(df, ["key"], ["at", "id"], 200)
             .groupBy("key", "piece").count().collect()]
    assert max(sizes) <= 200 and len(sizes) > 15
    got = K.carry_rows(df, ["key"], ["at", "id"], "stats", metrics, 200)
    assert rows(got, "id", *metrics) == brute_carry(items, metrics)


def test_only_large_keys_are_cut(spark, monkeypatch):
    """Pieces follow the rows of large keys; a null key is a key."""
    items = [(k, i, i, {"a": float(i)} if i % 3 == 0 else {}) for k, n in (("hot", 50), (None, 40), ("x", 5), ("y", 1))
             for i in range(n)]
    df = spark.createDataFrame(items, "key string, at long, id long, stats map<string,double>")
    cut, real = [], K.cut_rows

    def counted(rows, *args):
        cut.append(rows.groupBy("key").count().collect())
        return real(rows, *args)

    monkeypatch.setattr(K, "cut_rows", counted)
    got = K.carry_rows(df, ["key"], ["at"], "stats", ["a"], 10)
    assert sorted(map(tuple, got.select("key", "at", "a").collect()), key=repr) == sorted(
        ((k, i, float(i - i % 3)) for k, i, _, _ in items), key=repr)
    assert sorted((r["key"], r["count"]) for r in cut[0] if r["key"]) == [("hot", 50)] and len(cut[0]) == 2
    K.carry_rows(df, ["key"], ["at"], "stats", ["a"], 50)
    assert len(cut) == 1  # no key is larger than a piece
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain()
    whole = [w for w in re.findall(r"Window \[(.*?)\], \[(?:\S+(?:, \S+)*)\], \[", out.getvalue())]
    assert whole and "LeftAnti" in out.getvalue()


def test_latest_per_key_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", None, "z"), ("a", 1, "b"), ("a", 1, "c"), ("b", None, "x"), ("b", None, None)],
        "k string, v int, t string")
    want = [("a", 1, "c"), ("b", None, "x")]
    for seed in (1, 2, 3):
        mixed = df.orderBy(F.rand(seed)).repartition(3)
        assert rows(latest_per_key(mixed, ["k"], ["v"]), "k", "v", "t") == want


def test_outer_attach_equals_pandas_outer_merge(spark):
    child = pd.DataFrame({"id": ["1", "2", "3", "4", "5"], "p": ["a", "a", None, "z", "b"],
                          "name": list("vwxyz")})
    parent = pd.DataFrame({"p": ["a", "b", "c", None], "name": list("ABCN"), "n": [1, 2, 3, 4]})
    want = parent.merge(child, on="p", how="outer")
    got = A.outer_attach(spark.createDataFrame(child), spark.createDataFrame(parent), "p",
                         null_safe=True).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    clean = lambda d: sorted([tuple(None if pd.isna(x) else x for x in r)
                              for r in d[sorted(d.columns)].values.tolist()], key=repr)
    assert clean(got) == clean(want)


def test_wide_extract_keeps_childless_and_orphans(spark):
    c = spark.createDataFrame([("c1",), ("c2",)], "campaign_id string")
    s = spark.createDataFrame([("s1", "c1"), ("s2", "gone")], "ad_squad_id string, campaign_id string")
    a = spark.createDataFrame([("a1", "s1"), ("a2", "s1"), ("a3", "gone")],
                              "ad_id string, ad_squad_id string")
    f = spark.createDataFrame([("a1", 1), ("a1", 2), ("lost", 3)], "ad_id string, spend int")
    got = rows(A.wide_extract(c, s, a, f), "campaign_id", "ad_squad_id", "ad_id", "spend")
    assert got == sorted([
        ("c1", "s1", "a1", 1), ("c1", "s1", "a1", 2), (None, None, "lost", 3),
        ("c1", "s1", "a2", None), (None, "gone", "a3", None), ("gone", "s2", None, None),
        ("c2", None, None, None)], key=repr)


def test_merge_assigns_null_keeps_and_inserts(spark):
    old = spark.createDataFrame([("1", "a", 10), ("2", "b", 20)], "k string, v string, w int")
    new = spark.createDataFrame([("2", None, 99), ("3", "c", 30)], "k string, v string, w int")
    got = rows(merge_upsert(old, new, ["k"], {"v": "v"}), "k", "v", "w")
    assert got == [("1", "a", 10), ("2", None, 20), ("3", "c", 30)]


def test_merge_with_other_update_source(spark):
    old = spark.createDataFrame([("1", dt.date(2020, 1, 1))], "k string, d date")
    new = spark.createDataFrame([("1", dt.date(2020, 1, 1), dt.date(2020, 1, 9)),
                                 ("2", dt.date(2020, 1, 1), dt.date(2020, 1, 9))],
                                "k string, d date, seen date")
    assert rows(merge_upsert(old, new, ["k"], {"d": "seen"}), "k", "d") == [
        ("1", dt.date(2020, 1, 9)), ("2", dt.date(2020, 1, 1))]


def test_membership_with_repeated_existing_keys(spark):
    inc = spark.createDataFrame([("1",), ("2",), ("2",)], "k string")
    old = spark.createDataFrame([("2",), ("2",)], "k string")
    assert A.already_loaded(inc, old, ["k"]).count() == 2
    assert rows(A.not_yet_loaded(inc, old, ["k"]), "k") == [("1",)]


_VALUES = {"string": ("'old'", "'new'"), "date": ("date '2020-01-01'", "date '2020-02-02'"),
           "long": ("1", "2"), "float": ("1.5", "2.5"), "double": ("1.5", "2.5")}


def _one_row(table, which, keys):
    kinds = {"string": "varchar", "long": "bigint"}
    cols = []
    for f in S.table_schema(table).fields:
        kind = f.dataType.typeName()
        value = _VALUES[kind][0 if f.name in keys else which]
        cols.append(f"cast({value} as {kinds.get(kind, kind)}) as {f.name}")
    return "select " + ", ".join(cols) + (", date '2020-03-03' as refreshed_on" if which else "")


@pytest.mark.parametrize("policy", sorted(set(POLICIES) - {"month_first"}))
def test_check_of_a_policy_sees_every_column(spark, policy):
    """The check's result differs from the policy's as soon as any column is left out."""
    p = POLICIES[policy]
    old, new = _one_row(p.table, 0, p.keys), _one_row(p.table, 1, p.keys)
    con = duckdb.connect()
    want = con.execute(upserts.merge_sql(policy, old, new)).fetchall()
    sql = lambda text: spark.sql(text.replace(" as varchar)", " as string)"))
    stored, incoming = sql(old), sql(new)
    assert [tuple(r) for r in merge_upsert(stored, incoming, list(p.keys), p.update).collect()] == want
    fewer = [merge_upsert(stored, incoming, list(p.keys), {c: v for c, v in p.update.items() if c != x})
             .withColumn("without", F.lit(x)) for x in p.update]
    if fewer:
        got = reduce(lambda a, b: a.unionByName(b), fewer).collect()
        assert len(got) == len(p.update)
        for r in got:
            assert tuple(r)[:-1] != want[0], r.without
