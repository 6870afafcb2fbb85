"""How five filters act on a corpus in every order.

Every text is judged once: a document becomes a mask with one bit per failing filter. Equal
masks of a part (a language) are one cell with three weights: its documents, those of good
quality, those that are toxic. A cell then folds over the constant array of all 120 orders:
``transform`` goes through the orders, ``aggregate`` walks the steps of one and keeps whether
the document is still there, which makes 600 structs weighted by the cell. Cells merge by sums
of the structs of equal place. A part has at most 32 cells, so what is folded does not grow
with the documents.

Filter E compares whole texts by their SHA-256. A digest's rows are counted per (part, mask,
labels) with the smallest doc_id and how many rows carry it, before anything is brought
together, so a text that a third of all rows share makes a few rows per task.

Null and empty texts have no words: A fails, B, C and D hold; they equal each other. A null
doc_id is neither smaller nor larger than another, so E never fails for it, and it has no
labels. Rows that repeat a doc_id all count and are not smaller than each other; a document is
good or toxic if any of its label rows says so. A null lang is the part ''. An empty table
gives an empty result. Columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def _mask() -> Column:
    """Bits of the filters A to D over ``text`` and its words ``ws``."""
    n = F.size("ws")
    capitals = F.length("text") - F.length(F.translate("text", CAPITALS, ""))
    fails = [n < 100, 100 * F.size(F.array_distinct("ws")) < 80 * n,
             100 * capitals > 10 * F.length("text"), F.col("text").rlike("[#$%&*|]")]
    bits = F.lit(0)
    for i, failing in enumerate(fails):
        bits = bits + F.when(failing, 1 << i).otherwise(0)
    return bits


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) per document; the mask has the bits of A to D."""
    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("ws", F.expr(f"filter(split(text, r'{SPACE}'), w -> w <> '')")) \
        .select("doc_id", "part", _mask().alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and mask of all five filters."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.expr("coalesce(quality = 1, false)")).alias("good"),
        F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
    known = masks(docs).join(marks, "doc_id", "left") \
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    like = ["digest", "part", "mask", "good", "toxic"]
    # The smallest doc_id of a group of equal rows, and how many rows carry it.
    own = known.groupBy(*like, "doc_id").agg(F.count("*").alias("n"))
    some = own.groupBy(*like).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.isnull("doc_id"), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"))
    text = Window.partitionBy("digest")  # at most parts x 4 rows each
    first = F.when(F.col("low.doc_id") == F.min("low.doc_id").over(text), F.col("low.n")).otherwise(0)
    split = some.withColumn("first", F.col("nameless") + first) \
        .select("part", "good", "toxic", F.inline(F.array(
            F.struct("mask", F.col("first").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("first")).alias("n")))))
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


# One order is its name and the bits of its filters; the fold's state is whether the document
# is still there, and the structs so far. A cell whose only failing filter is f has mask = f.
_FOLD = """
flatten(transform(orders, o -> aggregate(
  o.bits, named_struct('there', true, 'rows', cast(array() as array<struct<
    filter_order:string,step:int,letter:int,kept:bigint,removed:bigint,redundant:bigint,
    unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>>)),
  (a, f) -> named_struct('there', a.there and mask & f = 0, 'rows', array_append(a.rows, named_struct(
    'filter_order', o.name, 'step', size(a.rows) + 1, 'letter', f,
    'kept', if(a.there and mask & f = 0, n, 0L),
    'removed', if(a.there and mask & f <> 0, n, 0L),
    'redundant', if(not a.there and mask & f <> 0, n, 0L),
    'unique_fails', if(mask = f, n, 0L),
    'good_lost', if(a.there and mask & f <> 0, good, 0L),
    'toxic_lost', if(a.there and mask & f <> 0, toxic, 0L)))),
  a -> a.rows)))"""


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step, with the counts within the part."""
    orders = F.array(*[F.struct(F.lit(o).alias("name"), F.array(
        *[F.lit(1 << FILTERS.index(f)) for f in o]).alias("bits")) for o in ORDERS])
    folded = cells(docs, labels).withColumn("orders", orders) \
        .select("part", F.inline(F.expr(_FOLD)))
    merged = folded.groupBy("part", "filter_order", "step", "letter") \
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    return merged.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))) \
        .drop("letter")
