"""Benchmark decontamination: a prefix-filtered join of exact word windows.

A window is ``WINDOW`` consecutive words of a benchmark item (all its words if it has
fewer). A window occurs in a document only if all its shingles of three words do, so the
rarest one suffices as its prefix: shingles are ordered by their count over all documents, a
window with a shingle that occurs nowhere is dropped, and the others are looked up by the
prefix alone. Length and positional bounds (does the window fit around the place where the
prefix was found?) come next, then every word of the window is compared.

Documents are read twice as whole record batches; neither pass shuffles a text. What leaves
a pass is filtered by a bit table over the wanted shingles (``bittable``). Its size is
fixed, so it may be broadcast; false hits cost a row each and end in the join.

Null and empty texts have no words; items without words or id have no window. Equal windows of
several items are looked up once. Rows with equal doc_id and text get equal results, rows
that share only a doc_id are judged apart. Further columns are ignored by ``hits``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adweave.llm import textbatch as T
from adweave.llm.bittable import Wanted, bit_table
from adweave.session import staged

WINDOW = 10
SHINGLE = 3


class Tokens:
    """Lower-cased words of a piece, their hashes, and windows of them as text."""

    def __init__(self, p: T.Piece):
        self.piece, self.words = p, T.words(p, T.ALNUM)
        self.hash = T.Hashes(p.buf, fold=True).span(self.words.start, self.words.end)
        self.lower = None

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        return T.shingles(self.hash, self.words.row, size)

    def text(self, first: int, last: int) -> list[str]:
        if self.lower is None:
            table = np.arange(256, dtype=np.uint8)
            table[65:91] = table[97:123]
            self.lower = table[self.piece.buf].tobytes()
        w = self.words
        return [self.lower[w.start[i]:w.end[i]].decode("utf-8", "replace")
                for i in range(first, last)]


def windows(items: DataFrame, text: str = "text") -> DataFrame:
    """(item_id, words, off, size, h): every window with every shingle in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in T.pieces(batches, "text"):
            t = Tokens(p)
            size_of = {}
            for size in range(1, SHINGLE + 1):
                name, at = t.shingles(size)
                size_of[size] = dict(zip(at.tolist(), T.signed(name).tolist()))
            out = {"item_id": [], "words": [], "off": [], "size": [], "h": []}
            ids = p.column("item_id").to_pylist()
            for r in range(p.n):
                lo, hi = int(t.words.first[r]), int(t.words.first[r + 1])
                length = min(WINDOW, hi - lo)
                size = min(SHINGLE, length)
                for i in range(lo, hi - length + 1 if length else lo):
                    text_ = t.text(i, i + length)
                    for off in range(length - size + 1):
                        for c, v in zip(out.values(),
                                        (ids[r], text_, off, size, size_of[size][i + off])):
                            c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item_id"], p.column("item_id").type),
                 pa.array(out["words"], pa.list_(pa.string())),
                 pa.array(out["off"], pa.int32()), pa.array(out["size"], pa.int32()),
                 pa.array(out["h"], pa.int64())], list(out))

    kind = dict(items.dtypes)["item_id"]
    named = items.where("item_id is not null")
    return named.select("item_id", F.col(text).alias("text")).mapInArrow(
        run, f"item_id {kind}, words array<string>, off int, size int, h bigint")


def _counts(docs: DataFrame, wanted: bytes, sizes: list[int]) -> DataFrame:
    """How often each wanted shingle occurs, summed per piece before the shuffle."""
    table = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(table.value)
        for p in T.pieces(batches, "text"):
            t = Tokens(p)
            for size in sizes:
                name, _ = t.shingles(size)
                h, n = np.unique(T.signed(name[want(name)]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), size, np.int32)), pa.array(h),
                     pa.array(n.astype(np.int64))], ["size", "h", "n"])

    return docs.select("text").mapInArrow(run, "size int, h bigint, n bigint") \
        .groupBy("size", "h").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, wanted: bytes, sizes: list[int]) -> DataFrame:
    """One row per document (h null) and one per place of a wanted shingle.

    A place carries the words around it that any window could cover; ``idx`` is the place in
    ``ctx``, ``pos`` the place in the document.
    """
    table = docs.sparkSession.sparkContext.broadcast(wanted)
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()),
                        ("size", pa.int32()), ("h", pa.int64()), ("pos", pa.int64()),
                        ("idx", pa.int32()), ("ctx", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(table.value)
        for p in T.pieces(batches, "text"):
            t = Tokens(p)
            n = t.words.per_row.astype(np.int64)
            none = pa.nulls(p.n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [p.column("doc_id"), p.column("key"), pa.array(n), pa.nulls(p.n, pa.int32()), none,
                 none, pa.nulls(p.n, pa.int32()), pa.nulls(p.n, pa.list_(pa.string()))],
                schema=schema)
            for size in sizes:
                name, at = t.shingles(size)
                hit = want(name)
                name, at = name[hit], at[hit]
                for s in range(0, len(at), 20_000):
                    a, row = at[s:s + 20_000], t.words.row[at[s:s + 20_000]]
                    lo = np.maximum(a - WINDOW + 1, t.words.first[row])
                    hi = np.minimum(a + WINDOW, t.words.first[row + 1])
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [p.column("doc_id").take(take), p.column("key").take(take),
                         pa.array(n[row]), pa.array(np.full(len(a), size, np.int32)),
                         pa.array(T.signed(name[s:s + 20_000])),
                         pa.array((a - t.words.first[row]).astype(np.int64)),
                         pa.array((a - lo).astype(np.int32)),
                         pa.array([t.text(x, y) for x, y in zip(lo.tolist(), hi.tolist())],
                                  pa.list_(pa.string()))], schema=schema)

    ddl = ("doc_id bigint, key bigint, n_words bigint, size int, h bigint, pos bigint, idx int, "
           "ctx array<string>")
    return docs.mapInArrow(run, ddl)


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document row: doc_id, key, n_words, n_hit, item_ids (sorted strings)."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    found = staged(windows(items), "decontam-windows")
    shingle = found.select("size", "h").distinct()
    sizes = [r.size for r in shingle.select("size").distinct().collect()]
    counts = staged(_counts(docs, bit_table(shingle), sizes), "decontam-counts")
    prefix = staged(
        found.select("words", "off", "size", "h").distinct()
        .join(counts, ["size", "h"], "left")
        .groupBy("words").agg(F.min(F.coalesce("n", F.lit(0))).alias("least"),
                              F.min(F.struct("n", "h", "off", "size")).alias("p"))
        .where("least > 0")
        .select("words", "p.h", "p.off", "p.size", F.size("words").alias("len")),
        "decontam-prefix")
    places = staged(_places(docs, bit_table(prefix), sizes), "decontam-places")
    at = places.where("h is not null").join(prefix, ["size", "h"]) \
        .where("pos >= off and pos - off + len <= n_words") \
        .where("slice(ctx, idx - off + 1, len) = words") \
        .select("doc_id", "key", (F.col("pos") - F.col("off")).alias("start"), "len", "words")
    occurs = staged(at.distinct(), "decontam-occurrences")
    here = Window.partitionBy("doc_id", "key")
    order = here.orderBy("start", F.desc("len"))
    reached = F.max(F.col("start") + F.col("len")).over(
        order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("start") + F.col("len") - F.greatest("start", F.coalesce("reached", "start"))
    n_hit = occurs.select("doc_id", "key", "start", "len").distinct() \
        .withColumn("reached", reached) \
        .groupBy("doc_id", "key").agg(F.sum(F.greatest(new, F.lit(0))).alias("n_hit"))
    which = occurs.select("doc_id", "key", "words").distinct() \
        .join(found.select("words", F.col("item_id").cast("string").alias("item")).distinct(),
              "words") \
        .groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    rows = places.where("h is null").select("doc_id", "key", "n_words").alias("d")
    both = n_hit.alias("a").join(which.alias("b"), _same("a", "b"), "left") \
        .select("a.doc_id", "a.key", "a.n_hit", "b.item_ids").alias("r")
    return rows.join(both, _same("d", "r"), "left").select(
        "d.doc_id", "d.key", "d.n_words", F.coalesce("r.n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("r.item_ids", F.array().cast("array<string>")).alias("item_ids"))


def _same(a: str, b: str):
    return (F.col(f"{a}.key") == F.col(f"{b}.key")) \
        & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
