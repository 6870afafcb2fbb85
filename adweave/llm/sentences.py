"""Removal of repeated passages by sliding sentence spans.

A sentence ends after ``.``, ``!``, ``?`` or a line feed. Every two consecutive sentences of a
text are a span, however short, so a repeated run of any length is covered from its first
sentence to its last: where a run stands again, so do all its pairs, in the same order of
places. The fewest sentences from every start that hold ``LEAST_WORDS`` words are a span too;
they also match where lines are broken elsewhere (runs of equal words but other sentences are
found from that many words on, not below). Spans with the same words (ASCII letters in
lower case, any white space between) are the same wherever they lie. Of equal spans the first
by doc_id, then text, then place stays; the sentences of all others are removed.

Spans are named by 128 bits. Names are counted with a combine before the shuffle; the texts
are read again for those that occur twice (a bit table of bounded size filters inside the scan),
so neither unique spans nor unique texts are joined. A span that very many texts share is a
hot key only of joins that adaptive execution splits.

Null texts are empty; texts without two sentences keep everything. Rows
that repeat doc_id and text altogether are one document and share its result; a null doc_id
comes before all others. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adweave.llm import textbatch as T
from adweave.llm.bittable import Wanted, bit_table
from adweave.session import staged

LEAST_WORDS = 20
STOPS = np.frombuffer(b".!?\n", np.uint8)


@dataclass
class Sentences:
    """Sentences of a piece with a word: row, first word, byte where each starts to count.

    ``begin`` parts a text completely: what lies between two sentences goes with the former.
    """

    row: np.ndarray
    word: np.ndarray
    begin: np.ndarray
    first: np.ndarray  # of each row, into the sentences; one more at the end
    words: T.Words


def sentences(p: T.Piece) -> Sentences:
    w = T.words(p, T.NOT_SPACE)
    stop = np.isin(p.buf, STOPS)
    before = np.concatenate([[0], np.cumsum(stop)])[w.start]
    new = np.ones(len(w.row), bool)
    new[1:] = (before[1:] != before[:-1]) | (w.row[1:] != w.row[:-1])
    # A word such as "a.b" holds a stop; the sentence then ends with the word.
    word = np.flatnonzero(new)
    row = w.row[word]
    begin = w.start[word].copy()
    first = np.searchsorted(row, np.arange(p.n + 1))
    some = first[1:] > first[:-1]
    begin[first[:-1][some]] = p.start[some]
    return Sentences(row, word, begin, first, w)


def spans(p: T.Piece, s: Sentences) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last sentence of every span, and the two halves of its name."""
    n = len(s.word)
    if n < 2:
        none = np.zeros(0, np.int64)
        return none, none, none.view(T.U64), none.view(T.U64)
    end = np.append(s.word[1:], len(s.words.row))
    at = np.arange(n)
    last = np.searchsorted(end, s.word + LEAST_WORDS)
    long = last > at + 1  # others are pairs, or one sentence
    i, j = np.append(at, at[long]), np.append(at + 1, last[long])
    ok = j < n
    i, j = i[ok], j[ok]
    ok = s.row[j] == s.row[i]
    i, j = i[ok], j[ok]
    names = []
    for which in (0, 1):
        h = T.Hashes(p.buf, which, fold=True).span(s.words.start, s.words.end)
        names.append(T.Hashes.of(h, which).span(s.word[i], end[j]))
    return i, j, names[0], names[1]


def _counted(docs: DataFrame) -> DataFrame:
    """(h, g): names of spans that occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in T.pieces(batches):
            _, _, h, g = spans(p, sentences(p))
            yield pa.RecordBatch.from_arrays([pa.array(T.signed(h)), pa.array(T.signed(g))],
                                             ["h", "g"])

    return docs.select("text").mapInArrow(run, "h bigint, g bigint") \
        .groupBy("h", "g").count().where("count > 1").select("h", "g")


def _places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per document (h null), and one per place of a wanted span (or a false hit)."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(table.value)
        for p in T.pieces(batches):
            s = sentences(p)
            i, j, h, g = spans(p, s)
            hit = want(h)
            i, j, h, g = i[hit], j[hit], h[hit], g[hit]
            row = s.row[i]
            take = pa.array(row)
            ids, keys = p.column("doc_id"), p.column("key")
            none = pa.nulls(p.n, pa.int64())
            int32 = lambda v: pa.array(v.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [ids, keys, int32(np.diff(s.first)), int32(s.words.per_row), none, none,
                 pa.nulls(p.n, pa.int32()), pa.nulls(p.n, pa.int32())], names)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), keys.take(take), int32(np.diff(s.first)[row]),
                 int32(s.words.per_row[row]), pa.array(T.signed(h)), pa.array(T.signed(g)),
                 int32(i - s.first[row]), int32(j - s.first[row])], names)

    names = ["doc_id", "key", "n_sentences", "n_words", "h", "g", "i", "j"]
    return docs.select("doc_id", "key", "text").mapInArrow(
        run, "doc_id bigint, key bigint, n_sentences int, n_words int, h bigint, g bigint, "
             "i int, j int")


def _texts(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """What is left of the texts that lose sentences: mark, key, sentences, words, digest, text."""
    table = docs.sparkSession.sparkContext.broadcast(
        bit_table(removed.select(F.col("mark").alias("h"))))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(table.value)
        for b in batches:
            mark = b.column(b.schema.get_field_index("mark")).to_numpy()
            yield b.filter(pa.array(want(mark.view(np.uint64))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in T.pieces(batches):
            s = sentences(p)
            out = {"n_removed": [], "n_removed_words": [], "kept_sha256": [], "kept": []}
            last = np.append(s.word[1:], len(s.words.row))
            raw = p.buf.tobytes()
            for r, runs in enumerate(p.column("runs").to_pylist()):
                lo, hi = int(s.first[r]), int(s.first[r + 1])
                gone = np.zeros(hi - lo + 1, np.int32)
                for run in runs:
                    gone[run["i"]] += 1
                    gone[run["j"] + 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                stop = np.append(s.begin[lo + 1:hi], p.end[r])
                kept = b"".join(raw[a:b] for a, b, g in zip(s.begin[lo:hi], stop, gone) if not g)
                out["n_removed"].append(int(gone.sum()))
                out["n_removed_words"].append(int((last[lo:hi] - s.word[lo:hi])[gone].sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [p.column("mark"), p.column("key"),
                 *[pa.array(out[c], pa.int64()) for c in ("n_removed", "n_removed_words")],
                 *[pa.array(out[c], pa.string()) for c in ("kept_sha256", "kept")]],
                ["mark", "key", *out])

    return docs.select("mark", "key", "text").mapInArrow(
        some, "mark bigint, key bigint, text string") \
        .join(removed, ["mark", "key"]).dropDuplicates(["mark", "key"]) \
        .select("mark", "key", "text", "runs").mapInArrow(
            cut, "mark bigint, key bigint, n_removed bigint, n_removed_words bigint, "
                 "kept_sha256 string, kept string")


def removals(docs: DataFrame, kept: bool = False) -> DataFrame:
    """Per row: doc_id, n_sentences, n_words, n_removed, n_removed_words, kept_sha256.

    ``kept`` adds what is left of texts that lose sentences (null: nothing is lost).
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("key", F.xxhash64("text")).withColumn("mark", F.xxhash64("doc_id", "key"))
    wanted = staged(_counted(docs), "span-names")
    places = staged(_places(docs, wanted), "span-places")
    # A stage of its own: what follows a join in its partitioning would keep a hot span whole.
    found = staged(places.where("h is not null").join(wanted, ["h", "g"], "left_semi")
                   .select("h", "g", "doc_id", "key", "i", "j"), "span-wanted")
    found = staged(found.distinct(), "span-found")  # repeated rows are one document
    first = staged(found.groupBy("h", "g").agg(F.min(F.struct("doc_id", "key", "i")).alias("first")),
                   "span-first")
    later = found.join(first, ["h", "g"]) \
        .where(~F.struct("doc_id", "key", "i").eqNullSafe(F.col("first")))
    removed = staged(later.groupBy("doc_id", "key")
                     .agg(F.collect_list(F.struct("i", "j")).alias("runs"))
                     .select(F.xxhash64("doc_id", "key").alias("mark"), "key", "runs"),
                     "span-removed")
    cut = staged(_texts(docs, removed), "span-texts") if kept else \
        staged(_texts(docs, removed).drop("kept"), "span-texts")
    rows = docs.select("doc_id", "key", "mark", F.sha2("text", 256).alias("sha"))
    sizes = places.where("h is null").select(
        F.xxhash64("doc_id", "key").alias("mark"), "key", "n_sentences", "n_words") \
        .dropDuplicates(["mark", "key"])
    out = rows.join(sizes, ["mark", "key"]).join(cut, ["mark", "key"], "left")
    return out.select(
        "doc_id", F.col("n_sentences").cast("bigint").alias("n_sentences"),
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_removed_words", F.lit(0)).cast("bigint").alias("n_removed_words"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *(["kept"] if kept else []))
