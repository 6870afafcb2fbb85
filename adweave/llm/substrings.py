"""Exact removal of byte strings that occur again, by distributed prefix doubling.

The rank of a string is a 64-bit name, so equal strings have equal ranks wherever they lie,
and the rank of twice the length is the name of a pair: the ranks of its halves, one offset
apart. Offsets double from ``FIRST`` to ``LENGTH``; a position whose rank is unique leaves.

1. Strings of FIRST bytes. Every string of LENGTH bytes holds LENGTH - FIRST + 1 of them, and
   the one of smallest rank is found from the string alone, so only such positions (one in
   about 75) have to be sorted. A position of length LENGTH stays a candidate only if its
   smallest part has a rank that occurs twice.
2. Pairs at offset FIRST, then at twice that, up to LENGTH, at all candidates. The last
   ranks are dealt by rank into buckets of about ``BUCKET`` ranks; a task sorts its bucket
   and answers with one bit per position.

Every byte under a repeated position goes. Texts that are copies of each other are one class
(128-bit names); a class of several rows of at least LENGTH bytes is removed whole, and one
of its rows takes part for the sake of the others. Only rows with candidates are shuffled.

Null texts are empty and keep nothing. Texts shorter than LENGTH stay as they are. Rows with
equal text get equal results, whatever their doc_id (it may be null or repeat). An empty
table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adweave.llm import textbatch as T
from adweave.llm.bittable import Wanted, bit_table
from adweave.session import staged

LENGTH, FIRST = 200, 50
BUCKET = 4_000_000  # ranks sorted by one task
PACK = 1_000_000  # bytes of candidates' texts that are ranked together
EMPTY = hashlib.sha256(b"").hexdigest()


def sliding(v: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    n, span = len(v), 1
    while span * 2 <= width:
        v = pick(v[:-span], v[span:])
        span *= 2
    return pick(v[:n - width + 1], v[width - span:width - span + n - width + 1])


def windows(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which positions of a buffer begin LENGTH bytes of one text."""
    edge = np.zeros(n + 1, np.int32)
    long = end - start >= LENGTH
    np.add.at(edge, start[long], 1)
    np.add.at(edge, end[long] - LENGTH + 1, -1)
    return np.cumsum(edge[:-1]).astype(bool)[:max(n - LENGTH + 1, 0)]


def smallest(rank: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Positions that hold the smallest rank of some window (``inside``: which windows count)."""
    width = LENGTH - FIRST + 1
    low = np.where(inside, sliding(rank, width, np.minimum), 0)
    pad = np.zeros(width - 1, T.U64)
    return np.flatnonzero(sliding(np.concatenate([pad, low, pad]), width, np.maximum) == rank)


SEEDS = (T.U64(0x2545F4914F6CDD1D), T.U64(0xD1342543DE82EF95))


def first_ranks(buf: np.ndarray, which: int = 0) -> np.ndarray:
    """Ranks of all FIRST-byte strings: eight bytes are a number, longer ones pairs of ranks."""
    words = np.ndarray((len(buf) - 7,), "<u8", np.ascontiguousarray(buf), strides=(1,)) ^ SEEDS[which]
    return _grown(T.mix(words), 8, FIRST)


def ranks(buf: np.ndarray, which: int) -> np.ndarray:
    """Ranks of all LENGTH-byte strings from pairs of ranks at doubled offsets."""
    return _grown(first_ranks(buf, which), FIRST, LENGTH)


def _grown(rank: np.ndarray, length: int, wanted: int) -> np.ndarray:
    while length < wanted:
        step = min(length, wanted - length)
        n = len(rank) - step
        pair = rank[:n] * T.U64(0x9E3779B97F4A7C15)
        pair += rank[step:]
        rank = T.mix(pair)
        length += step
    return rank


def _first_ranks(docs: DataFrame, wanted: bytes | None) -> DataFrame:
    """(h, k, pos): the sampled positions' ranks, only those in ``wanted`` if given."""
    table = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(table.value) if table.value else None
        for p in T.pieces(batches, limit=PACK):
            if len(p.buf) < LENGTH:
                continue
            rank = first_ranks(p.buf)
            at = smallest(rank, windows(p.start, p.end, len(p.buf)))
            if want:
                at = at[want(rank[at])]
            row = p.row_of(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.signed(rank[at])), p.column("k").take(pa.array(row)),
                 pa.array((at - p.start[row]).astype(np.int32))], ["h", "k", "pos"])

    return docs.select("k", "text").mapInArrow(run, "h bigint, k bigint, pos int")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the classes in ``wanted`` (by the mark of a row), read again and joined."""
    table = docs.sparkSession.sparkContext.broadcast(
        bit_table(wanted.select(F.col("mark").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(table.value)
        for b in batches:
            mark = b.column(b.schema.get_field_index("mark")).to_numpy()
            yield b.filter(pa.array(want(mark.view(np.uint64))))

    slim = docs.select("k", "k2", "mark", "text")
    # One row a class: dropping repeated rows needs no further shuffle than the join's.
    return slim.mapInArrow(run, "k bigint, k2 bigint, mark bigint, text string") \
        .join(wanted.withColumnRenamed("mark", "of"), ["k", "k2"]).where("mark = of") \
        .dropDuplicates(["k", "k2"])


def _pack(texts: DataFrame) -> DataFrame:
    """Texts with their candidates, several to a row: src names the row.

    ``at`` are the starts of texts in ``data`` (and its end); ``first`` and ``stop`` bound the
    runs of candidate positions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in T.pieces(batches, limit=PACK):
            if len(p.buf) < LENGTH:
                continue
            rank = first_ranks(p.buf)
            inside = windows(p.start, p.end, len(p.buf))
            places = p.column("places")
            row = np.repeat(np.arange(p.n), np.diff(places.offsets.to_numpy()))
            held = np.full(len(rank), np.iinfo(np.uint64).max, T.U64)
            again = p.start[row] + places.flatten().to_numpy()
            held[again] = rank[again]
            width = LENGTH - FIRST + 1
            here = inside & (sliding(held, width, np.minimum) == sliding(rank, width, np.minimum))
            total = np.concatenate([[0], np.cumsum(here)])
            top = np.minimum(p.end, len(here))
            some = np.flatnonzero(total[top] > total[np.minimum(p.start, len(here))])
            if not len(some):
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], here.view(np.int8), [0]])))
            first, stop = edge[::2], edge[1::2]
            # Leave out texts without candidates.
            size = (p.end - p.start)[some]
            at = np.concatenate([[0], np.cumsum(size)])
            of = np.searchsorted(some, p.row_of(first))
            shift = at[of] - p.start[some[of]]
            data = b"".join(p.buf[p.start[i]:p.end[i]].tobytes() for i in some)
            k, k2 = (p.column(c).to_numpy()[some] for c in ("k", "k2"))
            src = k[:1].tobytes() + k2[:1].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([src], pa.binary()), pa.array([k.tolist()], pa.list_(pa.int64())),
                 pa.array([k2.tolist()], pa.list_(pa.int64())), pa.array([data], pa.large_binary())
                 .cast(pa.binary()), pa.array([at.tolist()], pa.list_(pa.int64())),
                 pa.array([(first + shift).tolist()], pa.list_(pa.int64())),
                 pa.array([(stop + shift).tolist()], pa.list_(pa.int64())),
                 pa.array([int(len(data))], pa.int64()), pa.array([int((stop - first).sum())], pa.int64())],
                ["src", "k", "k2", "data", "at", "first", "stop", "bytes", "n"])

    longs = "array<bigint>"
    return texts.select("k", "k2", "text", "places").mapInArrow(
        run, f"src binary, k {longs}, k2 {longs}, data binary, at {longs}, first {longs}, "
             f"stop {longs}, bytes bigint, n bigint")


def _dealt(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate positions of a packed row in bucket order, their ranks and buckets."""
    buf = np.frombuffer(row["data"], np.uint8)
    first, stop = np.array(row["first"]), np.array(row["stop"])
    size = stop - first
    pos = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    bucket = (ranks(buf, 0)[pos] % T.U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return pos[order], ranks(buf, 1)[pos[order]], bucket[order]


def _repeated(packed: DataFrame, buckets: int) -> DataFrame:
    """(src, bucket, bits): which ranks of a packed row's bucket occur twice anywhere."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                _, rank, bucket = _dealt(row, buckets)
                which, at = np.unique(bucket, return_index=True)
                cut = np.append(at, len(bucket))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which), pa.array([row["src"]] * len(which), pa.binary()),
                     pa.array([rank[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary())],
                    ["bucket", "src", "ranks"])

    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        size = pdf["ranks"].map(len).to_numpy() // 8
        rank = np.frombuffer(b"".join(pdf["ranks"]), np.uint64)
        order = np.argsort(rank)
        same = rank[order[1:]] == rank[order[:-1]]
        twice = np.zeros(len(rank), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cut = np.concatenate([[0], np.cumsum(size)])
        return pd.DataFrame({"src": pdf["src"], "bucket": pdf["bucket"], "bits": [
            np.packbits(twice[a:b]).tobytes() for a, b in zip(cut, cut[1:])]})

    return packed.select("src", "data", "first", "stop") \
        .mapInArrow(deal, "bucket bigint, src binary, ranks binary") \
        .groupBy("bucket").applyInPandas(sort, "src binary, bucket bigint, bits binary")


def _remove(packed: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """(k, k2, n_removed, n_spans, kept_sha256, kept) of all packed texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                pos, _, bucket = _dealt(row, buckets)
                twice = np.zeros(len(pos), bool)
                for a in row["answers"]:
                    lo, hi = np.searchsorted(bucket, [a["bucket"], a["bucket"] + 1])
                    twice[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8),
                                                 count=hi - lo).astype(bool)
                buf = np.frombuffer(row["data"], np.uint8)
                edge = np.zeros(len(buf) + 1, np.int32)
                np.add.at(edge, pos[twice], 1)
                np.add.at(edge, pos[twice] + LENGTH, -1)
                gone = np.cumsum(edge)[:-1] > 0
                at = np.array(row["at"])
                total = np.concatenate([[0], np.cumsum(gone)])
                begins = gone & ~np.concatenate([[False], gone[:-1]])
                begins[at[:-1]] |= gone[at[:-1]]
                spans = np.concatenate([[0], np.cumsum(begins)])
                kept = [buf[x:y][~gone[x:y]].tobytes() for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["k"], pa.int64()), pa.array(row["k2"], pa.int64()),
                     pa.array(total[at[1:]] - total[at[:-1]]),
                     pa.array(spans[at[1:]] - spans[at[:-1]]),
                     pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                     pa.array(kept, pa.binary())],
                    ["k", "k2", "n_removed", "n_spans", "kept_sha256", "kept"])

    per = answers.groupBy("src").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    return packed.select("src", "k", "k2", "data", "at", "first", "stop").join(per, "src") \
        .mapInArrow(run, "k bigint, k2 bigint, n_removed bigint, n_spans bigint, "
                         "kept_sha256 string, kept binary")


def removals(docs: DataFrame, kept: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    ``kept`` adds the remaining bytes of the texts that lose some but not all (else null).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumns({"k": F.xxhash64("text"), "k2": F.xxhash64(F.lit(7), "text")}) \
        .withColumn("mark", F.xxhash64("doc_id", "k", "k2"))
    rows = staged(docs.select("doc_id", "k", "k2", "mark",
                              F.octet_length("text").cast("bigint").alias("n_bytes"),
                              F.sha2("text", 256).alias("sha")), "substr-rows")
    twice = staged(_first_ranks(docs, None).groupBy("h").count().where("count > 1").select("h"),
                   "substr-first")
    places = _first_ranks(docs, bit_table(twice)).join(twice, "h", "left_semi") \
        .select("k", "pos").distinct().groupBy("k").agg(F.collect_list("pos").alias("places"))
    classes = staged(rows.where(f"n_bytes >= {LENGTH}").groupBy("k", "k2")
                     .agg(F.count("*").alias("copies"), F.min("mark").alias("mark")),
                     "substr-classes")
    wanted = staged(classes.drop("copies").join(places, "k"), "substr-wanted")
    packed = staged(_pack(_texts(docs, wanted)), "substr-packed")
    n = packed.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // BUCKET + 1)
    answers = staged(_repeated(packed, buckets), "substr-answers")
    cols = ["k", "k2", "n_removed", "n_spans", "kept_sha256"] + (["kept"] if kept else [])
    some = staged(_remove(packed, answers, buckets).select(*cols), "substr-removed") \
        .where("n_removed > 0")
    whole = F.col("copies") > 1
    known = classes.select("k", "k2", "copies").join(some, ["k", "k2"], "left") \
        .where("copies > 1 or n_removed is not null")
    out = rows.join(staged(known, "substr-known"), ["k", "k2"], "left")
    pick = lambda all_, part, none: F.when(whole, all_).otherwise(F.coalesce(part, none))
    return out.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).alias("n_removed"),
        pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        pick(F.lit(EMPTY), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"),
        *([F.when(whole, None).otherwise(F.col("kept")).alias("kept")] if kept else []))
