"""Near duplicates by SuperMinHash, banding, verification and union-find.

Texts with the same set of shingles form one class, found by a 128-bit name of the set; only
classes go on, so copies cost nothing further. A class's signature is SuperMinHash: element
by element a random permutation of the ``HASHES`` slots is walked, the value at step j is
j plus a random fraction, and a document stops at the first step that cannot lower any of
its slots (long texts after one or two steps). Bands of ``ROWS`` slots give candidates: at
a similarity of 0.75 the chance to share none of the 32 bands is 5 in a million.

Candidates are verified on the full sets, never all members of a bucket with each other. A
round takes one member of every bucket as its hub and compares it with the members of other
components; the hub then leaves the bucket, and a bucket in one component is done. The first
hub is the member that shares most buckets with others (of a text and its edited copies the
text itself), later ones are drawn, so a text that misses one hub meets a different one in
each of its buckets. A round costs at most one comparison a member.

When a round links fewer than one pair in ``WORTH``, what is left mostly shares buckets by
chance. Those texts go through a prefix join: elements are ordered by rarity among them, and
linked texts share one of the rarest quarter (and one) of their elements, at places and
lengths that still allow enough common elements. So no link between candidates is lost.

Null and empty texts and those without words have an empty set and are linked with nothing.
Rows that repeat a doc_id keep their own sets and share the component of their text; rows
with a null doc_id take part by their text, a component of only such rows has a null id.
An empty table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adweave.llm import textbatch as T
from adweave.llm.bittable import Wanted, bit_table
from adweave.llm.components import components
from adweave.session import staged

SIZE = 5
HASHES = 128
ROWS = 4
BANDS = HASHES // ROWS
LEAST = 75  # percent
WORTH = 10  # pairs compared for a link, beyond which rounds of hubs end


def shingle_sets(p: T.Piece, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows of a piece, as (name, row) in row order."""
    w = T.words(p, T.NOT_SPACE)
    h = T.Hashes(p.buf, which, fold=True).span(w.start, w.end)
    name, at = T.shingles(h, w.row, SIZE, which)
    row = w.row[at]
    per = w.per_row
    short = np.flatnonzero((per > 0) & (per < SIZE))
    if len(short):
        whole = np.zeros(len(short), T.U64)
        for k in range(SIZE - 1):
            more = per[short] > k
            i = np.minimum(w.first[short] + k, len(h) - 1)
            whole = np.where(more, T.mix(whole * T.U64(3) + h[i] + T.U64(k + 1)), whole)
        name, row = np.concatenate([name, whole]), np.concatenate([row, short])
    key = T.mix(name ^ T.mix(row.astype(np.uint64) + T.U64(11)))
    _, first = np.unique(key, return_index=True)
    first.sort()
    first = first[np.argsort(row[first], kind="stable")]
    return name[first], row[first]


def signatures(name: np.ndarray, row: np.ndarray, n: int, m: int = HASHES) -> np.ndarray:
    """SuperMinHash values of n sets, given as distinct (name, row): n x m of uint64.

    Steps run for all elements at once, step 0 first. A set leaves when all its slots hold
    values below the next step; the result is that of the element-wise algorithm, because
    minima do not depend on the order of elements.
    """
    sig = np.full(n * m, np.iinfo(np.uint64).max, T.U64)

    def draw(x: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        r = T.mix(x + T.U64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        slot = j + ((r & T.U64(0xFFFFFFFF)) * T.U64(m - j) >> T.U64(32)).astype(np.int64)
        return slot, (T.U64(j) << T.U64(32)) | (r >> T.U64(32))

    slot, value = draw(name, 0)
    np.minimum.at(sig, row * m + slot, value)
    perm, at = None, None
    for j in range(1, m):
        open_ = sig.reshape(n, m).max(axis=1) >= (T.U64(j) << T.U64(32))
        live = open_[row]
        if not live.any():
            break
        if perm is None:
            name, row, slot = name[live], row[live], slot[live]
            perm = np.tile(np.arange(m, dtype=np.int16), (len(name), 1))
            at = np.arange(len(name))
            perm[at, slot] = 0
            perm[:, 0] = slot
        elif not live.all():
            name, row, perm = name[live], row[live], perm[live]
            at = np.arange(len(name))
        slot, value = draw(name, j)
        place = perm[at, slot].astype(np.int64)
        perm[at, slot] = perm[:, j]
        np.minimum.at(sig, row * m + place, value)
    return sig.reshape(n, m)


def band_names(sig: np.ndarray) -> np.ndarray:
    """n x BANDS names; a band's number is part of its name."""
    out = np.empty((len(sig), BANDS), T.U64)
    for b in range(BANDS):
        name = np.full(len(sig), b + 1, T.U64)
        for k in range(ROWS):
            name = T.mix(name * T.U64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + k])
        out[:, b] = name
    return out


def _set_names(p: T.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    name, row = shingle_sets(p)
    n = np.bincount(row, minlength=p.n)
    at = np.concatenate([[0], np.cumsum(n)])
    total = [np.zeros(len(name) + 1, T.U64) for _ in range(2)]
    np.cumsum(T.mix(name), out=total[0][1:])
    np.cumsum(T.mix(name ^ T.U64(0xD6E8FEB86659FD93)), out=total[1][1:])
    pair = np.stack([t[at[1:]] - t[at[:-1]] for t in total], axis=1)
    return name, row, n, [x.tobytes() if k else None for x, k in zip(pair, n.tolist())]


def _marks(ids: pa.Array, cls: list) -> np.ndarray:
    """A 64-bit name of a row: its doc_id and its set."""
    import pyarrow.compute as pc

    own = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(T.U64)
    first = np.frombuffer(b"".join(c[:8] if c else bytes(8) for c in cls), T.U64)
    return T.mix(first ^ T.mix(own + T.U64(5)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for p in T.pieces(batches):
        name, row, n, cls = _set_names(p)
        bands = band_names(signatures(name, row, p.n))
        offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
        flat = T.signed(np.ascontiguousarray(bands[n > 0]).reshape(-1))
        ids = p.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [ids, p.column("key"), pa.array(n.astype(np.int64)), pa.array(cls, pa.binary()),
             pa.array(T.signed(_marks(ids, cls))),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            ["doc_id", "key", "n_shingles", "cls", "mark", "bands"])


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, items): the full sets of the classes in ``wanted`` (cls, mark of one row).

    Texts are read again rather than shuffled: a bit table of bounded size lets the wanted
    rows and a few others through, which the join drops.
    """
    marks = docs.sparkSession.sparkContext.broadcast(
        bit_table(wanted.select(F.col("mark").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = Wanted(marks.value)
        for p in T.pieces(batches):
            name, row, n, cls = _set_names(p)
            mark = _marks(p.column("doc_id"), cls)
            at = np.concatenate([[0], np.cumsum(n)])
            take = np.flatnonzero(want(mark) & (n > 0))
            items = [T.signed(np.sort(name[at[i]:at[i + 1]])) for i in take]
            yield pa.RecordBatch.from_arrays(
                [pa.array([cls[i] for i in take], pa.binary()), pa.array(T.signed(mark[take])),
                 pa.array(items, pa.list_(pa.int64()))], ["cls", "mark", "items"])

    found = docs.mapInArrow(run, "cls binary, mark bigint, items array<bigint>")
    return found.join(wanted, ["cls", "mark"], "left_semi") \
        .groupBy("cls").agg(F.any_value("items").alias("items"))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose full sets are similar enough."""
    x = sets.select(F.col("cls").alias("a"), F.col("items").alias("ia"))
    y = sets.select(F.col("cls").alias("b"), F.col("items").alias("ib"))
    both = F.size(F.array_intersect("ia", "ib"))
    return pairs.join(x, "a").join(y, "b").withColumn("both", both) \
        .where(f"100L * both >= {LEAST}L * (size(ia) + size(ib) - both)").select("a", "b")


def _fits(a: str, b: str) -> str:
    return f"100L * least({a}, {b}) >= {LEAST}L * greatest({a}, {b})"


def _mixed(members: DataFrame, roots: DataFrame | None, step: int, name: str) -> DataFrame:
    """Members (bk, cls, n, score) of buckets in several components, with root and hub."""
    if roots is None:
        named = members.withColumn("root", F.col("cls"))
    else:
        of = roots.select(F.col("node").alias("cls"), F.col("root").alias("_r"))
        named = members.join(of, "cls", "left").withColumn("root", F.coalesce("_r", "cls")).drop("_r")
    named = staged(named, f"{name}-named")
    draw = F.col("score") if step == 0 else F.xxhash64("bk", "cls", F.lit(step))
    head = named.groupBy("bk").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                   F.max(F.struct(draw, "cls", "n", "root")).alias("h")) \
        .where("lo <> hi") \
        .select("bk", F.col("h.cls").alias("hub"), F.col("h.n").alias("hn"), F.col("h.root").alias("hroot"))
    return staged(named.join(staged(head, f"{name}-heads"), "bk"), f"{name}-mixed")


def _rare_pairs(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts (cls, root) that could be linked by what rare elements they share."""
    element = staged(sets.join(rest, "cls").select(
        "cls", "root", F.size("items").alias("n"), F.explode("items").alias("e")), "dup-elements")
    known = staged(element.groupBy("e").agg(F.count("*").alias("k"), F.min("root").alias("lo"),
                                            F.max("root").alias("hi")).where("k > 1"), "dup-known")
    shared = element.join(known, "e")
    order = Window.partitionBy("cls").orderBy("k", "e")
    # Elements of one text alone come first and need no row.
    place = F.col("n") - F.count("*").over(Window.partitionBy("cls")) + F.row_number().over(order)
    prefix = staged(shared.withColumn("place", place).where("place <= n div 4 + 1 and lo <> hi")
                    .select("e", "cls", "root", "n", "place"), "dup-prefix")
    other = prefix.toDF("e", "b", "broot", "bn", "bplace")
    return prefix.join(other, "e").where("cls < b and root <> broot").where(_fits("n", "bn")) \
        .where("7L * (1 + least(n - place, bn - bplace)) >= 3L * (n + bn)") \
        .select(F.col("cls").alias("a"), "b").distinct()


def components_of(docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """(node, root) of the classes that are linked with a smaller one, by all links."""
    classes = staged(sketch.where("cls is not null").groupBy("cls")
                     .agg(F.min("mark").alias("mark"), F.min("n_shingles").alias("n")), "dup-classes")
    band = sketch.join(classes.drop("n"), ["cls", "mark"], "left_semi") \
        .select("cls", F.explode("bands").alias("bk")).distinct()
    shared = staged(band.groupBy("bk").agg(F.count("*").alias("k")).where("k > 1"), "dup-buckets")
    member = staged(band.join(shared, "bk"), "dup-members")
    score = staged(member.groupBy("cls").agg(F.sum("k").alias("score")).join(classes, "cls"), "dup-scores")
    members = member.select("bk", "cls").join(score.drop("mark"), "cls")
    sets = staged(_sets(docs, score.select("cls", "mark")), "dup-sets")
    pair = (F.least("hub", "cls").alias("a"), F.greatest("hub", "cls").alias("b"))
    roots, seen, step, found, asked = None, None, 0, 1, 1
    while True:
        mixed = _mixed(members, roots, step, f"dup-{step}")
        if found * WORTH < max(asked, 1) or mixed.isEmpty():
            break
        pairs = mixed.where("root <> hroot").where(_fits("n", "hn")).select(*pair).distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = staged(pairs, f"dup-{step}-pairs")
        links = staged(_linked(pairs, sets), f"dup-{step}-links")
        asked, found = pairs.count(), links.count()
        seen = pairs if seen is None else seen.union(pairs)
        roots = components(links if roots is None else links.union(roots.select("node", "root")))
        members = mixed.where("cls <> hub").select("bk", "cls", "n", "score")
        step += 1
    if not mixed.isEmpty():
        rest = staged(mixed.select("cls", "root").distinct(), "dup-rest")
        pairs = _rare_pairs(rest, sets)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        links = staged(_linked(staged(pairs, "dup-rare-pairs"), sets), "dup-rare-links")
        roots = components(links if roots is None else links.union(roots.select("node", "root")))
    return components(staged(score.limit(0).selectExpr("cls as a", "cls as b"), "dup-none")) \
        if roots is None else roots


def groups(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, key, n_shingles, component_id, kept, group.

    ``kept`` says that doc_id = component_id, ``key`` is the 64-bit name of the text and
    ``group`` names the component even where it has no doc_id (null for an empty set).
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    sketch = staged(docs.mapInArrow(
        _sketch, "doc_id bigint, key bigint, n_shingles bigint, cls binary, mark bigint, "
                 "bands array<bigint>"), "dup-sketch")
    root = components_of(docs, sketch)
    ids = sketch.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id")) \
        .join(root.withColumnRenamed("node", "cls"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    least = staged(ids.groupBy("root").agg(F.min("doc_id").alias("component_id")), "dup-least")
    by_class = staged(ids.join(least, "root").select("cls", "root", "component_id"), "dup-by-class")
    component = F.coalesce("component_id", "doc_id")
    return sketch.select("doc_id", "key", "n_shingles", "cls").join(by_class, "cls", "left").select(
        "doc_id", "key", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"), F.col("root").alias("group"))


def firsts(docs: DataFrame) -> DataFrame:
    """The rows of documents that stay: of every group the one with the smallest doc_id.

    In a group without any doc_id it is the text with the smallest key. Rows that repeat
    doc_id and text altogether are one document. Texts without words all stay.
    """
    rows = staged(groups(docs).select("doc_id", "key", "group"), "dup-rows")
    head = rows.where("group is not null").groupBy("group") \
        .agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")).alias("h")) \
        .select("h.doc_id", "h.key")
    stay = staged(rows.where("group is null").select("doc_id", "key").union(head).distinct(),
                  "dup-stay").select(F.xxhash64("doc_id", "key").alias("__mark"),
                                     F.col("key").alias("__key"))
    named = docs.withColumn("__key", F.xxhash64("text")) \
        .withColumn("__mark", F.xxhash64("doc_id", "__key"))
    return named.join(stay, ["__mark", "__key"], "left_semi") \
        .dropDuplicates(["__mark", "__key"]).drop("__mark", "__key")
