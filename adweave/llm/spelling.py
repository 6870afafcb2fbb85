"""Spelling variants: words one edit apart, each hung on its most frequent neighbour.

Two words one edit apart agree in the first or in the last half of the shorter one. So a word
goes to the lists of its first half and of its last half (read backward), once as the shorter
and once as the longer partner of a pair, and every pair meets in a list. A list of more than
``MOST`` words is taken apart in the same way, by halves of what its words need not share yet,
until it is short enough or only one place is open, where the alphabet bounds it. A pair that
meets in several lists is reported by the first of them alone.

A list is sorted, and the edit matrix of every query against it is filled along the list: a
prefix that adjacent words share has one row, where the common prefix with the word before
ends new rows begin, and a range of words whose prefix is two edits away is skipped as a
whole. A row is a band of three cells, since only lengths one apart matter. All queries of a
list advance together, character by character, in numpy.

Null texts have no words; words count over all rows, repeated rows too; a null doc_id counts
as the empty text. Of neighbours with equally many occurrences the smallest in code point
order is the form. An empty table gives an empty result; columns besides doc_id and text are
ignored. Very long words are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adweave.session import staged

LETTERS, LEAST_N = 5, 3  # code points and occurrences of a word
ONE_IN = 97  # one run in so many loses a letter
MOST = 1024  # words of a list that is not taken apart
CHUNK, CELLS = 8192, 1 << 20  # words, and characters with padding, compared at once
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FAR = 2


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): runs of letters of all texts, some with a letter lost, and how often they come."""
    lowered = F.translate("text", CAPITALS, SMALL)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(lowered, F.lit(r"[a-zÀ-ÿ]+"), F.lit(0))).alias("run")) \
        .where(F.length("run") >= LETTERS)
    h = "crc32(cast(concat(id, ':', run) as binary))"
    lost = "concat(left(run, cast(h % length(run) as int)), substr(run, cast(h % length(run) as int) + 2))"
    return runs.withColumn("h", F.expr(h)) \
        .select(F.expr(f"if(h % {ONE_IN} = 0, {lost}, run)").alias("word")) \
        .groupBy("word").agg(F.count("*").alias("n")) \
        .where((F.length("word") >= LETTERS) & (F.col("n") >= LEAST_N))


def _split(lists: DataFrame) -> DataFrame:
    """Each word of lists in the two lists that share half of what is open more.

    ``short`` is the length of the shorter partner, ``a`` and ``r`` what the words of a list
    share at the start and the end, ``path`` how the list came about.
    """
    h = "(short - a - r) div 2"
    sides = F.array(
        F.struct(F.concat("path", F.lit("P")).alias("path"), F.expr(f"int(a + {h})").alias("a"), F.col("r").alias("r")),
        F.struct(F.concat("path", F.lit("S")).alias("path"), F.col("a").alias("a"), F.expr(f"int(r + {h})").alias("r")))
    return lists.select("word", "n", "short", F.inline(sides)) \
        .withColumn("key", F.expr("xxhash64(short, path, left(word, a), right(word, r))"))


def _lists(words: DataFrame) -> DataFrame:
    """(key, short, path, word, n) of every list to search."""
    size = F.length("word")
    pairs = F.explode(F.array(size, size - 1)).alias("short")
    lists = _split(words.select("word", "n", pairs).where("short > 0").withColumns(
        {"path": F.lit(""), "a": F.lit(0), "r": F.lit(0)}))
    out = None
    while True:
        large = staged(lists.where("short - a - r > 1").groupBy("key").count()
                       .where(F.col("count") > MOST).select("key"), "spelling-large")
        some = large.isEmpty()
        ready = lists if some else lists.join(large, "key", "left_anti")
        ready = ready.select("key", "short", "path", "word", "n")
        out = ready if out is None else out.union(ready)
        if some:
            return out
        lists = _split(staged(lists.join(large, "key", "left_semi"), "spelling-split"))


def one_edit(chars: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of words of one group that are exactly one edit apart.

    ``chars`` holds a word per row, padded with zeros; the words of a group are adjacent and
    sorted. Ranges of the list stand for the prefix their words share.
    """
    n, width = chars.shape
    lcp = np.full(n, -1, np.int64)  # with the word before; -1 where a group begins
    differs = np.column_stack([chars[1:] != chars[:-1], np.ones(n - 1, bool)])
    lcp[1:] = np.where(group[1:] == group[:-1], np.argmax(differs, axis=1), -1)
    ask = np.zeros((n, width + 3), chars.dtype)
    ask[:, 1:-2] = chars
    cut = np.flatnonzero(lcp < 0)
    q = np.arange(n)
    lo = cut[np.searchsorted(cut, q, side="right") - 1]
    hi = np.append(cut, n)[np.searchsorted(cut, q, side="right")]
    cells = [np.full(n, FAR, np.int8), np.zeros(n, np.int8), np.ones(n, np.int8)]
    left, right = [], []
    for d in range(width + 1):
        # A word that ends at this depth is the first of its range: read off its distance.
        ended = length[lo] == d
        at = np.flatnonzero(ended)
        gap = length[q[at]] - d
        dist = np.select([gap == -1, gap == 0, gap == 1], [c[at] for c in cells], FAR)
        at = at[(dist == 1) & (lo[at] > q[at])]
        left.append(q[at])
        right.append(lo[at])
        if d == width:
            break
        # Ranges one character longer: all of them while the prefix is free of edits, else
        # only those that go on with a character of the query near this place.
        longer = np.flatnonzero(lcp <= d)
        name = ((np.searchsorted(cut, longer, side="right") - 1) << 32) + chars[longer, d]
        free = np.flatnonzero(np.minimum(np.minimum(cells[0], cells[1]), cells[2]) == 0)
        first = np.maximum(np.searchsorted(longer, lo[free]) + ended[free],
                           np.searchsorted(longer, q[free] + 1, side="right") - 1)
        many = np.maximum(np.searchsorted(longer, hi[free]) - first, 0)
        begin = np.cumsum(many) - many
        entry = [np.repeat(free, many)]
        child = [np.arange(many.sum()) + np.repeat(first - begin, many)]
        used = np.setdiff1d(np.arange(len(q)), free, assume_unique=True)
        place = (np.searchsorted(cut, lo[used], side="right") - 1) << 32
        tried: list[np.ndarray] = []
        for k in range(3):
            want = ask[q[used], d + k]
            ok = (want != 0) & (cells[k][used] < FAR)
            for other in tried:
                ok &= want != other
            tried.append(np.where(ok, want, 0))
            where = np.searchsorted(name, place + want)
            ok &= name[np.minimum(where, len(name) - 1)] == place + want
            entry.append(used[ok])
            child.append(where[ok])
        entry, child = np.concatenate(entry), np.concatenate(child)
        stop = np.append(longer, n)[child + 1]
        ahead = stop > q[entry] + 1  # words up to the query were its partners already
        entry, child, stop = entry[ahead], child[ahead], stop[ahead]
        q2, lo2 = q[entry], longer[child]
        char = chars[lo2, d]
        old = [c[entry] for c in cells]
        size = length[q2]
        new: list[np.ndarray] = []
        for k in range(3):
            cell = old[k] + (ask[q2, d + k] != char)
            if k < 2:
                cell = np.minimum(cell, old[k + 1] + 1)
            if k:
                cell = np.minimum(cell, new[k - 1] + 1)
            new.append(np.where(size < d + k, FAR, np.minimum(cell, FAR)).astype(np.int8))
        alive = np.minimum(np.minimum(new[0], new[1]), new[2]) < FAR
        q, lo, hi, cells = q2[alive], lo2[alive], stop[alive], [c[alive] for c in new]
        cut = longer
        if not len(q):
            break
    return np.concatenate(left), np.concatenate(right)


def _first_meeting(x: str, y: str, short: int, path: str) -> bool:
    """Whether two words of a list meet in none that comes before it."""
    a = r = 0
    for side in path:
        h = (short - a - r) // 2
        starts = x[a:a + h] == y[a:a + h]
        if side == "P":
            if not starts:
                return False
            a += h
        else:
            if starts or x[len(x) - r - h:len(x) - r] != y[len(y) - r - h:len(y) - r]:
                return False
            r += h
    return min(len(x), len(y)) == short


def _compare(rows: pa.Table) -> pa.RecordBatch:
    """Both directions of all pairs of the lists in ``rows``, sorted by list and word."""
    word, path, short = rows["read"].to_pylist(), rows["path"].to_pylist(), rows["short"].to_numpy()
    length = pc.utf8_length(rows["read"]).to_numpy()
    flat = np.frombuffer("".join(word).encode("utf-32-le"), np.uint32)
    chars = np.zeros((len(word), int(length.max())), np.uint32)
    chars[np.arange(chars.shape[1]) < length[:, None]] = flat
    ways = pc.dictionary_encode(rows["path"].combine_chunks()).indices.to_numpy()
    name = np.column_stack([rows["key"].to_numpy(), short, ways])
    group = np.concatenate([[0], np.cumsum((name[1:] != name[:-1]).any(axis=1))])
    x, y = [], []
    for i, j in zip(*(v.tolist() for v in one_edit(chars, length, group))):
        back = path[i][-1] == "S"
        a, b = (word[i][::-1], word[j][::-1]) if back else (word[i], word[j])
        if _first_meeting(a, b, int(short[i]), path[i]):
            x += [a, b]
            y += [(b, j), (a, i)]
    n = rows["n"].to_numpy()[np.array([k for _, k in y], np.int64)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.string()), pa.array([w for w, _ in y], pa.string()), pa.array(n)],
        ["word", "near", "near_n"])


def _chunks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Compare whole lists, as many at once as the bounds allow; lists of one word drop out."""
    key = rows["key"].to_numpy()
    edge = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    many = np.diff(edge)
    rows = rows.filter(pa.array(np.repeat(many > 1, many)))
    if not rows.num_rows:
        return
    many = many[many > 1]
    begin = np.cumsum(many) - many
    widest = np.maximum.reduceat(pc.utf8_length(rows["read"]).to_numpy(), begin).tolist()
    first = words = wide = 0
    for at, k, w in zip(begin.tolist(), many.tolist(), widest):
        if words and (words + k > CHUNK or (words + k) * max(wide, w) > CELLS):
            yield _compare(rows.slice(first, words))
            first, words, wide = at, 0, 0
        words, wide = words + k, max(wide, w)
    yield _compare(rows.slice(first, words))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < CHUNK:
            continue
        rows = pa.Table.from_batches(held)
        key = rows["key"].to_numpy()
        cuts = np.flatnonzero(key[1:] != key[:-1])
        if len(cuts):
            yield from _chunks(rows.slice(0, int(cuts[-1]) + 1))
            held = rows.slice(int(cuts[-1]) + 1).to_batches()
    if sum(b.num_rows for b in held):
        yield from _chunks(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of words one edit apart, once."""
    read = F.when(F.col("path").endswith("S"), F.reverse("word")).otherwise(F.col("word"))
    lists = _lists(words).select("key", "short", "path", read.alias("read"), "n") \
        .repartition("key").sortWithinPartitions("key", "short", "path", "read")
    return lists.mapInArrow(_search, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): follow forms to the last, twice as far with each round.

    A form has at least twice its word's occurrences, so there is no cycle and the rounds are
    the logarithm of the longest chain, itself at most 63 long.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        now = staged(now.join(ahead, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.isnotnull("_r").alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n)."""
    words = staged(words.select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    none = {"near": F.lit(None).cast("string"), "near_n": F.lit(None).cast("bigint")}
    pairs = near_words(words).withColumn("n", F.lit(None).cast("bigint")) \
        .unionByName(words.withColumns(none))
    most = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    best = pairs.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), most.alias("m")) \
        .withColumn("m", F.when(-F.col("m.less") >= 2 * F.col("n"), F.col("m")))
    best = staged(best.select("word", "n", "n_near", F.col("m.near").alias("form"),
                              (-F.col("m.less")).alias("form_n")), "spelling-best")
    last = roots(best.where("form is not null"))
    return best.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
