"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is cut at added tokens, then by the vocabulary's word pattern. Each distinct word is
merged once per task (and its ids decoded): leaves of a segment tree hold the rank of each adjacent pair, inner
nodes the smaller of their children, so the root names the leftmost pair of lowest rank. A
merge updates at most three leaves, each in logarithmic time, until no pair has a rank. One
very long word (a text without spaces) therefore costs n log n steps.

Null and empty texts have no tokens and decode to the empty text. Rows are encoded alone, so
repeated rows, ties and an empty table need no care; further input columns are kept unless
an output column replaces them. The vocabulary is read from the given path; it must be the
same file on all machines.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

NONE = (1 << 31) - 1
SHORT = 33  # bytes; words up to this length are merged many at a time
ROWS = 300  # texts that are Python strings at a time
BATCH_CHARS = 1_000_000  # characters of texts (or one text) that are split at a time
CACHE_WORDS = 200_000  # distinct words that a task remembers (or those of one group of texts)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.first = [vocab[letters[b]] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # the merged id of each rank
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.piece = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.piece |= {i: t.encode() for t, i in self.added.items()}
        self.split = regex.compile(PATTERN).findall
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") \
            if self.added else None
        self.known: dict[str, Entry] = {}
        # Sorted pairs for lookups of whole arrays.
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order.astype(np.int32)
        self.made_array = np.array(self.made, np.int64)
        self.first_array = np.array(self.first, np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], NONE)

    def word(self, data: bytes) -> list[int]:
        """Token ids of one word by repeated merging of the tree's leftmost best pair."""
        first, get, made = self.first, self.rank.get, self.made
        ids = [first[b] for b in data]
        n = len(ids)
        size = 1 << max(n - 2, 0).bit_length()
        tree = [NONE] * size
        tree += [get(pair, NONE) for pair in zip(ids, ids[1:])]
        tree += [NONE] * (2 * size - len(tree))
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a <= b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != NONE:
            low = tree[1]
            node = 1
            while node < size:
                node *= 2
                if tree[node] != low:
                    node += 1
            i = node - size
            j = after[i]
            k = after[j]
            ids[i], ids[j] = made[low], -1
            after[i] = k
            # The pair at i changes, the one at j is gone, the one before i changes.
            leaves = [(i, NONE)]
            if k < n:
                before[k] = i
                leaves = [(i, get((ids[i], ids[k]), NONE)), (j, NONE)]
            h = before[i]
            if h >= 0:
                leaves.append((h, get((ids[h], ids[i]), NONE)))
            for leaf, rank in leaves:
                node = size + leaf
                if tree[node] == rank:
                    continue
                tree[node] = rank
                while node > 1:
                    a, b = tree[node], tree[node ^ 1]
                    if b < a:
                        a = b
                    node >>= 1
                    if tree[node] == a:
                        break
                    tree[node] = a
        return [t for t in ids if t >= 0]

    def short_words(self, words: list[bytes], size: int) -> list[list[int]]:
        """``word`` for many words of 2 to ``size`` + 1 bytes at once, each with its own tree."""
        n, depth = len(words), size.bit_length() - 1
        length = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(w.ljust(size + 1, b"\0") for w in words), np.uint8)
        place = np.arange(size + 1)
        inside = place < length[:, None]
        # One more column each takes what is written for a neighbour that is not there.
        ids = np.full((n, size + 2), -1, np.int64)
        ids[:, :-1] = np.where(inside, self.first_array[data.reshape(n, size + 1)], -1)
        after = np.tile(np.arange(1, size + 3), (n, 1))
        before = np.tile(np.arange(-1, size + 1), (n, 1))
        tree = np.full((n, 2 * size + 1), NONE, np.int32)
        tree[:, size:2 * size] = self.ranks(ids[:, :size], ids[:, 1:size + 1])
        for level in range(depth - 1, -1, -1):
            lo = 1 << level
            below = tree[:, 2 * lo:4 * lo]
            tree[:, lo:2 * lo] = np.minimum(below[:, ::2], below[:, 1::2])
        live = np.flatnonzero(tree[:, 1] != NONE)
        while len(live):
            low = tree[live, 1]
            node = np.ones(len(live), np.int64)
            for _ in range(depth):
                node *= 2
                node += tree[live, node] != low
            i = node - size
            j = after[live, i]
            k = np.minimum(after[live, j], size + 1)
            h = before[live, i]
            new = self.made_array[low]
            ids[live, i], ids[live, j] = new, -1
            after[live, i], before[live, k] = k, i
            right = ids[live, k]
            tree[live, size + i] = np.where(right >= 0, self.ranks(new, right), NONE)
            tree[live, size + j] = NONE
            prior = np.where(h >= 0, self.ranks(ids[live, h], new), NONE)
            tree[live, np.where(h >= 0, size + h, 2 * size)] = prior
            for leaf in (i, np.minimum(j, size - 1), np.maximum(h, 0)):
                node = (size + leaf) >> 1
                for _ in range(depth):
                    tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
                    node >>= 1
            live = live[tree[live, 1] != NONE]
        kept = ids >= 0
        flat = ids[kept].tolist()
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, words: Iterable[str]) -> None:
        """Make the words known, those of like length together."""
        by_size: dict[int, list[str]] = {}
        piece, known = self.piece, self.known
        for w in words:
            n = len(w.encode())
            if 1 < n <= SHORT:
                by_size.setdefault(1 << max(n - 2, 1).bit_length(), []).append(w)
            else:
                known[w] = entry(self.word(w.encode()), piece)
        for size, alike in by_size.items():
            for at in range(0, len(alike), 20_000):
                part = alike[at:at + 20_000]
                for w, ids in zip(part, self.short_words([w.encode() for w in part], size)):
                    known[w] = entry(ids, piece)

    def parts(self, text: str) -> list[list[str]]:
        """Words of a text, cut at added tokens: every other list is one added token."""
        cut = self.cut.split(text) if self.cut else [text]
        return [[x] if k % 2 else self.split(x) for k, x in enumerate(cut)]

    def entries(self, texts: list[str]) -> Iterator[list[Entry]]:
        """Entries of the words of each text."""
        found = [self.parts(t) for t in texts]
        words = {w for parts in found for part in parts[::2] for w in part}
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = words
        self.learn(new)
        get = self.known.__getitem__
        for parts in found:
            out: list[Entry] = []
            for k, part in enumerate(parts):
                out.extend([entry([self.added[part[0]]], self.piece)] if k % 2 else map(get, part))
            yield out

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in next(self.entries([text])) for i in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.piece.__getitem__, ids)).decode("utf-8", "replace")


# Of a word: number of its tokens, their ids as text, and the bytes they decode to.
Entry = tuple[int, str, bytes]


def entry(ids: list[int], piece: dict[int, bytes]) -> Entry:
    return len(ids), ",".join(map(str, ids)), b"".join([piece[i] for i in ids])


def groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_CHARS`` characters together."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        if i > at and total + len(t) > BATCH_CHARS:
            yield at, i
            at, total = i, 0
        total += len(t)
    if at < len(texts):
        yield at, len(texts)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tokens(docs: DataFrame, vocabulary: str, text: str = "text",
           keep: list[str] | None = None, ids: bool = False,
           decoded: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens and the digests of ids and decoded text.

    ``ids`` adds the ids (array of int), ``decoded`` the decoded text.
    """
    made = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    made |= ({"ids": "array<int>"} if ids else {}) | ({"decoded": "string"} if decoded else {})
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in made]
    slim = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in slim.drop("__text").dtypes]
                       + [f"{n} {t}" for n, t in made.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            values = [v or "" for v in batch.column(batch.num_columns - 1).to_pylist()]
            for lo, hi in groups(values):
                part = batch.slice(lo, hi - lo)
                rows = {m: [] for m in made}
                for found in codec.entries(values[lo:hi]):
                    n, names, data = zip(*found) if found else ((), (), ())
                    names, back = ",".join(names), b"".join(data).decode("utf-8", "replace")
                    rows["n_tokens"].append(sum(n))
                    rows["ids_sha256"].append(sha(names))
                    rows["decoded_sha256"].append(sha(back))
                    if ids:
                        rows["ids"].append(np.array(names.split(",") if names else [], np.int32))
                    if decoded:
                        rows["decoded"].append(back)
                kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.array(v, kinds.get(m, pa.string())) for m, v in rows.items()],
                    keep + list(made))

    return slim.mapInArrow(run, schema)
