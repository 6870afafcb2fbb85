"""Whole-batch numpy work on Arrow text: words, lines and window names.

An Arrow string column already is one byte buffer with offsets. The functions here cut a
record batch into pieces of bounded bytes and compute on all their rows at once, so the
memory of a task follows ``PIECE_BYTES`` or its longest single text, never its row count.
Byte tables suffice for the word classes used here: every class treats all bytes from 0x80
up alike, so words never split a UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 500_000
U64 = np.uint64
_MIXER = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
# Hashes are pairs of polynomials over the field of a Mersenne prime, whose products fit 64
# bits. Modulo a power of two, whole families of texts would collide for every base.
PRIME = U64((1 << 31) - 1)
_BASE = np.random.default_rng(20240229).integers(1 << 16, int(PRIME), (2, 2)).tolist()
_SUMMED = 1 << 22  # products of 40 bits that are summed before a remainder is taken
_POWERS: dict[tuple[int, int, bool], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _reduced(x: np.ndarray) -> np.ndarray:
    """The remainder modulo PRIME."""
    for _ in range(2):
        high = x >> U64(31)
        x = x & PRIME
        x += high
    return np.minimum(x, x - PRIME)  # below PRIME the difference wraps around


def _powers(n: int, which: int, field: int, inverse: bool = False) -> np.ndarray:
    have = _POWERS.get((which, field, inverse))
    if have is None or len(have) < n:
        base = _BASE[which][field]
        have = np.array([pow(base, -1, int(PRIME)) if inverse else base], U64)
        while len(have) < max(n, PIECE_BYTES):
            have = np.concatenate([have, _reduced(have * have[-1])])
        have = have[:max(n, PIECE_BYTES)].astype(np.uint32)
        if n <= 4 * PIECE_BYTES:
            _POWERS[which, field, inverse] = have
    return have[:n]


@dataclass
class Piece:
    """Some rows of a batch: their bytes and where each row starts and ends."""

    rows: pa.RecordBatch
    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start)

    def row_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, pos, side="right")

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per row, how many of its bytes are flagged."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.end] - total[self.start]

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut batches into pieces of about ``limit`` text bytes; null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(text)
        col = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = col.buffers()[2]
        buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(col):
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), len(col))
            lo, hi = int(offsets[first]), int(offsets[last])
            yield Piece(batch.slice(first, last - first), buf[lo:hi],
                        offsets[first:last] - lo, offsets[first + 1:last + 1] - lo)
            first = last


class Hashes:
    """Names of any byte span of a buffer, from prefix sums; ``which`` picks independent ones."""

    def __init__(self, buf: np.ndarray, which: int = 0, fold: bool = False):
        if fold:
            lower = np.arange(256, dtype=np.uint8)
            lower[65:91] = lower[97:123]
            buf = lower[buf]
        self._sum([(buf, 1), (buf, 1)], which)

    @classmethod
    def of(cls, names: np.ndarray, which: int = 0) -> "Hashes":
        """The same for spans of a sequence of 64-bit names."""
        made = cls.__new__(cls)
        made._sum([(names >> U64(32 * half) & U64(0xFFFFFFFF), 0) for half in (0, 1)], which)
        return made

    def _sum(self, values: list[tuple[np.ndarray, int]], which: int) -> None:
        n = len(values[0][0])
        self.inverse = [_powers(n + 1, which, field, inverse=True) for field in (0, 1)]
        self.total = []
        for field, (value, more) in enumerate(values):
            power, total = _powers(n, which, field), np.zeros(n + 1, U64)
            for at in range(0, n, _SUMMED):
                part = value[at:at + _SUMMED].astype(U64)
                part += U64(more)
                if not more:
                    part = _reduced(_reduced(part) * power[at:at + _SUMMED])
                else:
                    part *= power[at:at + _SUMMED]
                out = total[at + 1:at + 1 + len(part)]
                np.cumsum(part, out=out)
                if n > _SUMMED:
                    out[:] = _reduced(out + total[at])
            self.total.append(total)

    def _name(self, after: list, before: list, inverse: list) -> np.ndarray:
        half = []
        for a, b, i in zip(after, before, inverse):
            x = _reduced(a + PRIME - b)
            x *= i
            half.append(_reduced(x))
        half[0] <<= U64(32)
        half[0] |= half[1]
        return mix(half[0])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._name([t[end] for t in self.total], [t[start] for t in self.total],
                          [i[start] for i in self.inverse])

    def every(self, length: int) -> np.ndarray:
        """The name of the ``length`` bytes from each position on."""
        n = len(self.total[0]) - length
        return self._name([t[length:] for t in self.total], [t[:n] for t in self.total],
                          [i[:n] for i in self.inverse])


@dataclass
class Words:
    """All words of a piece in order: row, byte span; ``first[r]:first[r+1]`` are row r's."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def words(p: Piece, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes; a run never goes on into the next row."""
    inside = np.zeros(len(p.buf) + 2, bool)
    inside[1:-1] = is_word[p.buf]
    cut = np.zeros(len(p.buf) + 1, bool)
    cut[p.start] = True
    cut[p.end] = True
    edge = (inside[1:] != inside[:-1]) | cut
    start = np.flatnonzero(edge & inside[1:])
    end = np.flatnonzero(edge & inside[:-1])
    row = p.row_of(start)
    first = np.searchsorted(row, np.arange(p.n + 1), side="left")
    return Words(row, start, end, first)


def shingles(hashes: np.ndarray, row: np.ndarray, size: int,
             which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Names of every run of ``size`` words inside a row, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[:n] == row[size - 1:])
    name = np.zeros(len(at), U64)
    for k in range(size):
        name = name * _MIXER[1 - which] + hashes[at + k]
    return mix(name), at


def byte_class(excluded: str) -> np.ndarray:
    """A table of word bytes: all but the listed ASCII characters."""
    table = np.ones(256, bool)
    table[list(excluded.encode("ascii"))] = False
    return table


# Word classes of the operators: everything but ASCII white space; or letters, digits and
# everything outside ASCII (upper case letters count as the lower case ones they become).
NOT_SPACE = byte_class(" \t\n\v\f\r")
ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
CONTINUES = np.array([0x80 <= b < 0xC0 for b in range(256)])
