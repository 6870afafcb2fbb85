"""A bit table over 64-bit names, for filtering rows inside a scan.

Its size follows the number of names, so that few others pass, up to ``MOST_BITS``; it may
thus be collected and broadcast whatever the data. Beyond that more others pass. Whoever uses
it joins what passed with the names, so the result is the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27  # 16 MB
BITS_PER_NAME = 16


def bits_for(n: int) -> int:
    bits = LEAST_BITS
    while bits < min(n * BITS_PER_NAME, MOST_BITS):
        bits *= 2
    return bits


def bit_table(names: DataFrame) -> bytes:
    """Table over the bigint column ``h``; at most MOST_BITS / 64 rows reach the driver."""
    bits = bits_for(names.count())
    rows = names.select(F.expr(f"cast(pmod(h, {bits}L) div 64 as int)").alias("w"),
                        F.expr("shiftleft(1L, cast(pmod(h, 64L) as int))").alias("b")) \
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return table.tobytes()


class Wanted:
    """Membership of hashes (as uint64) in a bit table."""

    def __init__(self, table: bytes):
        self.table = np.frombuffer(table, np.uint64)
        self.mask = np.uint64(64 * len(self.table) - 1)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slot = h & self.mask
        return (self.table[(slot >> np.uint64(6)).astype(np.int64)]
                >> (slot & np.uint64(63))) & np.uint64(1) != 0
