"""Connected components of a table of links.

Each partition first joins its own links by union-find and keeps a spanning forest; then
alternating star steps (every node hangs its larger, then its smaller neighbours on the
smallest one it knows) run as joins until nothing changes. A node's smallest neighbour is an
aggregate that combines before the shuffle and is written before it is joined, so a node with
very many links is split by adaptive execution like any skewed join side.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adweave.session import staged


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a partition as links of every node to the root of its tree."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if x != y:
                lo, hi = (x, y) if x < y else (y, x)
                parent[hi] = lo
                parent.setdefault(lo, lo)
    nodes = [n for n in parent if root(n) != n]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at:at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, batch.schema.field(0).type),
             pa.array([root(n) for n in part], batch.schema.field(0).type)], ["a", "b"])


def _star(links: DataFrame, larger: bool, step: str) -> DataFrame:
    """One star step on links (a, b) with a > b."""
    if larger:
        out = links.union(links.selectExpr("b", "a")).toDF("u", "v")
    else:
        out = links.toDF("u", "v")
    low = staged(out.groupBy("u").agg(F.min("v").alias("m"))
                 .select("u", F.least("u", "m").alias("m")), f"{step}-low")
    near = out.join(low, "u")
    if larger:
        made = near.where("v > u and v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        made = near.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")) \
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return staged(made.where("a <> b").distinct(), step)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b) that is not its component's smallest.

    The root is the smallest node of a component. Links in either direction, repeated links
    and links of a node to itself are fine; null ends are ignored.
    """
    kind = dict(links.dtypes)["a"]
    now = staged(links.where("a is not null and b is not null and a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .mapInArrow(_forest, f"a {kind}, b {kind}").distinct(), "links")
    state = None
    while True:
        count, mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))) \
            .first()
        if state == (count, mark) or count == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (count, mark)
        now = _star(_star(now, True, "large-star"), False, "small-star")
