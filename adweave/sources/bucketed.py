"""Dimensions in Spark buckets: a merge moves the incoming rows only.

``Warehouse`` spares unchanged slices of a dimension. Where most of a large dimension changes
with every load, the shuffle of its stored side is what costs. Here the stored rows lie in
buckets by their key, sorted, so a merge joins them where they are, and what it writes lies
in the same buckets again.

Buckets need a table in the session's catalog. It is only a name for files: every version
lies in a folder of its own, told by a small commit file, and any session can open it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.operators.merge import apply_policy
from adweave.sources.warehouse import empty_table

COMMIT = "seq bigint, name string, buckets int, rows bigint"
ROWS = 1_000_000  # of a bucket, at most, before a table is cut twice as fine


def buckets_for(rows: int, least: int = 1) -> int:
    """A power of two, so that a finer cut splits every bucket in two."""
    n = least
    while rows > n * ROWS:
        n *= 2
    return n


@dataclass(frozen=True)
class BucketedDimension:
    """One dimension under a folder; ``table`` names its layout. One writer at a time."""

    spark: SparkSession
    root: str
    table: str

    @property
    def key(self) -> str:
        return S.columns_of(self.table)[0]

    def _folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.table}/{name}"

    def _last(self) -> tuple[int, str | None, int, int]:
        try:
            log = self.spark.read.schema(COMMIT).json(self._folder("commits"))
        except AnalysisException:
            return 0, None, 1, 0
        return tuple(log.orderBy(F.desc("seq")).first())

    def read(self) -> DataFrame:
        _, name, buckets, _ = self._last()
        if name is None:
            return empty_table(self.spark, self.table)
        if not self.spark.catalog.tableExists(name):
            fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.table_schema(self.table).fields)
            self.spark.sql(f"create table {name} ({fields}) using parquet clustered by ({self.key}) "
                           f"sorted by ({self.key}) into {buckets} buckets location '{self._folder(name)}'")
        return self.spark.table(name)

    def publish(self, rows: DataFrame, buckets: int) -> None:
        """Replace the table. Readers see the old version until the commit file is there."""
        seq = self._last()[0] + 1
        name = f"{self.table}_v{seq}_{uuid.uuid4().hex[:12]}"
        watch = Observation()
        rows.select(*S.columns_of(self.table)).observe(watch, F.count(F.lit(1)).alias("rows")) \
            .write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key) \
            .option("path", self._folder(name)).saveAsTable(name)
        self.spark.createDataFrame([(seq, name, buckets, watch.get["rows"])], COMMIT) \
            .coalesce(1).write.mode("append").json(self._folder("commits"))

    def upsert(self, policy: str, incoming: DataFrame) -> None:
        """Merge cleaned rows, one per key. The number of buckets follows the rows stored.

        When it grows, this one merge shuffles the stored side, too.
        """
        _, name, buckets, rows = self._last()
        wanted = buckets_for(rows, buckets)
        merged = self.merged(policy, incoming)
        if name is None or wanted != buckets:
            merged = merged.repartition(wanted, self.key)
        self.publish(merged, wanted)

    def merged(self, policy: str, incoming: DataFrame) -> DataFrame:
        """The rows a merge would write."""
        return apply_policy(policy, self.read(), incoming)
