"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


STATE = "spark.sql.streaming.stateStore"
# State of streams lies on disk, not in the executors' heap. A join of streams keeps one store a
# partition instead of four, and stores take disk for what they hold, not some megabytes in advance.
STATE_ON_DISK = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{STATE}.rocksdb.compression": "zstd",
    f"{STATE}.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


# Counts of sizes and levels, kept value by value: no reader of these files uses them.
NO_SIZES = {"parquet.size.statistics.enabled": "false"}


def build_session(app: str = "adweave", master: str | None = None,
                  **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **STATE_ON_DISK,
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


# A compressed extract has some twenty to fifty bytes a row: at the usual 128 MB a task would get
# millions of rows, more than it sorts in memory, and there would be too few tasks to balance.
SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "32m"}


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside keep state on disk, also in a session that was not built here.

    A stream that goes on keeps the store it began with, a session with a store of its own that one.
    """
    provider = f"{STATE}.providerClass"
    own = spark.conf.get(provider, None) not in (None, STATE_ON_DISK[provider])
    return _default(spark, {} if own else STATE_ON_DISK)


def small_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Files read inside, also by streams started inside, are dealt to more and smaller tasks."""
    return _default(spark, SMALL_SPLITS)


@contextmanager
def _default(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """What the session sets itself stays."""
    new = [k for k in conf if spark.conf.get(k, None) is None]
    for k in new:
        spark.conf.set(k, conf[k])
    try:
        yield
    finally:
        for k in new:
            spark.conf.unset(k)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors reach, for written intermediate tables.

    It is ``spark.checkpoint.dir`` of the session, or else the context's checkpoint folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet.

    Paths of one application share a folder, so finished runs are easy to expire.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/adweave/{app}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of an input that several outputs read; the files outlive any
    executor.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.options(**NO_SIZES, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, name: str) -> DataFrame:
    """``staged`` in less space, for the wide tables of reports, which are read a few times at most."""
    return staged(df, name, compression="zstd")


FEW_ROWS = 100_000  # what a join may send to every task


def counted(df: DataFrame) -> DataFrame:
    """A written table that joins do not broadcast if it has many rows.

    Spark takes a table for as large as its files, less the columns not read. Millions of rows that
    compress well would count as small, and be collected by the driver.
    """
    return df if df.count() <= FEW_ROWS else df.hint("merge")
