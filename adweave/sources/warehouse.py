"""Warehouse tables: versioned Parquet slices behind a manifest, pruned reads."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from adweave import schemas as S
from adweave.functions.scalars import month_text
from adweave.operators.merge import POLICIES, UpsertPolicy, apply_policy
from adweave.operators.rollup import date_bounds, in_range
from adweave.session import FEW_ROWS, NO_SIZES, packed

COMMIT = ("tables array<struct<table: string, seq: bigint, buckets: int, rows: bigint, "
          "slices: array<struct<slice: string, path: string>>>>")
# Dimensions are cut by a hash of their key, so a load rewrites only what it changes. They
# start with a few buckets and are cut again, twice as fine, when one holds more than this.
BUCKETS, BUCKET_ROWS = 16, 1_000_000


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """No rows, the table's columns."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                   for f in S.table_schema(table).fields])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Version:
    """What a table consists of: slice -> folder. Of a dimension also how it is cut."""

    seq: int = 0
    buckets: int = BUCKETS
    rows: int = 0
    slices: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Warehouse:
    """Tables under one folder.

    A table is a set of slices: one month of a granularity for facts, one bucket of ids
    for dimensions. A publish writes the new slices once, into a folder of its own, and
    then switches by adding one small commit file that lists every slice's folder.
    Until that file exists readers see all old rows; a failed publish leaves a folder
    nobody reads, and its re-run starts from the same rows. Publishes inside a ``unit``
    share one commit file, so their tables switch together or not at all. Old folders and
    commits are left to the storage's lifecycle rules. One writer at a time per table.
    """

    spark: SparkSession
    root: str
    held: dict[str, Version] | None = None  # inside a unit: the tables as it sees them

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def create(self, *tables: str) -> "Warehouse":
        """Make the tables that do not exist yet, empty."""
        known = self._versions()
        new = {t: Version() for t in tables or S.TABLES if t not in known}
        if new:
            self._commit(new)
        return self

    @contextmanager
    def unit(self) -> Iterator["Warehouse"]:
        """A warehouse whose publishes are seen by it alone until the block has ended."""
        if self.held is not None:
            yield self
            return
        before = self._versions()
        inner = replace(self, held=dict(before))
        yield inner
        new = {t: v for t, v in inner.held.items() if v is not before.get(t)}
        if new:
            self._commit(new)

    def _versions(self) -> dict[str, Version]:
        """The current version of every table (a few hundred names of slices at most)."""
        if self.held is not None:
            return self.held
        try:
            log = self.spark.read.schema(COMMIT).json(f"{self.root.rstrip('/')}/commits")
        except AnalysisException:
            return {}
        last = log.select(F.inline("tables")).groupBy("table").agg(
            F.max_by(F.struct("seq", "buckets", "rows", "slices"), "seq").alias("v"))
        return {r.table: Version(r.v.seq, r.v.buckets, r.v.rows, {x.slice: x.path for x in r.v.slices})
                for r in last.collect()}

    def _version(self, table: str) -> Version:
        known = self._versions()
        if table not in known:
            raise ValueError(f"no table {table}")
        return known[table]

    def _commit(self, new: dict[str, Version]) -> None:
        """One row in one file: it is there as a whole or not at all."""
        row = [(t, v.seq, v.buckets, v.rows, sorted(v.slices.items())) for t, v in new.items()]
        self.spark.createDataFrame([(row,)], COMMIT).coalesce(1) \
            .write.mode("append").json(f"{self.root.rstrip('/')}/commits")

    def _switch(self, table: str, new: Version) -> None:
        if self.held is not None:
            self.held[table] = new
        else:
            self._commit({table: new})

    def table(self, table: str) -> DataFrame:
        return self._read(table, self._version(table).slices)

    def _read(self, table: str, slices: dict[str, str], *more: str) -> DataFrame:
        data = f"{self.path(table)}/data"
        if not slices:
            none = empty_table(self.spark, table)
            return none.withColumns({c: F.lit(0) for c in more})
        schema = S.table_schema(table)
        for c in more:
            schema = schema.add(c, IntegerType())
        return self.spark.read.schema(schema).option("basePath", data) \
            .parquet(*[f"{data}/{p}" for p in slices.values()]) \
            .select(*S.columns_of(table), *more)

    def facts(self, table: str, granularity: str) -> DataFrame:
        """One granularity; the filter is on the partition column."""
        return self.table(table).where(F.col("granularity") == granularity)

    def publish(self, table: str, rows: DataFrame, buckets: int | None = None) -> None:
        """Replace the slices present in ``rows`` by them, in one write.

        ``rows`` may read the table itself. Rebalancing gives even files, whatever one
        month or id holds. A dimension given another number of ``buckets`` is replaced whole.
        """
        old = self._version(table)
        parts = S.PARTITIONS.get(table)
        cut = old.buckets if buckets is None else buckets
        if parts is None:
            parts = ["bucket"]
            rows = rows.withColumn("bucket", bucket_of(S.columns_of(table)[0], cut))
        out = rows.hint("rebalance", *parts)
        if table in S.FILE_ORDER:
            out = out.sortWithinPartitions(*parts, *S.FILE_ORDER[table])
        name = f"version={old.seq + 1:06d}-{uuid.uuid4().hex[:8]}"
        data = f"{self.path(table)}/data/{name}"
        out.write.options(**NO_SIZES).partitionBy(*parts).parquet(data)
        new = self._written(table, name, len(parts))
        if new:
            kept = old.slices if cut == old.buckets else {}
            size = 0
            if parts == ["bucket"]:  # buckets are even, so those written tell the size of the whole
                size = self.spark.read.schema(S.table_schema(table)).parquet(data).count() * cut // len(new)
            self._switch(table, Version(old.seq + 1, cut, size, kept | new))

    def _written(self, table: str, version: str, depth: int) -> dict[str, str]:
        """slice -> folder of a version, from the names of its files."""
        data = f"{self.path(table)}/data/{version}"
        try:
            files = self.spark.read.schema(S.table_schema(table)).parquet(data).inputFiles()
        except AnalysisException:
            return {}
        slices = {}
        for f in files:
            name = "/".join(f.split(f"/data/{version}/", 1)[1].split("/")[:depth])
            slices[unquote(name)] = f"{version}/{unquote(name)}"
        return slices

    def upsert(self, policy: str, incoming: DataFrame, months: list[str] | None = None) -> None:
        """Merge cleaned rows into their table, rewriting only the slices they touch.

        DAY and MONTH loads read and rewrite the months that occur in ``incoming``;
        ``months`` names them when the caller knows. Dimensions rewrite the buckets in
        which a row is new or differs in a column the policy assigns.
        """
        with self.unit() as unit:
            p = POLICIES[policy]
            if p.granularity is None:
                unit._upsert_dimension(p, incoming)
                return
            existing = unit.facts(p.table, p.granularity)
            if p.granularity in (S.DAY, S.MONTH):
                months = months_of(incoming) if months is None else months
                existing = existing.where(F.col("stats_month").isin(months))
            unit.publish(p.table, apply_policy(p, existing, incoming))

    def _upsert_dimension(self, p: UpsertPolicy, incoming: DataFrame) -> None:
        old, key = self._version(p.table), S.columns_of(p.table)[0]
        buckets = old.buckets
        while old.rows > buckets * BUCKET_ROWS:
            buckets *= 2
        existing = self._read(p.table, old.slices, "bucket")
        if old.rows > FEW_ROWS:  # however small its files are
            existing = existing.hint("merge")
        if not old.slices or buckets != old.buckets:  # nothing to spare
            self.publish(p.table, apply_policy(p, existing.drop("bucket"), incoming), buckets)
            return
        incoming, cut = packed(incoming, "incoming"), bucket_of(key, buckets)
        touched = [r.bucket for r in changed_rows(p, existing, incoming)
                   .select(cut.alias("bucket")).distinct().collect()]
        if touched:
            self.publish(p.table, apply_policy(
                p, existing.where(F.col("bucket").isin(touched)).drop("bucket"),
                incoming.where(cut.isin(touched))))


def changed_rows(p: UpsertPolicy, existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys of incoming rows that are new or would change what is stored."""
    old = existing.select(*p.keys, F.struct(*[F.col(c) for c in p.update] or [F.lit(1)])
                          .alias("_old"))
    new = incoming.select(*p.keys, F.struct(*[F.col(s).alias(c) for c, s in p.update.items()]
                                            or [F.lit(1)]).alias("_new"))
    return new.join(old, list(p.keys), "left") \
        .where(F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.col("_new"))) \
        .select(*p.keys)


def months_of(rows: DataFrame) -> list[str]:
    """The months that occur in rows with a ``stats_date``: at most twelve for a year."""
    month = month_text(F.col("stats_date"))
    return [r.m for r in rows.where(F.col("stats_date").isNotNull())
            .select(month.alias("m")).distinct().collect()]


def included_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts to extract; the filter and the five columns reach the scan."""
    return accounts.where(F.col("ad_account_include_ind") == "YES").select(
        "ad_account_id", "ad_account_name", "ad_account_client", "ad_account_brand",
        "ad_account_timezone")


def existing_between(facts: DataFrame, incoming: DataFrame, granularity: str = S.DAY) -> DataFrame:
    """Existing facts between the first and last incoming day, as one lazy plan."""
    bounds = date_bounds(incoming)
    first = bounds.select("first_day").scalar()
    last = bounds.select("last_day").scalar()
    return in_range(facts, granularity, first, last)


def account_seed(spark: SparkSession, seed: str | dict[str, list[str] | str]) -> DataFrame:
    """Static account seed: a JSON-lines file, or id -> [name, client, brand] / id -> name."""
    schema = ("ad_account_id string, ad_account_name string, ad_account_client string, "
              "ad_account_brand string")
    if isinstance(seed, str):
        return spark.read.schema(schema).json(seed)
    rows = [(k, v, None, None) if isinstance(v, str) else (k, *v) for k, v in seed.items()]
    return spark.createDataFrame(rows, schema)


def account_rows(seed: DataFrame, run_date: Column) -> DataFrame:
    """Seed rows in table shape: included, stamped with the run."""
    fields = S.table_schema("ad_account").fields
    full = seed.withColumns({"ad_account_include_ind": F.lit("YES"), "created_on": run_date,
                             "updated_on": run_date})
    return full.select(*[
        (F.col(f.name) if f.name in full.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields])
