"""The wide extract: CSV hand-off between extract and load, and its split into tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions import scalars as X
from adweave.operators.dedupe import latest_per_key
from adweave.session import staged

# Blanks mean missing; quotes are doubled inside a field.
CSV = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"'}
WRITE = {**CSV, "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
         "ignoreTrailingWhiteSpace": "false", "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# An extract repeats its entities on every row, so it is some seven times smaller compressed.
# A compressed file is one split: this bounds what one task reads.
FILE_ROWS = 500_000
# Column names are checked against each file's header, so a missing or misplaced
# column is an error, not a silent shift. Whole rows are parsed even when few columns are
# selected, so a torn row is an error too.
READ = {**CSV, "enforceSchema": "false", "mode": "FAILFAST", "columnPruning": "false"}


def escaped(c: Column) -> Column:
    """Line breaks as ``\\n`` and ``\\r``, backslashes doubled: one row stays one line."""
    out = F.regexp_replace(c, r"\\", r"\\\\")
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _special(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(x)) for x in "\\\n\r"])


def _one_line(texts: Column) -> Column:
    """``escaped`` for an array of texts; those without a special character stay as they are.

    Most rows have no such text, so all texts of a row are looked through together first.
    """
    each = F.transform(texts, lambda c: F.when(_special(c), escaped(c)).otherwise(c))
    return F.when(_special(F.array_join(texts, "")), each).otherwise(texts)


def unescaped(c: Column) -> Column:
    """What ``escaped`` was given."""
    piece = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")),
                                F.lit("\\r"), F.lit("\r"))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(
        F.transform(F.split(c, r"\\\\"), piece), "\\")).otherwise(c)


def plain_text(raw: DataFrame, foreign: bool = False) -> DataFrame:
    """Text columns as they were written; files of other writers are taken literally."""
    return raw if foreign else raw.withColumns(
        {f.name: unescaped(F.col(f.name)) for f in raw.schema.fields
         if f.dataType.typeName() == "string" and f.name in S.TEXT_COLUMNS})


def read_extract(spark: SparkSession, path: str, columns: list[str] | None = None,
                 glob: str | None = None, foreign: bool = False) -> DataFrame:
    """Every extract file under ``path`` (optionally matching ``glob``), all text.

    ``write_extract`` escapes line breaks, so its files are split freely once unpacked.
    ``foreign`` reads files of other writers: backslashes are text and quoted fields may hold
    line breaks; a file is then one split.
    """
    r = spark.read.schema(S.text_schema(columns or S.WIDE_DAY_COLUMNS)) \
        .options(**READ, multiLine=foreign)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return plain_text(r.csv(path), foreign)


TORN = "_torn"


def split_extract(spark: SparkSession, path: str, rejects: str, columns: list[str] | None = None,
                  glob: str | None = None, foreign: bool = False) -> DataFrame:
    """Like ``read_extract``, but a torn row goes to ``rejects`` instead of ending the load.

    The files are parsed once and kept as Parquet; ``rejects`` is a new folder of
    (extract_file, line). Rows and rejects together are all lines of the files, less headers
    and empty lines. A wrong header is an error all the same.
    """
    columns = columns or S.WIDE_DAY_COLUMNS
    r = spark.read.schema(S.text_schema([*columns, TORN])) \
        .options(**READ | {"mode": "PERMISSIVE"}, multiLine=foreign, columnNameOfCorruptRecord=TORN)
    if glob:
        r = r.option("pathGlobFilter", glob)
    kept = staged(r.csv(path).withColumn("extract_file", F.col("_metadata.file_path")), "extract-lines")
    kept.where(F.col(TORN).isNotNull()).select("extract_file", F.col(TORN).alias("line")) \
        .write.parquet(rejects)
    return plain_text(kept.where(F.col(TORN).isNull()).select(*columns), foreign)


def as_extract(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns in extract order; missing ones blank, dates as the extract has them."""
    return _as_text(wide, columns, [])


def _as_text(wide: DataFrame, columns: list[str], one_line: list[str]) -> DataFrame:
    """``as_extract`` with the columns ``one_line`` escaped.

    Dates and texts are rendered in one pass over an array: an expression a column
    would make generated code too long to be compiled, for rows of this width.
    """
    have = {f.name: f.dataType.typeName() for f in wide.schema.fields}
    dates = [c for c in columns if have.get(c) == "date" and c != "adstats_date"]
    texts = [c for c in one_line if c in have and c not in dates]
    arrays = {"_dates": F.transform(F.array(*dates), X.extract_day_text)} if dates else {}
    if texts:
        arrays["_texts"] = _one_line(F.array(*[F.col(c).cast("string") for c in texts]))

    def text(c: str) -> Column:
        if c not in have:
            return F.lit(None).cast("string").alias(c)
        if c in dates:
            return F.get("_dates", F.lit(dates.index(c))).alias(c)
        if c in texts:
            return F.get("_texts", F.lit(texts.index(c))).alias(c)
        return F.col(c).cast("string").alias(c)

    return wide.withColumns(arrays).select(*[text(c) for c in columns]) if arrays \
        else wide.select(*[text(c) for c in columns])


def write_extract(wide: DataFrame, path: str, columns: list[str] | None = None,
                  by_window: str | None = None) -> None:
    """Write the extract as compressed CSV, part files of at most ``FILE_ROWS`` rows.

    ``by_window`` names a column (the window start) to write one folder per window.
    """
    columns = [*(columns or S.WIDE_DAY_COLUMNS), *([by_window] if by_window else [])]
    if by_window:
        # One folder per window without one task per window: AQE splits large windows. Rows
        # are dealt and sorted as they come, before the extract's other columns are made.
        wide = wide.select(*[c for c in columns if c in wide.columns]) \
            .hint("rebalance", by_window).sortWithinPartitions(by_window)
    out = _as_text(wide, columns, [c for c in columns if c in S.TEXT_COLUMNS])
    w = out.write.mode("overwrite").options(**WRITE, maxRecordsPerFile=FILE_ROWS)
    if by_window:
        w = w.partitionBy(by_window)
    w.csv(path)


def _require(raw: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"extract lacks {missing}")


def typed_values(table: str, columns: list[str]) -> list[Column]:
    """Typed table columns out of text, by the table's own types."""
    types = {f.name: f.dataType.typeName() for f in S.table_schema(table).fields}

    def one(c: str) -> Column:
        col = F.col(c)
        if c in S.FLAG_COLUMNS:
            return X.flag_text(col).alias(c)
        kind = types[c]
        if kind == "date":
            return X.entity_day(col.cast("string")).alias(c)
        if kind == "long":
            return X.money_micro(col).alias(c)
        return col.cast("string").alias(c)

    return [one(c) for c in columns]


def _pad(df: DataFrame, table: str) -> DataFrame:
    """Table shape: columns the source does not know become typed NULLs."""
    fields = S.table_schema(table).fields
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields])


_ENTITY_ORDER = {"campaign": "campaign_updated_at", "ad_squad": "ad_squad_updated_at",
                 "ad": "ad_updated_at"}


def entity_rows(raw: DataFrame, entity: str, run_date: Column,
                columns: list[str] | None = None, version: list[str] | None = None,
                trial: bool = False) -> DataFrame:
    """Dimension rows out of the wide extract: projected, typed, one per id, stamped.

    The trial load neither guards the key (a missing id is then the blank id, as in the
    file) nor keeps audit dates.

    Of several rows with one id the latest version wins (``version`` columns, then
    the entity's updated_at, then all columns). An entity repeats on every row of its
    descendants, so exact copies are dropped first: that hash-aggregates before the
    shuffle, and only distinct rows are converted and compared.
    """
    own = [c for c in S.columns_of(entity) if c not in ("created_on", "updated_on")]
    columns, version = columns or own, version or []
    key = f"{entity}_id"
    _require(raw, columns)
    # The count keeps the optimizer from dropping this step: it would merge a plain
    # distinct into the maximum below, which sorts every row.
    rows = raw.withColumn(key, F.coalesce(key, F.lit(""))) if trial \
        else raw.where(X.nonblank(F.col(key)))
    # Copies of a single version column's older values fall together as well.
    newest = [F.max(v).alias(v) for v in version] if len(version) == 1 else []
    seen = rows.groupBy(*columns, *([] if newest else version)) \
        .agg(F.count(F.lit(1)).alias("copies"), *newest).where(F.col("copies") > 0)
    typed = seen.select(*typed_values(entity, columns), *version)
    best = latest_per_key(typed, [key], [*version, _ENTITY_ORDER[entity]])
    best = best.select(*columns)
    return _pad(best, entity) if trial else stamped(best, entity, run_date)


def stamped(rows: DataFrame, entity: str, run_date: Column) -> DataFrame:
    """Typed entities in table shape, dated with the run."""
    return _pad(rows.withColumns({"created_on": run_date, "updated_on": run_date}), entity)


def stats_values(raw: DataFrame, metrics: list[str]) -> list[Column]:
    return [(X.ratio_metric(F.col(m)) if m in S.RATIO_METRICS else X.count_metric(F.col(m)))
            .alias(m) for m in metrics]


def days_of(raw: DataFrame) -> DataFrame:
    """The days a DAY extract speaks of; one column to scan."""
    return raw.select(X.iso_day(F.col("adstats_date")).alias("stats_date"))


def day_rows(raw: DataFrame, version: list[str] | None = None) -> DataFrame:
    """DAY facts out of the wide extract: typed, one per (ad, day), table shape."""
    return _one_a_day(day_values(raw, version or []), version or [])


def _one_a_day(values: DataFrame, version: list[str]) -> DataFrame:
    best = latest_per_key(values, ["ad_id", "stats_date"], [*version, *S.STATS_METRICS])
    return day_facts(best.drop(*version))


def with_day_values(raw: DataFrame) -> DataFrame:
    """The wide extract as a DAY load stages it: entities as text, day and metrics typed.

    A number takes less to store, read and compare than its text, and is converted once.
    """
    day = F.col("adstats_date")
    return raw.withColumns({"stats_date": F.when(X.nonblank(day), X.iso_day(day)),
                            **dict(zip(S.STATS_METRICS, stats_values(raw, S.STATS_METRICS)))}) \
        .drop("adstats_date")


def typed_day_rows(rows: DataFrame, version: list[str] | None = None) -> DataFrame:
    """``day_rows`` of what ``with_day_values`` made."""
    kept = rows.where(X.nonblank(F.col("ad_id")) & F.col("stats_date").isNotNull())
    return _one_a_day(kept.select("ad_id", "stats_date", *S.STATS_METRICS, *(version or [])), version or [])


def day_values(raw: DataFrame, version: list[str]) -> DataFrame:
    """Typed ad_id, stats_date, metrics and ``version`` of every row with an ad and a day."""
    return raw.where(X.nonblank(F.col("ad_id")) & X.nonblank(F.col("adstats_date"))).select(
        "ad_id", X.iso_day(F.col("adstats_date")).alias("stats_date"),
        *stats_values(raw, S.STATS_METRICS), *version).where(F.col("stats_date").isNotNull())


def day_facts(best: DataFrame) -> DataFrame:
    """One typed row per (ad, day) in table shape."""
    day = F.col("stats_date")
    return _pad(best.withColumns({
        "ad_id_date_granul": X.stats_key(F.col("ad_id"), day, S.DAY),
        "granularity": F.lit(S.DAY), "stats_month": X.month_text(day)}), "ad_stats")


def lifetime_rows(raw: DataFrame, run_date: Column, metrics: list[str] | None = None,
                  guarded: bool = True) -> DataFrame:
    """LIFETIME facts: typed, one per ad, dated with the run.

    The trial load has 12 metrics and no key guard (``guarded=False``): a missing
    id is then the blank id, as in the file.
    """
    metrics = metrics or S.STATS_METRICS
    rows = raw.where(X.nonblank(F.col("ad_id"))) if guarded else raw
    ad_id = F.col("ad_id") if guarded else F.coalesce(F.col("ad_id"), F.lit(""))
    typed = rows.select(ad_id.alias("ad_id"), *stats_values(raw, metrics))
    best = latest_per_key(typed, ["ad_id"], metrics)
    return _pad(best.withColumns({
        "stats_date": run_date,
        "ad_id_date_granul": X.stats_key(F.col("ad_id"), run_date, S.LIFETIME),
        "granularity": F.lit(S.LIFETIME), "stats_month": F.lit(S.NO_MONTH)}), "ad_stats")


def geo_rows(raw: DataFrame, run_date: Column) -> DataFrame:
    """Geo facts: typed, one per (ad, dma), no guard and no gate."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    typed = raw.select(
        blank("ad_id").alias("ad_id"), blank("dma").alias("dma"), "country", "region",
        *[X.count_metric(F.col(c)).alias(c) for c in S.GEO_COUNTS],
        *[F.col(c).cast("string").try_cast("double").alias(c) for c in S.GEO_RATIOS])
    best = latest_per_key(typed, ["ad_id", "dma"], [*S.GEO_COUNTS, *S.GEO_RATIOS])
    return _pad(best.withColumns({
        "geo_date": run_date,
        "ad_id_dma_granul_date": X.geo_key(F.col("ad_id"), F.col("dma"), run_date),
        "granularity": F.lit(S.LIFETIME)}), "ad_geo")
