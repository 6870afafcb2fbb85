"""A corpus pipeline of five stages over the documents table.

Each stage works on all rows its predecessor kept; ``run`` writes a stage's result to the
shared folder and reads it again as the next one's input, so a lost executor costs at most
the stage at work. All stages but the last return the columns of documents.

Null and empty texts pass every stage (no sentence is toxic, nothing is copied, no benchmark
word is hit, nothing is personal, no token comes out). Further columns of the input are
dropped in the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adweave.llm import bpe, decontam, neardup, pii, toxicity
from adweave.llm.queries import fold, vocabulary
from adweave.llm.registry import table
from adweave.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), f"{fold(3)} <> 1")
    return toxicity.scores(docs.select(*COLUMNS), model, keep=COLUMNS) \
        .where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.firsts(docs.select(*COLUMNS)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    hit = decontam.hits(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0") \
        .select("doc_id", "key").distinct().alias("h")
    named = docs.select(*COLUMNS, F.xxhash64("text").alias("key")).alias("d")
    same = (F.col("d.key") == F.col("h.key")) & F.col("d.doc_id").eqNullSafe(F.col("h.doc_id"))
    return named.join(staged(hit, "contaminated").alias("h"), same, "left_anti").select(*COLUMNS)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind in brackets; n_chars follows the text."""
    found = pii.findings(docs.select(*COLUMNS)).withColumn("text", pii.redacted())
    return found.withColumn(
        "n_chars", F.when(F.size("spans") > 0, F.length("text").cast("bigint"))
        .otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and digests of ids and decoded text."""
    return bpe.tokens(docs, vocabulary(), keep=["doc_id", "lang", "source"], ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal),
    ("bpe", encode),
]

# A fitted model takes part, which SQL does not express: tests/llm holds a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
