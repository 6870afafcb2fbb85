"""One query per operator over its whole table, with the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adweave.llm import bpe, checks, decontam, filteraudit, htmltext, langid, neardup, pii, quality, registry, secretscan, sentences, spelling, substrings, toxicity  # noqa: F401
from adweave.llm.registry import query, table


@query("op5_quality_rules", checks.QUALITY)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed").bitwiseAND(F.lit(quality.BASE.mask)) != 0
    return quality.verdicts(rows, quality.V1).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", F.col("failed").alias("failed_bits"))


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokens(table(spark, sf_dir, "documents"), vocabulary())


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_pii", checks.PII)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.findings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k.name}')) as bigint)")
              .alias(f"n_{k.name}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(True), 256).alias("base_sha256"),
                        pii.listed(False).alias("spans"))


@query("op2_decontamination", checks.DECONTAM)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op10_near_duplicates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def fold(parts: int) -> str:
    """crc32 of a document's id as text, modulo ``parts``."""
    return f"pmod(crc32(cast(cast(doc_id as string) as binary)), {parts})"


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), f"{fold(3)} <> 1")
    return toxicity.scores(docs, model).select(
        "doc_id", F.coalesce(F.expr(f"{fold(3)} = 1"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "worst_start", "worst_end", "worst_score")


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs, f"{fold(5)} <> 0"))
    return found.select("doc_id", F.coalesce(F.expr(f"{fold(5)} = 0"), F.lit(False))
                        .alias("held_out"), "lang_pred", "score")


@query("op1_html_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query("op3_repeated_substrings")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(table(spark, sf_dir, "documents"))


@query("op7_sentence_spans")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.removals(table(spark, sf_dir, "documents"))


@query("op11_filter_audit", checks.FILTER_AUDIT)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_secrets", checks.SECRETS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.findings(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{r.name}')) as bigint)")
              .alias(f"n_{r.name}") for r in secretscan.RULES if r.base]
    return found.select("doc_id", *counts, F.sha2(secretscan.listed(True), 256).alias("base_sha256"),
                        secretscan.listed(False).alias("spans"))

@query("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))
