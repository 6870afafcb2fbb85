"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: it stores the
measurements and one bit per failed rule. ``verdicts`` applies a policy (a version name and
the set of rules it uses) to the stored bits, and ``ablation`` tells for each rule of a
policy how many rows only that rule rejects; neither reads a text again.

Null and empty texts have no words: all measurements are 0 and ``too_few_words`` fails.
Rows are judged alone, so ties and repeated rows get equal results, an empty table gives an
empty ledger, and further input columns are carried along unless a ledger column replaces
them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adweave.llm import textbatch as T

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"

# Rule name -> condition on the measurements that means failure. The place in this list is
# the rule's bit for good: new rules go to the end.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
]


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit(r) for r in self.rules)


def bit(rule: str) -> int:
    return [name for name, _ in RULES].index(rule)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
V1 = Policy("v1", tuple(name for name, _ in RULES))


def measure_piece(p: T.Piece) -> dict[str, np.ndarray]:
    w = T.words(p, T.NOT_SPACE)
    h = T.Hashes(p.buf)
    symbol = ~T.byte_class(SYMBOLS)
    counts = {
        "n_words": w.per_row,
        "word_chars": p.sums(T.NOT_SPACE[p.buf] & ~T.CONTINUES[p.buf]),
        "n_symbols": p.sums(symbol[p.buf]),
    }
    # Lines end before a line feed or with their row; starts past the last byte drop out.
    feeds = np.flatnonzero(p.buf == 10)
    line_start = np.union1d(feeds + 1, p.start)
    line_start = line_start[line_start < len(p.buf)]
    feed = np.append(feeds, len(p.buf))[np.searchsorted(feeds, line_start)]
    stop = np.minimum(feed, p.end[p.row_of(line_start)])
    full = np.zeros(len(p.buf) + 1, np.int64)
    np.cumsum(T.NOT_SPACE[p.buf], out=full[1:])
    worded = full[stop] > full[line_start]
    line_start, stop = line_start[worded], stop[worded]
    row = p.row_of(line_start)
    counts["n_lines"] = np.bincount(row, minlength=p.n)
    _, first = np.unique(_in_row(h.span(line_start, stop), row), return_index=True)
    counts["n_dup_lines"] = counts["n_lines"] - np.bincount(row[first], minlength=p.n)
    # Windows of three words that come twice in their row.
    name, at = T.shingles(h.span(w.start, w.end), w.row, 3)
    _, which, times = np.unique(_in_row(name, w.row[at]), return_inverse=True,
                                return_counts=True)
    twice = at[times[which] > 1]
    covered = np.zeros(len(w.row), bool)
    for k in range(3):
        covered[twice + k] = True
    counts["n_repeat_words"] = np.bincount(w.row[covered], minlength=p.n)
    return counts


def _in_row(name: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Names that are equal only within one row."""
    return T.mix(name + T.mix(row.astype(np.uint64) + T.U64(1)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for p in T.pieces(batches, "__text"):
        counts = measure_piece(p)
        keep = [i for i, f in enumerate(p.rows.schema) if f.name != "__text"]
        cols = [p.rows.column(i) for i in keep]
        names = [p.rows.schema.field(i).name for i in keep]
        yield pa.RecordBatch.from_arrays(
            cols + [pa.array(counts[m].astype(np.int64)) for m in MEASURES], names + MEASURES)


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the measurements, and ``failed``: bit i is set if rule i fails."""
    keep = ["doc_id"] if keep is None else keep
    keep = [c for c in keep if c not in [*MEASURES, "failed"]]
    slim = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in slim.drop("__text").dtypes]
                       + [f"{m} bigint" for m in MEASURES])
    measured = slim.mapInArrow(_measure, schema)
    bits = " + ".join(f"if({cond}, {1 << i}L, 0L)" for i, (_, cond) in enumerate(RULES))
    return measured.withColumn("failed", F.expr(bits))


def verdicts(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    return ledger_rows.withColumns({
        "policy": F.lit(policy.version),
        "kept": F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0})


def ablation(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule: rows that fail it, rows that fail nothing else, and kept rows without it."""
    hit = F.col("failed").bitwiseAND(F.lit(policy.mask))
    sums = [F.count_if(hit == 0).alias("kept")]
    for r in policy.rules:
        one = F.lit(1 << bit(r))
        sums += [F.count_if(hit.bitwiseAND(one) != 0).alias(f"fails_{r}"),
                 F.count_if(hit == one).alias(f"only_{r}")]
    total = ledger_rows.agg(*sums)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"fails_{r}").alias("n_failed"),
                              F.col(f"only_{r}").alias("n_only"),
                              (F.col("kept") + F.col(f"only_{r}")).alias("kept_without"))
                     for r in policy.rules])
    return total.select(F.inline(rows))
