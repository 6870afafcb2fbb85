"""Language identification of mixed texts.

Every word gets one score per language: log-likelihoods of its byte trigrams and of the word
itself, learned from labelled documents. The word's script (code point ranges) first narrows
the languages to those whose training text uses that script. Viterbi over the words, with a
penalty for every switch, labels spans; a document's language is the one with most letters.

A text whose words gain no more than half the penalty from another language on any stretch
keeps one label throughout, which is what Viterbi would find; such texts are recognised for
a whole record batch at once and only the others are walked word by word.

The model is fitted on a bounded sample: ``SAMPLE_ROWS`` documents of each language at most,
chosen by a hash of doc_id and taken whole, however long. Tasks count the sample's words and
trigrams, so the driver sees no text, only sums: ``2 * SLOTS`` numbers for each language.

Null and empty texts and those without a letter are ``und`` with score 0. A text whose
letters belong to no learned script gets the most frequent language with score 0; without
any labelled document all texts are ``und``. Rows are judged alone; repeated rows get equal
results, an empty table gives an empty one, columns not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adweave.llm import textbatch as T

SAMPLE_ROWS = 500
SLOTS = 1 << 16
SWITCH = 14.0
PIECE = 8_000_000  # bytes of text walked together, divided by the number of languages
UNKNOWN = "und"

# First code point of each script block (fixed values); 0 is not a letter.
SCRIPTS = ["none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai",
           "georgian", "hangul", "kana", "han"]
BLOCKS = [(0x00, "none"), (0x41, "latin"), (0x5B, "none"), (0x61, "latin"), (0x7B, "none"),
          (0xAA, "latin"), (0xAB, "none"), (0xB5, "latin"), (0xB6, "none"), (0xC0, "latin"),
          (0x2B0, "none"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"),
          (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "none"),
          (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "none"), (0x1E00, "latin"),
          (0x1F00, "greek"), (0x2000, "none"), (0x3040, "kana"), (0x3100, "none"),
          (0x3400, "han"), (0xA000, "none"), (0xAC00, "hangul"), (0xD800, "none"),
          (0xF900, "han"), (0xFB00, "none"), (0xFB50, "arabic"), (0xFE00, "none"),
          (0x20000, "han"), (0x30000, "none")]
_STARTS = np.array([lo for lo, _ in BLOCKS])
_IDS = np.array([SCRIPTS.index(s) for _, s in BLOCKS], np.uint8)
LETTERS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # SLOTS x languages, log-likelihood less the mean over languages
    whole: np.ndarray
    allowed: np.ndarray  # scripts x languages
    prior: np.ndarray


def scripts(buf: np.ndarray) -> np.ndarray:
    """The script of the code point that starts at each byte; 0 for continuation bytes."""
    out = np.zeros(len(buf), np.uint8)
    ascii_ = buf < 128
    out[ascii_] = LETTERS[buf[ascii_]]
    pad = np.concatenate([buf, np.zeros(3, np.uint8)])
    for lead, bits, size in ((0xC0, 5, 2), (0xE0, 4, 3), (0xF0, 3, 4)):
        at = np.flatnonzero((buf >= lead) & (buf < lead + (1 << bits)))
        cp = pad[at].astype(np.int64) & ((1 << bits) - 1)
        for k in range(1, size):
            cp = (cp << 6) | (pad[at + k] & 0x3F)
        out[at] = _IDS[np.searchsorted(_STARTS, cp, side="right") - 1]
    return out


@dataclass
class Features:
    """Words of a piece with their trigram slots, word slot, script and letters."""

    words: T.Words
    gram: np.ndarray  # of each word byte
    first: np.ndarray  # of each word, into gram; one more at the end
    slot: np.ndarray
    script: np.ndarray
    letters: np.ndarray


def features(p: T.Piece) -> Features:
    w = T.words(p, LETTERS)
    size = w.end - w.start
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(w.start - first[:-1], size) + np.arange(first[-1])
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] = lower[97:123]
    b = lower[p.buf[at]].astype(np.uint64)
    left, right = np.roll(b, 1), np.roll(b, -1)
    left[first[:-1]] = 0
    right[first[1:] - 1] = 0
    gram = T.mix(left << T.U64(16) | b << T.U64(8) | right) % T.U64(SLOTS)
    whole = T.Hashes(p.buf, fold=True).span(w.start, w.end) % T.U64(SLOTS)
    script = scripts(p.buf)[at]
    own = np.maximum.reduceat(script, first[:-1]) if len(size) else np.zeros(0, np.uint8)
    count = np.concatenate([[0], np.cumsum(script > 0)])
    return Features(w, gram.astype(np.int64), first, whole.astype(np.int64), own,
                    count[first[1:]] - count[first[:-1]])


GRAMS, WHOLE, USED, TEXTS = range(4)  # what is counted


def counts(p: T.Piece, language: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """What a piece adds to each table, as (table, place, number); places go language by language."""
    f = features(p)
    of_word = language[f.words.row]
    of_byte = np.repeat(of_word, np.diff(f.first))
    for which, place in ((GRAMS, f.gram * n + of_byte), (WHOLE, f.slot * n + of_word),
                         (USED, f.script.astype(np.int64) * n + of_word), (TEXTS, language)):
        yield which, *np.unique(place, return_counts=True)


def fit(total: dict[int, tuple[np.ndarray, np.ndarray]], names: list[str]) -> Model:
    """The model from the summed counts of each table."""
    n = len(names)

    def table(which: int, rows: int, least: float) -> np.ndarray:
        out = np.full(rows * n, least)
        place, number = total.get(which, (np.zeros(0, np.int64), 0))
        out[place] += number
        return out.reshape(rows, n)

    def scores(which: int) -> np.ndarray:
        seen = table(which, SLOTS, 0.5)
        log = np.log(seen / seen.sum(axis=0))
        return (log - log.mean(axis=1, keepdims=True)).astype(np.float32)

    used, texts = table(USED, len(SCRIPTS), 0.0), table(TEXTS, 1, 0.0)[0]
    allowed = used > 0.01 * np.maximum(used.sum(axis=0), 1)
    allowed[0] = False
    return Model(names, scores(GRAMS), scores(WHOLE), allowed, texts / max(texts.sum(), 1))


def word_scores(f: Features, m: Model) -> np.ndarray:
    out = np.empty((len(f.slot), len(m.languages)), np.float64)
    for k in range(len(m.languages)):
        total = np.concatenate([[0.0], np.cumsum(m.grams[f.gram, k], dtype=np.float64)])
        out[:, k] = (total[f.first[1:]] - total[f.first[:-1]]) / 3 + m.whole[f.slot, k]
    fits = m.allowed[f.script]
    out[~fits.any(axis=1)] = 0
    out[fits.any(axis=1)[:, None] & ~fits] = -60
    return out


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word; ``first[r]:first[r+1]`` are the words of text r.

    Texts advance together, longest first, so a step works on all that are not yet over.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    label = np.zeros(len(score), np.int64)
    if not len(order):
        return label
    start, size = first[order], size[order]
    steps = int(size[0])
    live = np.searchsorted(-size, -np.arange(steps), side="left")
    back = np.zeros(score.shape, bool)  # did switching to a label pay here
    origin = np.zeros(len(score), np.int64)
    best = score[start].copy()
    for t in range(1, steps):
        k = live[t]
        b = best[:k]
        top = b.argmax(axis=1)
        stay = b
        move = b[np.arange(k), top][:, None] - switch
        at = start[:k] + t
        origin[at] = top
        switched = move > stay
        back[at] = switched
        best[:k] = np.where(switched, move, stay) + score[at]
    now = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = live[t]
        at = start[:k] + t
        label[at] = now[:k]
        came = back[at, now[:k]]
        now[:k] = np.where(came, origin[at], now[:k])
    return label


def labels(f: Features, m: Model, switch: float = SWITCH) -> np.ndarray:
    """Language number of every word."""
    score = word_scores(f, m)
    first, row = f.words.first, f.words.row
    n = len(first) - 1
    total = np.zeros((len(score) + 1, score.shape[1]))
    np.cumsum(score, axis=0, out=total[1:])
    single = (total[first[1:]] - total[first[:-1]]).argmax(axis=1)
    label = single[row]
    if not len(row):
        return label
    own = score[np.arange(len(row)), label]
    walk = np.zeros(n, bool)
    span = 1e7  # more than any stretch of a text can gain: keeps texts apart below
    for k in range(score.shape[1]):
        gain = np.cumsum(score[:, k] - own)
        before = np.concatenate([[0.0], gain[:-1]])
        base = -row * span
        base = base - before[first[:-1]][row]
        low = np.minimum.accumulate(before + base)
        walk[np.unique(row[gain + base - low > switch / 2])] = True
    if walk.any():
        some = walk[row]
        size = np.diff(first) * walk
        label[some] = viterbi(score[some], np.concatenate([[0], np.cumsum(size)]), switch)
    return label


def sample(docs: DataFrame, rows: str) -> tuple[DataFrame, list[str]]:
    """(lang, text) of the bounded training sample, and the names of the languages."""
    known = docs.where("lang is not null and doc_id is not null and text is not null").where(rows)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sizes = known.groupBy("lang").count().collect()  # one row for each language
    share = F.lit(0)
    for r in sizes:
        bound = min(1 << 30, int((1 << 30) * 1.3 * SAMPLE_ROWS / r["count"]) + 1)
        share = F.when(F.col("lang") == r["lang"], bound).otherwise(share)
    few = Window.partitionBy("lang").orderBy("slot", "doc_id", F.xxhash64("text"))
    chosen = known.withColumn("slot", slot).where(slot < share) \
        .withColumn("place", F.row_number().over(few)).where(f"place <= {SAMPLE_ROWS}")
    return chosen.select("lang", "text"), sorted(r["lang"] for r in sizes)


def train(docs: DataFrame, rows: str = "true") -> Model | None:
    chosen, names = sample(docs, rows)
    if not names:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in T.pieces(batches):
            language = np.searchsorted(names, p.column("lang").to_numpy(zero_copy_only=False).astype(str))
            for which, place, number in counts(p, language, len(names)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), which, np.int32)), pa.array(place), pa.array(number)],
                    ["which", "place", "number"])

    got = chosen.mapInArrow(run, "which int, place bigint, number bigint") \
        .groupBy("which", "place").agg(F.sum("number").alias("number")).toArrow()
    which = got["which"].to_numpy()
    return fit({k: (got["place"].to_numpy()[which == k], got["number"].to_numpy()[which == k])
                for k in range(4)}, names)


def _scan(docs: DataFrame, model: Model | None, keep: list[str], made: dict[str, str], build):
    slim = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in slim.drop("__text").dtypes]
                       + [f"{n} {t}" for n, t in made.items()])
    # 2 * SLOTS numbers a language, as plain arrays: executors need no class of this package.
    shared = docs.sparkSession.sparkContext.broadcast(
        model and (model.languages, model.grams, model.whole, model.allowed, model.prior))
    limit = PIECE // max(4, len(model.languages) if model else 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value) if shared.value else None
        for p in T.pieces(batches, "__text", limit):
            yield pa.RecordBatch.from_arrays(
                [p.rows.column(i) for i in range(len(keep))] + build(p, m), keep + list(made))

    return slim.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, lang_pred, score (share of the letters in that language)."""
    made = {"lang_pred": "string", "score": "double"}
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in made]

    def build(p: T.Piece, m: Model | None) -> list[pa.Array]:
        if m is None:
            return [pa.array([UNKNOWN] * p.n), pa.array(np.zeros(p.n))]
        f = features(p)
        n = len(m.languages)
        weight = f.letters * m.allowed[f.script].any(axis=1)
        got = np.bincount(f.words.row * n + labels(f, m), weight, p.n * n).reshape(p.n, n)
        total = got.sum(axis=1)
        best = np.where(total > 0, got.argmax(axis=1), m.prior.argmax())
        names = np.array(m.languages, object)[best]
        for r in np.flatnonzero(total == 0):
            text = p.buf[p.start[r]:p.end[r]].tobytes().decode("utf-8", "replace")
            if not any(map(str.isalpha, text)):
                names[r] = UNKNOWN
        return [pa.array(names, pa.string()), pa.array(got.max(axis=1) / np.maximum(total, 1))]

    return _scan(docs, model, keep, made, build)


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and its spans: array of (lang, start, stop), in bytes from word to word."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def build(p: T.Piece, m: Model) -> list[pa.Array]:
        f = features(p)
        label, row = labels(f, m), f.words.row
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(row)) - 1
        out: list[list] = [[] for _ in range(p.n)]
        for i, j in zip(head.tolist(), last.tolist()):
            r = int(row[i])
            out[r].append({"lang": m.languages[label[i]],
                           "start": int(f.words.start[i] - p.start[r]),
                           "stop": int(f.words.end[j] - p.start[r])})
        return [pa.array(out, kind)]

    return _scan(docs, model, ["doc_id"],
                 {"spans": "array<struct<lang:string,start:bigint,stop:bigint>>"}, build)
