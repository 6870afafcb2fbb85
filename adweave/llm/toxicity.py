"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its hashed
words; a document is trained as the noisy-or of its sentences: 1 - prod(1 - p). Only documents
are labelled, so the gradient of the document likelihood tells which sentences to blame, and
the learned sentence scores locate the offending ones afterwards.

A noisy-or of many clean sentences comes near 1 by their number alone. A document's score
therefore takes the larger of its worst sentence and the noisy-or less what as many clean
sentences of the training texts sum to (``SPREAD`` deviations above the mean). Sentences of one
text with equal scores count once in this, so a repeated text is no worse than one copy.

Training uses a bounded sample: of each label at most ``SAMPLE_ROWS`` rows, those with the
smallest hash of doc_id, whatever their length. Of a clean text the first ``CLEAN_CHARS``
characters are taken (a piece of a clean text is clean), a toxic one is taken whole. It runs
in numpy on the driver; scoring reads whole texts as record batches, without any shuffle.

Null and empty texts have no sentence and get the score of an empty bag. Rows are scored
alone, so ties and repeated rows get equal scores; an empty table gives an empty result.
Without labelled rows of both kinds every document gets the score 0. Columns not asked for
by ``keep`` are ignored, kept columns with an output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adweave.llm import textbatch as T

SAMPLE_ROWS = {0: 2000, 1: 1000}  # of each label
CLEAN_CHARS = 100_000
SLOTS = 1 << 20
LEAST_TEXTS = 4  # rarer words keep weight 0: they would only learn single texts by heart
FLOOR = 1e-6  # probability of an empty bag
THRESHOLD = 0.7
SPREAD = 3.0


@dataclass
class Bags:
    """Hashed words of all sentences of some texts, sentence by sentence, text by text."""

    slot: np.ndarray  # of each word
    sentence: np.ndarray  # of each word
    text: np.ndarray  # of each sentence
    start: np.ndarray  # of each sentence, in bytes of the piece
    end: np.ndarray
    n: int

    def small(self) -> "Bags":
        """Without byte places, in 32 bits."""
        none = np.zeros(0, np.int32)
        return Bags(*[a.astype(np.int32) for a in (self.slot, self.sentence, self.text)],
                    none, none, self.n)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.sentence, weights[self.slot], len(self.text))


def bags(p: T.Piece) -> Bags:
    """Sentences end after . ! ? or a line feed; those without a word are left out.

    A word counts once per sentence.
    """
    w = T.words(p, T.ALNUM)
    h = T.Hashes(p.buf, fold=True).span(w.start, w.end)
    stop = np.isin(p.buf, np.frombuffer(b".!?\n", np.uint8))
    stop[p.end[p.end > p.start] - 1] = True
    ends = np.flatnonzero(stop) + 1
    which = np.searchsorted(ends, w.start, side="right")
    key = T.mix(h ^ T.mix(which.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    first.sort()
    used, sentence = np.unique(which[first], return_inverse=True)
    begin = np.concatenate([[0], ends])[used]
    text = p.row_of(begin) if len(used) else np.zeros(0, np.int64)
    return Bags((h[first] % T.U64(SLOTS)).astype(np.int64), sentence, text, begin, ends[used], p.n)


def joined(parts: list[Bags]) -> Bags:
    """Bags of consecutive pieces as one (without byte places)."""
    texts = np.cumsum([0] + [b.n for b in parts])
    before = np.cumsum([0] + [len(b.text) for b in parts])
    none = np.zeros(0, np.int32)
    return Bags(np.concatenate([b.slot for b in parts]),
                np.concatenate([b.sentence + np.int32(k) for b, k in zip(parts, before)]),
                np.concatenate([b.text + np.int32(k) for b, k in zip(parts, texts)]), none, none,
                int(texts[-1]))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    mean: float = 0.0  # of -log(1 - p) of a clean sentence, and its standard deviation
    deviation: float = 0.0

    def sentences(self, b: Bags) -> np.ndarray:
        return _sigmoid(b.sums(self.weights) + self.bias)

    def texts(self, b: Bags, sentence: np.ndarray) -> np.ndarray:
        text, hazard = _hazards(b, sentence)
        count = np.bincount(text, minlength=b.n)
        over = np.bincount(text, hazard, b.n) - count * self.mean \
            - SPREAD * self.deviation * np.sqrt(count)
        worst = np.zeros(b.n)
        np.maximum.at(worst, text, hazard)
        return np.maximum(-np.expm1(-np.maximum(worst, over)), FLOOR)


def _hazards(b: Bags, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and -log(1 - p) of the sentences, one of those of a text with equal scores."""
    hazard = -np.log1p(-np.minimum(sentence, 1 - 1e-12))
    order = np.lexsort((hazard, b.text))
    text, hazard = b.text[order], hazard[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hazard[1:] != hazard[:-1])
    return text[new], hazard[new]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(b: Bags, labels: np.ndarray, steps: int = 300, rate: float = 0.1,
        decay: float = 1e-4, noise: float = 0.1) -> Model:
    """Full-batch Adam on the noisy-or likelihood; both labels weigh the same.

    A share ``noise`` of labels is taken as wrong, so that a bag whose words say the
    opposite of its label cannot bend the common words' weights.
    """
    pairs = np.unique(b.slot.astype(np.int64) * b.n + b.text[b.sentence])
    known = np.flatnonzero(np.bincount(pairs // max(b.n, 1), minlength=SLOTS) >= LEAST_TEXTS)
    del pairs
    word = np.isin(b.slot, known)
    slot = np.searchsorted(known, b.slot[word]).astype(np.int32)
    sentence = b.sentence[word]
    k, n_sentences = len(known), len(b.text)
    w, bias = np.zeros(k), -5.0
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    for step in range(1, steps + 1):
        logit = np.bincount(sentence, w[slot], n_sentences) + bias
        s = np.minimum(_sigmoid(logit), 1 - 1e-9)
        log_clean = np.bincount(b.text, np.log1p(-s), b.n)
        toxic = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-9)
        seen = noise + (1 - 2 * noise) * toxic
        # d loss / d log_clean of a text, then d log_clean / d sentence logit = -s
        slope = -share * np.where(labels == 1, 1 / seen, -1 / (1 - seen)) \
            * (1 - 2 * noise) * -(1 - toxic)
        on_sentence = slope[b.text] * -s
        g = np.append(np.bincount(slot, on_sentence[sentence], k) + decay * np.sign(w),
                      on_sentence.sum())
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        before = w
        w = w - move[:-1]
        w[before * w < 0] = 0  # the penalty stops at zero
        bias -= move[-1]
    weights = np.zeros(SLOTS)
    weights[known] = w
    model = Model(weights, float(bias))
    text, hazard = _hazards(b, model.sentences(b))
    clean = hazard[labels[text] == 0]
    if len(clean):
        model.mean, model.deviation = float(clean.mean()), float(clean.std())
    return model


def sample(docs: DataFrame, labels: DataFrame, train: str) -> DataFrame:
    """(text, toxic): the bounded training sample; ``train`` is a condition on doc_id."""
    order = F.xxhash64("doc_id")
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(train) \
        .select("doc_id", "toxic").distinct()
    parts = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(SAMPLE_ROWS[k])
             for k in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # a bounded number of rows of two numbers
    return docs.select("doc_id", "text").join(chosen, "doc_id") \
        .where("text is not null") \
        .orderBy(order, "doc_id", F.xxhash64("text"), "toxic").limit(sum(SAMPLE_ROWS.values())) \
        .select(F.when(F.col("toxic") == 0, F.left("text", F.lit(CLEAN_CHARS)))
                .otherwise(F.col("text")).alias("text"), "toxic")


def train(docs: DataFrame, labels: DataFrame, rows: str = "true") -> Model:
    got = sample(docs, labels, rows).toArrow()
    toxic = got["toxic"].to_numpy().astype(np.int64)
    if not 0 < toxic.sum() < len(toxic):
        return Model(np.zeros(SLOTS), -40.0)
    parts = joined([bags(p).small() for p in T.pieces(iter(got.select(["text"]).to_batches()))])
    del got
    return fit(parts, toxic)


def scores(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, score, and the span of the worst sentence with its score.

    ``worst_start`` and ``worst_end`` count bytes of the text; null without a sentence.
    """
    made = {"score": "double", "worst_start": "bigint", "worst_end": "bigint",
            "worst_score": "double"}
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in made]
    slim = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in slim.drop("__text").dtypes]
                       + [f"{n} {t}" for n, t in made.items()])
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.bias, model.mean, model.deviation))  # SLOTS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value[0].astype(np.float64), *shared.value[1:])
        for p in T.pieces(batches, "__text"):
            b = bags(p)
            s = m.sentences(b)
            order = np.lexsort((b.start, -s, b.text))
            rows, first = np.unique(b.text[order], return_index=True)
            best = np.full(p.n, -1)
            best[rows] = order[first]
            none = best < 0
            pick = (lambda v: pa.array(v[best] if len(v) else np.zeros(p.n, v.dtype), mask=none))
            yield pa.RecordBatch.from_arrays(
                [p.rows.column(i) for i in range(len(keep))]
                + [pa.array(m.texts(b, s)),
                   pick((b.start - p.start[b.text]).astype(np.int64)),
                   pick((b.end - p.start[b.text]).astype(np.int64)), pick(s)],
                keep + list(made))

    return slim.mapInArrow(run, schema)


def sentences(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, score) of all sentences that score at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.bias, model.mean, model.deviation))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value[0].astype(np.float64), *shared.value[1:])
        for p in T.pieces(batches):
            b = bags(p)
            s = m.sentences(b)
            at = np.flatnonzero(s >= least)
            raw = p.buf.tobytes()
            yield pa.RecordBatch.from_arrays(
                [p.column("doc_id").take(pa.array(b.text[at])),
                 pa.array([raw[b.start[i]:b.end[i]].decode("utf-8", "replace").strip()
                           for i in at], pa.string()), pa.array(s[at])],
                ["doc_id", "sentence", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, sentence string, score double")
