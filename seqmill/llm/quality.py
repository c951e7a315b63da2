"""Operator 4: text quality from random-indexing word vectors and a small network.

A word is a run of letters, a digit run or a run of other marks. Each word of
the learned vocabulary has a random index vector, sparse and ternary, that
follows from the word itself; its word vector is that plus the index vectors
of its neighbours in a bounded sample of labelled texts. A word outside the
vocabulary has its shape's vector. A document is the mean of its words'
vectors, weighted against frequent words, besides a few shares: of repeated
words, repeated lines, marks, capitals, and its length. A two-layer network in
numpy gives a logit, and a temperature fitted on held-back training rows makes
it a calibrated probability.

Defined results: null and empty texts have no words, which is a document of
zeros and scored as such; where no row is labelled the score is 0.5; repeated
rows are scored alike; a document labelled twice counts as the lower label.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, prepare, stored, table, texts_of
from .langid import fraction, remainder, taken

#: Bounds of labelled rows that are learned from, and of their bytes, but for the last text.
SAMPLE, SAMPLE_BYTES = 4000, 32 << 20
VOCABULARY, DIMENSIONS, ONES, NEAR = 8000, 64, 6, 2
HIDDEN, EPOCHS, RATE, DECAY = 24, 400, 0.02, 1e-4
#: Words whose ids a Python process remembers.
MEMO_WORDS = 100_000
EXTRA = 7

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\s\w]+|_+")
SHAPES = ("<lower>", "<Title>", "<UPPER>", "<miXed>", "<digits>", "<marks>")


def shape(word: str) -> int:
    if word[0].isalpha():
        return 2 if word.isupper() and len(word) > 1 else 0 if word.islower() else 1 if word[1:].islower() or len(word) == 1 else 3
    return 4 if word[0].isdigit() else 5


def index_vector(word: str) -> np.ndarray:
    """Sparse ternary vector that follows from the word alone."""
    rng = np.random.default_rng(zlib.crc32(word.encode("utf-8")))
    out = np.zeros(DIMENSIONS, np.float32)
    out[rng.choice(DIMENSIONS, ONES, replace=False)] = rng.choice((-1.0, 1.0), ONES)
    return out


class _Ids(dict):
    """Ids of vocabulary words; other words get their shape's id and are remembered for a while."""

    def __init__(self, vocabulary: list[str]):
        super().__init__({w: i + len(SHAPES) for i, w in enumerate(vocabulary)})
        self.own = dict(self)

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
            self.update(self.own)
        out = self[word] = shape(word)
        return out


class QualityModel:
    def __init__(self, vocabulary: list[str], vectors: np.ndarray, weights: list[np.ndarray] | None, mean=None, scale=None, temperature: float = 1.0):
        self.vocabulary, self.vectors, self.weights = vocabulary, vectors, weights
        self.mean, self.scale, self.temperature = mean, scale, temperature
        self._ids = None

    def __getstate__(self):
        return self.__dict__ | {"_ids": None}

    def features(self, texts: list[str]) -> np.ndarray:
        """Pooled vectors and shares of whole texts."""
        if self._ids is None:
            self._ids = _Ids(self.vocabulary)
        out = np.zeros((len(texts), DIMENSIONS + len(SHAPES) + EXTRA), np.float32)
        get = self._ids.__getitem__
        for i, text in enumerate(texts):
            words = _WORD.findall(text)
            n = len(words)
            if not n:
                continue
            ids = np.fromiter(map(get, words), np.int64, n)
            counts = np.bincount(ids, minlength=len(self.vectors))
            there = np.flatnonzero(counts)
            out[i, :DIMENSIONS] = counts[there] @ self.vectors[there] / n
            out[i, DIMENSIONS : DIMENSIONS + len(SHAPES)] = np.sqrt(counts[: len(SHAPES)] / n)
            lines = text.split("\n")
            distinct = len(set(words))
            again = sum(map(str.__eq__, words, words[1:]))
            marks = sum(w[0] not in ".,;:'\"-?" or len(w) > 1 for w in words if not w[0].isalnum())
            out[i, -EXTRA:] = (np.log1p(n), np.sqrt(again / n), np.sqrt(1 - len(set(lines)) / len(lines)), distinct / n**0.8, np.sqrt(marks / n), np.log1p(len(text) / len(lines)), np.log1p(len(text) / n))
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.features(texts)) / self.temperature, -60, 60)))


def word_vectors(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Vocabulary and vectors, shapes first; a word's weight falls with the share of its occurrences."""
    words = [_WORD.findall(t) for t in texts]
    freq = Counter(w for ws in words for w in ws)
    vocabulary = [w for w, n in sorted(freq.items(), key=lambda kv: (-kv[1], kv[0]))[:VOCABULARY] if n > 1]
    ids = _Ids(vocabulary)
    index = np.stack([index_vector(w) for w in (*SHAPES, *vocabulary)])
    context = np.zeros_like(index)
    for ws in words:
        seq = np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))
        for d in range(1, NEAR + 1):
            if len(seq) > d:
                np.add.at(context, seq[d:], index[seq[:-d]])
                np.add.at(context, seq[:-d], index[seq[d:]])
    size = np.linalg.norm(context, axis=1, keepdims=True)
    vectors = index / np.sqrt(ONES) + context / np.maximum(size, 1e-6)
    total = max(1, sum(freq.values()))
    count = np.array([total / 50] * len(SHAPES) + [freq[w] for w in vocabulary])
    return vocabulary, (vectors * (1e-2 / (1e-2 + count / total))[:, None]).astype(np.float32)


def fit(texts: list[str], labels: list[int], held: list[bool]) -> QualityModel:
    """Fit on labelled texts; ``held`` marks those on which only the temperature is fitted."""
    y, held = np.array(labels, float), np.array(held, bool)
    if not len(texts) or not (~held).any():
        return QualityModel([], np.zeros((len(SHAPES), DIMENSIONS), np.float32), None)
    vocabulary, vectors = word_vectors([t for t, h in zip(texts, held, strict=True) if not h])
    model = QualityModel(vocabulary, vectors, None)
    x = model.features(texts)
    model.mean, model.scale = x[~held].mean(0), x[~held].std(0) + 1e-3
    z, t = (x[~held] - model.mean) / model.scale, y[~held]
    rng = np.random.default_rng(0)
    w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    share = np.clip(t.mean(), 0.02, 0.98)
    weight = np.where(t > 0, 0.5 / share, 0.5 / (1 - share)) * 0.5 + 0.5
    for k in range(1, EPOCHS + 1):
        h = np.tanh(z @ w[0] + w[1])
        p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -60, 60)))
        g = weight * (p - t) / len(t)
        back = np.outer(g, w[2]) * (1 - h**2)
        grads = [z.T @ back + DECAY * w[0], back.sum(0), h.T @ g + DECAY * w[2], g.sum(keepdims=True)]
        for i, gr in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * gr
            second[i] = 0.999 * second[i] + 0.001 * gr**2
            w[i] = w[i] - RATE * first[i] / (1 - 0.9**k) / (np.sqrt(second[i] / (1 - 0.999**k)) + 1e-8)
    model.weights = w
    at = held if held.any() else ~held
    logit, t = model.logits(x[at]), y[at]
    grid = np.exp(np.linspace(np.log(0.2), np.log(10), 60))
    loss = [np.logaddexp(0, np.where(t > 0, -logit, logit) / g).mean() for g in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, most: int = SAMPLE_BYTES) -> tuple[list[str], list[int], list[bool]]:
    """Texts and labels of the ``bound`` labelled ids whose hash is least; fewer where their texts have over ``most`` bytes.

    Of an id with several texts the first in order counts. A fifth of the ids are held back for the temperature.
    """
    labels = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labels = labels.withColumn("h", fraction(F.xxhash64(F.lit("quality"), F.col("doc_id"))))
    n = labels.count()
    if not n:
        return [], [], []
    # half as many ids again as are asked for, as not all may have a text; they may be broadcast, so the texts stay where they are
    chosen = labels.filter(F.col("h") < min(1.0, 1.5 * bound / n))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality", "h").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = stored(rows.withColumns({"all": F.lit(0)}), "labelled", rows=2 * bound)
    least = {r["doc_id"]: r["quality"] for r in rows.select("doc_id", "quality").collect()}
    texts, _, ids = taken(rows, "all", bound, most)
    return texts, [int(least[i] > 0) for i in ids], [zlib.crc32(f"held {i}".encode()) % 5 == 0 for i in ids]


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score`` of every text, and the columns named in ``keep`` as they are."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    shared = spark.sparkContext.broadcast(model)  # VOCABULARY by DIMENSIONS floats: 2 MB
    names = ["doc_id", *[f"kept_{c}" for c in keep]]

    def run(batches):
        model = shared.value
        for batch in batches:
            for a, b in chunks(batch, "text"):
                own = [batch.column(c).slice(a, b - a) for c in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array(model.score(texts_of(batch, "text", a, b)), pa.float64())], names=[*names, "score"])

    kinds = dict(docs.dtypes)
    out = docs.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", score double")
    return out.select("doc_id", *[F.col(f"kept_{c}").alias(c) for c in keep], "score")


#: A document is accepted from this score on.
ACCEPT = 0.3


def train(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> QualityModel:
    """Fit on ``labels`` outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return fit(*sample(docs, table(spark, sf_dir, "labels").filter(remainder(5) != 0)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), train(spark, sf_dir))
    return found.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
