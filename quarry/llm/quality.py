"""Quality classifier: random-indexing word vectors, pooled, under a small calibrated network.

Every word (hashed into ``WORDS`` rows) and every word shape has a sparse ternary
index vector that only its number and the seed decide.  A word's vector is its
index vector plus the sum of its neighbours' index vectors over the training
texts (random indexing).  A document is the mean of its words' vectors and of
its shapes' vectors, with its length and its shares of distinct words and lines.
A two-layer network written in numpy scores it; a temperature fitted on held-back
training rows calibrates the probabilities.

Training rows are bounded: at most ``TRAIN_ROWS`` labelled ids, chosen by a hash of
doc_id, and one text for each (the least, where rows share an id).  Scoring covers
every whole text, empty ones too (null: empty).  Without labels of both kinds every
score is the share of label 1 (0.5: none).  Rows that share a doc_id, or have none, are
scored each on its own; equal texts get equal scores; a score equal to the threshold is
label 1; of several labels of an id the largest counts.  Empty tables give no rows, and
other columns are neither read nor changed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import common

TRAIN_ROWS = 12_000
THRESHOLD = 0.3
WORDS = 1 << 13
SHAPES = 40
DIM = 48
SHAPE_DIM = 40
NONZERO = 4
HIDDEN = 32
SEED = 20240
_MARKS = ".,;:!?"


def index_vectors(rows: int, dim: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors: NONZERO entries of plus or minus one in each row."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, dim), np.float32)
    at = rng.random((rows, dim)).argpartition(NONZERO, axis=1)[:, :NONZERO]
    out[np.arange(rows)[:, None], at] = rng.choice([-1.0, 1.0], (rows, NONZERO))
    return out / np.sqrt(NONZERO)


def _shape(token: str) -> int:
    """A number under SHAPES - 2 for how a token is written."""
    core = token.rstrip(_MARKS)
    tail = min(len(token) - len(core), 2)
    if not core:
        return 24 + min(len(token), 3)
    if core.isalpha():
        kind = 0 if core.islower() else 1 if core[1:].islower() or len(core) == 1 else 2 if core.isupper() else 3
    elif core.isdigit():
        kind = 4
    elif core.isalnum():
        kind = 5
    elif not any(map(str.isalnum, core)):
        return 28 + min(len(core), 3)
    else:
        bare = core.strip("#$%&*+-/<=>@\\^_|~'\"()[]{}`" + _MARKS)
        if not bare.isalnum():
            kind = 6
        else:
            return 32 + min(len(core) - len(bare), 3) + (0 if core.startswith(bare) else 2)
    return kind * 3 + tail


class Codes:
    """token -> (word row, shape), remembered up to a bound."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = zlib.crc32(t.strip(_MARKS).lower().encode()) % WORDS * 64 + _shape(t)
        both = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        shapes = both & 63
        if len(both) > 1:
            word = both >> 6
            shapes[1:][word[1:] == word[:-1]] = SHAPES - 2
            shapes[2:][(word[2:] == word[:-2]) & (word[2:] != word[1:-1])] = SHAPES - 1
        return both >> 6, shapes


def features(texts, words: np.ndarray, shapes: np.ndarray, codes: Codes) -> np.ndarray:
    """One row per text."""
    out = np.zeros((len(texts), DIM + SHAPE_DIM + 4), np.float32)
    for i, text in enumerate(texts):
        tokens = (text or "").split()
        if not tokens:
            out[i, -1] = 1
            continue
        w, s = codes.of(tokens)
        total = np.zeros(DIM, np.float32)
        for k in range(0, len(w), 1 << 15):
            total += words[w[k : k + (1 << 15)]].sum(0)
        out[i, :DIM] = total / len(w)
        out[i, DIM : DIM + SHAPE_DIM] = np.bincount(s, minlength=SHAPES).astype(np.float32) @ shapes / len(w)
        lines = text.split("\n")
        out[i, -4:] = np.log1p(len(w)) / 10, len(set(tokens)) / len(w), len(set(lines)) / len(lines), 0
    return out


def _context_sums(texts, codes: Codes, index: np.ndarray, reach: int = 2) -> np.ndarray:
    """For each word row the sum of its neighbours' index vectors, through their few non-zero entries."""
    gap = np.full(reach, -1, np.int64)
    flat = np.concatenate([gap, *[x for t in texts for x in (codes.of((t or "").split())[0], gap)]])
    at = np.argsort(index == 0, axis=1, kind="stable")[:, :NONZERO]
    sign = np.take_along_axis(index, at, 1)
    out = np.zeros(WORDS * DIM)
    for d in range(1, reach + 1):
        for word, near in ((flat[d:], flat[:-d]), (flat[:-d], flat[d:])):
            both = (word >= 0) & (near >= 0)
            word, near = word[both], near[both]
            for k in range(NONZERO):
                out += np.bincount(word * DIM + at[near, k], weights=sign[near, k], minlength=WORDS * DIM)
    return out.reshape(WORDS, DIM).astype(np.float32)


class Network:
    """Two layers: tanh, then one logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED, epochs: int = 60, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.temperature = 1.0
        back = rng.random(len(y)) < 0.2
        if len(set(y[~back])) < 2 or len(set(y[back])) < 2:
            back[:] = False
        z = (x - self.mean) / self.scale
        p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        train, label = z[~back], y[~back]
        for _ in range(epochs):
            order = rng.permutation(len(label))
            for k in range(0, len(order), batch):
                r = order[k : k + batch]
                h = np.tanh(train[r] @ p[0] + p[1])
                e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - label[r]) / len(r)
                dh = e[:, None] * p[2] * (1 - h * h)
                grads = [train[r].T @ dh + decay * p[0], dh.sum(0), h.T @ e + decay * p[2], e.sum(keepdims=True)]
                step += 1
                for a, g, b, c in zip(p, grads, m, v):
                    b += 0.1 * (g - b)
                    c += 0.001 * (g * g - c)
                    a -= rate * (b / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
        self.params = p
        if back.any():
            logit, t = self.logits(x[back]), y[back]
            grid = np.geomspace(1, 8, 60)
            loss = [np.mean(np.logaddexp(0, np.where(t > 0, -logit, logit) / k)) for k in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.params
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Model:
    """What scoring needs; of a fixed size."""

    def __init__(self, words, shapes, network, constant: float):
        self.words, self.shapes, self.network, self.constant = words, shapes, network, constant

    def score(self, texts, codes: Codes) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.constant)
        return self.network(features(texts, self.words, self.shapes, codes)).astype(float)


def _fold(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)), F.lit(-1))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, tasks: int = 8) -> Model:
    """A model of labels.quality, from at most ``rows`` labelled documents outside the held-out fold."""
    known = labels.where(F.col("quality").isNotNull() & (_fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumnRenamed("doc_id", "_d")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_d")).groupBy(F.col("_d").alias("doc_id")).agg(F.min("text").alias("text"), F.first("quality").cast("double").alias("quality"))
    sample = common.materialise(sample.repartition(tasks, "doc_id"), "labelled")
    index, shapes = index_vectors(WORDS, DIM, SEED), index_vectors(SHAPES, SHAPE_DIM, SEED + 1)

    def contexts(batches):
        total, codes = np.zeros((WORDS, DIM), np.float32), Codes()
        for b in batches:
            total += _context_sums(b.column("text").to_pylist(), codes, index)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = np.zeros((WORDS, DIM))
    for r in sample.coalesce(tasks).mapInArrow(common.trimmed(contexts), "sums binary").collect():  # one matrix of fixed size for each of the tasks
        sums += np.frombuffer(r[0], np.float32).reshape(WORDS, DIM)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    words = (index + 0.5 * sums / np.maximum(norm, 1e-6)).astype(np.float32)

    def pooled(batches):
        codes = Codes()
        for b in batches:
            x = features(b.column("text").to_pylist(), words, shapes, codes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array([v.tobytes() for v in x], pa.binary())], names=["doc_id", "quality", "x"])

    got = sorted(map(tuple, sample.mapInArrow(common.trimmed(pooled), "doc_id long, quality double, x binary").collect()))  # at most ``rows``
    y = np.array([g[1] for g in got])
    if len(set(y)) < 2:
        return Model(words, shapes, None, float(y.mean()) if len(y) else 0.5)
    x = np.stack([np.frombuffer(g[2], np.float32) for g in got]).astype(float)
    return Model(words, shapes, Network(x, y), float(y.mean()))


def score_column(model: Model, text: Column) -> Column:
    """Probability of label 1 for each text."""

    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = Codes()
        for texts in batches:
            yield pd.Series(model.score([t if isinstance(t, str) else "" for t in texts], codes), index=texts.index)
        common.trim()

    return F.pandas_udf(f, T.DoubleType())(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", (_fold(F.col("doc_id")) == 0).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs that the classifier predicts as label 1."""
    model = fit(docs, labels)
    return docs.where(score_column(model, F.col("text")) >= THRESHOLD)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))
