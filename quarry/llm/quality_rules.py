"""Quality rules: statistics of whole texts, plain limits on them, then boosted trees that learn the rest.

Words are runs of bytes other than 20 and 09-0D (hex).  The plain rules fail a text
of fewer than ``LEAST_WORDS`` words, or with more than half of its words in three-word
windows that are found again in it.  All others are judged by gradient-boosted trees
over the statistics (``FEATURES``), learned from ``labels.quality``.  For features in
``FALLING`` the score never rises with the feature: a split that would raise it is not
made, and the values below a split stay on their sides of its middle.  Trees are
complete and kept as arrays (feature, threshold, leaf value), so a batch of texts goes
down all trees at once, a level at a time.

Training rows are bounded: at most ``TRAIN_ROWS`` labelled ids outside the held-out
fold, chosen by a hash of doc_id, one text for each (the least, where rows share an
id).  Statistics cover every whole text.

Nulls: a null text has no words, as an empty one; both fail the plain rules.  A null
label, or one without a document, teaches nothing; of several labels of an id the
largest counts.  Repeated rows and rows that share a doc_id, or have none, are judged
each on its own; equal texts get equal results.  A score equal to the threshold keeps.
Empty tables give no rows; without labels of both kinds the plain rules alone decide
(score: the share of label 1, 1 without labels).  Other columns of the tables, whatever
their names, are neither read nor changed.  A long text is judged whole, in memory that
grows with its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import common

TRAIN_ROWS = 12_000
THRESHOLD = 0.3
LEAST_WORDS = 50
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
LEAST_WEIGHT, RIDGE = 1.0, 1.0

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeat_words", "distinct_words", "top_word", "same_neighbours",
    "upper", "digits", "sentence_marks", "exclamations", "odd_marks", "line_words", "non_ascii",
)
#: More of these never makes a text better.
FALLING = ("symbols", "dup_lines", "repeat_words", "same_neighbours", "exclamations")

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
_MARKS = np.frombuffer(b".,;:!?", np.uint8)
_ODD = np.array([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?'\"()-"], np.uint8)


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """Words that stand in a window of ``width`` words which occurs twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    window = ids[:n]
    for k in range(1, width):  # numbers of longer windows from those of shorter ones: exact, and never above n squared
        window = np.unique(window * (int(ids.max()) + 1) + ids[k : k + n], return_inverse=True)[1]
    again = np.bincount(window)[window] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += again
    edge[width:] -= again
    return int(np.count_nonzero(np.cumsum(edge)))


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """(BASE, FEATURES) of one text in UTF-8."""
    text = text or b""
    words = text.split()  # bytes split at 20 and 09-0D
    if not words:
        return [0, 0, int(np.bincount(np.frombuffer(text, np.uint8), minlength=256)[_SYMBOLS].sum()), 0, 0], [0.0] * len(FEATURES)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    raw = np.frombuffer(text, np.uint8)
    each = np.bincount(raw, minlength=256)
    follow = int(each[0x80:0xC0].sum())  # bytes that continue a code point
    chars = len(raw) - follow - int(each[_SPACES].sum())
    symbols = int(each[_SYMBOLS].sum())
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    doubles = len(lines) - len(set(lines))
    repeats = repeated_words(ids)
    n, upper, lower = len(words), int(each[65:91].sum()), int(each[97:123].sum())
    base = [n, chars, symbols, doubles, repeats]
    return base, [
        float(np.log1p(n)), chars / n, symbols / n, doubles / len(lines), repeats / n, len(seen) / n, int(np.bincount(ids).max()) / n, int((ids[1:] == ids[:-1]).sum()) / n,
        upper / max(upper + lower, 1), int(each[48:58].sum()) / chars, int(each[_MARKS].sum()) / n, int(each[33]) / n, int(each[_ODD].sum()) / chars, n / len(lines), int(each[0xC0:].sum()) / chars,
    ]


class Trees:
    """Boosted complete trees of DEPTH levels under a logistic loss, as arrays of (tree, node)."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.sign = np.array([-1.0 if f in FALLING else 0.0 for f in FEATURES])
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        inner = (1 << DEPTH) - 1
        self.feature = np.zeros((TREES, inner), np.int16)
        self.threshold = np.full((TREES, inner), np.inf)
        self.value = np.zeros((TREES, 1 << DEPTH))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)  # bin b: above cut b - 1, up to cut b
        logit = np.full(len(y), self.start)
        for t in range(TREES):
            p = 1 / (1 + np.exp(-logit))
            logit += RATE * self._grow(t, bins, cuts, p - y, p * (1 - p))

    def _grow(self, t: int, bins: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Fill tree t; the value of each row."""
        at, bounds = np.zeros(len(g), np.int64), [(-np.inf, np.inf)]
        for level in range(DEPTH):
            below = []
            for node in range(1 << level):
                rows = np.flatnonzero(at == node)
                found = self._split(bins[rows], cuts, g[rows], h[rows], *bounds[node])
                low, high = bounds[node]
                if found is None:  # all rows go left
                    at[rows] = 2 * node
                    below += [(low, high), (low, high)]
                    continue
                feature, cut, left, right = found
                self.feature[t, (1 << level) - 1 + node], self.threshold[t, (1 << level) - 1 + node] = feature, cuts[feature][cut]
                at[rows] = 2 * node + (bins[rows, feature] > cut)
                middle = (left + right) / 2
                below += [(low, high), (low, high)] if not self.sign[feature] else [(middle, high), (low, middle)]
            bounds = below
        for leaf in range(1 << DEPTH):
            rows = at == leaf
            self.value[t, leaf] = np.clip(-g[rows].sum() / (h[rows].sum() + RIDGE), *bounds[leaf])
        return self.value[t, at]

    def _split(self, bins, cuts, g, h, low, high):
        """The best (feature, cut, value left, value right) that keeps the constraints, if any gains."""
        best, out = 1e-6, None
        weight = lambda a, b: np.clip(-a / (b + RIDGE), low, high)
        gain = lambda a, b, w: -(a * w + 0.5 * (b + RIDGE) * w * w)
        for f, c in enumerate(cuts):
            left_g = np.cumsum(np.bincount(bins[:, f], g, len(c) + 1))
            left_h = np.cumsum(np.bincount(bins[:, f], h, len(c) + 1))
            (all_g, all_h), left_g, left_h = (left_g[-1], left_h[-1]), left_g[:-1], left_h[:-1]
            a, b = weight(left_g, left_h), weight(all_g - left_g, all_h - left_h)
            won = gain(left_g, left_h, a) + gain(all_g - left_g, all_h - left_h, b) - gain(all_g, all_h, weight(all_g, all_h))
            won[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = -np.inf
            if self.sign[f]:
                won[b > a] = -np.inf
            if len(won) and won.max() > best:
                k = int(won.argmax())
                best, out = float(won[k]), (f, k, float(a[k]), float(b[k]))
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, all trees a level at a time."""
        tree, node = np.arange(TREES), np.zeros((len(x), TREES), np.int64)
        for level in range(DEPTH):
            k = (1 << level) - 1 + node
            node = 2 * node + (np.take_along_axis(x, self.feature[tree, k].astype(np.int64), 1) > self.threshold[tree, k])
        return 1 / (1 + np.exp(-(self.start + RATE * self.value[tree, node].sum(1))))


def _fold(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)), F.lit(-1))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees | float:
    """Trees learned from at most ``rows`` labelled ids outside the held-out fold; the share of label 1 without labels of both kinds."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) != 0)).groupBy(F.col("doc_id").alias("_d")).agg(F.max("quality").alias("_q"))
    chosen = known.orderBy(F.xxhash64("_d"), "_d").limit(rows)  # at most ``rows``: small enough to broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_d")).groupBy("_d").agg(F.min("text").alias("text"), F.first("_q").alias("_q"))

    def measured(batches):
        for b in batches:
            x = [np.asarray(statistics(t)[1]).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_q").cast(pa.float64()), pa.array(x, pa.binary())], names=["y", "x"])

    got = sorted(map(tuple, texts.select("_q", "text").mapInArrow(common.trimmed(measured), "y double, x binary").collect()))  # at most ``rows`` of 15 numbers
    y = np.array([g[0] for g in got])
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 1.0
    return Trees(np.stack([np.frombuffer(g[1]) for g in got]), y)


def judge(docs: DataFrame, model: Trees | float) -> DataFrame:
    """doc_id with the statistics of BASE, base_failed, kept and score of each row's text."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in BASE), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def judged(batches):
        for b in batches:
            got = [statistics(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
            base = np.array([g[0] for g in got], np.int64).reshape(-1, len(BASE))
            n, repeats = base[:, 0], base[:, 4]
            failed = (n < LEAST_WORDS) | (100 * repeats > 50 * n)
            if isinstance(model, Trees):
                score = model(np.array([g[1] for g in got]).reshape(-1, len(FEATURES)))
                kept = ~failed & (score >= THRESHOLD)
            else:
                score, kept = np.full(len(got), model), ~failed
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, base.T), pa.array(failed), pa.array(kept), pa.array(score)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(common.trimmed(judged), schema)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document."""
    return judge(docs, fit(docs, labels))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))
