"""Language-model scores: masked pseudo-likelihood under a bidirectional window network.

Tokens are words (lower case, by white space).  The corpus's ``FREQUENT`` most
frequent words have a class each, the others share ``SHARED`` classes by hash.
A shared class's words are told apart by their counts in the whole corpus:
log(count of word / count of class) is added for each of their tokens.  The
counts grow with the corpus: those of its ``KNOWN`` most frequent words go to
every task, and the tokens of all others are joined to theirs.

The network predicts each token from the ``REACH`` tokens on both of its sides:
position-wise embeddings, a tanh layer, and a softmax in two steps, over groups
of ``GROUP`` classes of like frequency and then over the classes of the group.
It is trained in numpy on all documents, every token learned from once: documents
are dealt by hash to blocks of about ``BLOCK`` tokens, a block takes stochastic
gradient steps over its documents in the order of doc_id, in each of ``ROUNDS``
rounds over the tokens of one place in ``ROUNDS``, all from the same start, and
parameters are averaged, weighted by tokens, level by level.  Blocks don't depend
on how rows are partitioned, so neither do scores.

A document's score is the sum of its tokens' conditional log-probabilities, each
token masked in turn.  Null, empty and white texts have no tokens, sum 0, no mean;
an empty table gives an empty result.  Every row is a document of its own, also
where rows share a doc_id or have none; equal texts score alike.  Word counts and
training cover every document, with no sample or cap.  Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

GROUP = 32
FREQUENT = 30 * GROUP
SHARED = 2 * GROUP
CLASSES = FREQUENT + SHARED
PAD = CLASSES
#: Words whose counts every task holds.
KNOWN = 50_000
REACH = 2
OFFSETS = (*range(-REACH, 0), *range(1, REACH + 1))
HIDDEN = 16
ROUNDS = 2
RATE = 0.3
#: A pass takes about STEPS gradient steps, each over at least LEAST_BATCH and at most BATCH tokens.
STEPS = 256
LEAST_BATCH = 512
BATCH = 1 << 13
#: Tokens that are scored in one product of matrices.
STEP = 1 << 14
#: Tokens of a training block, and of the documents that are scored at a time.
BLOCK = 1 << 22
SLICE = 1 << 19
#: Averages are formed of so many at a time, in as many levels as are needed; the driver adds up the last ones.
PARTS = 32
#: Log-probabilities of words are added up in whole numbers of 1 / UNIT.
UNIT = 1 << 30


def _counted(batches):
    for b in batches:
        seen: Counter = Counter()
        for text in b.column("text").to_pylist():
            seen.update((text or "").lower().split())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of all words."""
    counts = docs.select("text").mapInArrow(common.trimmed(_counted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return common.materialise(counts, "words")


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """The corpus's most frequent words, and how many of its tokens are of each class."""
    words, sizes, _ = _vocabulary(counted(docs) if counts is None else counts, FREQUENT)
    return words, sizes


def _class_of(word: str) -> int:
    return FREQUENT + zlib.crc32(word.encode()) % SHARED


def _vocabulary(counts: DataFrame, most: int) -> tuple[list[str], np.ndarray, dict[str, int]]:
    """Words of their own class, class sizes, and -log P(word | class) in units of the ``most`` most frequent others."""
    top = counts.orderBy(F.desc("n"), "word").limit(max(most, FREQUENT)).collect()  # at most KNOWN rows
    shared = counts.groupBy(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(SHARED)).alias("c")).agg(F.sum("n").alias("n")).collect()  # at most SHARED rows
    sizes = np.zeros(CLASSES)
    for r in shared:
        sizes[FREQUENT + r["c"]] = r["n"]
    for i, r in enumerate(top[:FREQUENT]):
        sizes[i] = r["n"]
        sizes[_class_of(r["word"])] -= r["n"]
    known = {r["word"]: round(float(np.log(sizes[_class_of(r["word"])] / r["n"])) * UNIT) for r in top[FREQUENT:]}
    return [r["word"] for r in top[:FREQUENT]], sizes, known


class Codes(dict):
    """word -> class, 1 << 16 for a word of a shared class whose count is not known, and -log P(word | class) above."""

    def __init__(self, words: list[str], known: dict[str, int]):
        super().__init__({w: i for i, w in enumerate(words)} | {w: _class_of(w) | units << 17 for w, units in known.items()})

    def __missing__(self, word: str) -> int:
        return _class_of(word) | 1 << 16  # not remembered: such words are rare

    def of(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


class Classes:
    """text -> class of each token."""

    def __init__(self, words: list[str]):
        self.codes = Codes(words, {})

    def of(self, text: str | None) -> np.ndarray:
        return (self.codes.of((text or "").lower().split()) & 0xFFFF).astype(np.int16)


def initial(sizes: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Random layers; the outputs' biases are the log shares of groups in the corpus and of classes in their group."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.3, (len(OFFSETS), CLASSES + 1, HIDDEN))
    n = (sizes + 1).reshape(-1, GROUP)
    total = n.sum(1)
    groups = len(total)
    p = [e, np.zeros(HIDDEN), rng.normal(0, 0.02, (HIDDEN, groups)), np.log(total / total.sum()), rng.normal(0, 0.02, (groups, HIDDEN, GROUP)), np.log(n / total[:, None])]
    return [x.astype(np.float32) for x in p]


def _hidden(p, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.repeat(p[1][None], len(at), 0)
    for k, off in enumerate(OFFSETS):
        h += p[0][k][flat[at + off]]
    return np.tanh(h)


def _softmax(z: np.ndarray) -> np.ndarray:
    """In place."""
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _by_group(classes: np.ndarray):
    """(group, rows of it) of each group that occurs."""
    group = (classes // GROUP).astype(np.int16)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
    return ((int(group[order[i]]), order[i:j]) for i, j in itertools.pairwise([*cuts, len(order)]))


def padded(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(all tokens with REACH pads around each document, where tokens stand)."""
    gap = np.full(REACH, PAD, np.int16)
    flat = np.concatenate([gap, *[x for c in classes for x in (c, gap)]]).astype(np.int16)
    return flat, np.flatnonzero(flat != PAD)


def _step(x: np.ndarray, memory: np.ndarray, gradient: np.ndarray, rate: float, rows=...) -> None:
    """A step of each parameter by its own past (memory: sums of squares)."""
    m = memory[rows] + gradient * gradient
    memory[rows] = m
    x[rows] -= rate * gradient / (np.sqrt(m) + 1e-6)


def train(p: list[np.ndarray], memory: list[np.ndarray], flat: np.ndarray, at: np.ndarray, rate: float = RATE) -> None:
    """One pass of gradient steps over the tokens at ``at``."""
    batch = min(BATCH, max(LEAST_BATCH, len(at) // STEPS))
    for k in range(0, len(at), batch):
        a = at[k : k + batch]
        y = flat[a]
        h = _hidden(p, flat, a)
        d = _softmax(h @ p[2] + p[3])
        d[np.arange(len(a)), y // GROUP] -= 1
        d /= len(a)
        dh = d @ p[2].T
        for g, rows in _by_group(y):
            near = h[rows]
            z = _softmax(near @ p[4][g] + p[5][g])
            z[np.arange(len(rows)), y[rows] % GROUP] -= 1
            z /= len(a)
            dh[rows] += z @ p[4][g].T
            _step(p[4], memory[4], near.T @ z, rate, g)
            _step(p[5], memory[5], z.sum(0), rate, g)
        dh *= 1 - h * h
        _step(p[1], memory[1], dh.sum(0), rate)
        _step(p[2], memory[2], h.T @ d, rate)
        _step(p[3], memory[3], d.sum(0), rate)
        for j, off in enumerate(OFFSETS):
            near = flat[a + off]
            order = np.argsort(near, kind="stable")
            near = near[order]
            new = np.flatnonzero(np.append(True, near[1:] != near[:-1]))
            _step(p[0][j], memory[0][j], np.add.reduceat(dh[order], new, axis=0), rate, near[new])


def log_probabilities(p: list[np.ndarray], flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(at))

    def said(z: np.ndarray, which: np.ndarray) -> np.ndarray:
        z -= z.max(1, keepdims=True)
        return z[np.arange(len(z)), which] - np.log(np.exp(z).sum(1))

    for k in range(0, len(at), STEP):
        a = at[k : k + STEP]
        y = flat[a]
        h = _hidden(p, flat, a)
        total = said(h @ p[2] + p[3], y // GROUP).astype(float)
        for g, rows in _by_group(y):
            total[rows] += said(h[rows] @ p[4][g] + p[5][g], y[rows] % GROUP)
        out[k : k + STEP] = total
    return out


def masked(classes: list[np.ndarray], r: int, rounds: int) -> np.ndarray:
    """Which of all documents' tokens round r learns from; each token has its one round, however rows are batched."""
    return np.concatenate([np.arange(len(c)) for c in classes]) % rounds == r


def _dump(p: list[np.ndarray], n: int) -> bytes:
    return (np.concatenate([x.ravel() for x in p]).astype(np.float64) * n).tobytes()


def _load(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, k = [], 0
    for x in like:
        out.append(flat[k : k + x.size].reshape(x.shape).astype(np.float32))
        k += x.size
    return out


def encoded(docs: DataFrame, words: list[str], known: dict[str, int] | None = None) -> DataFrame:
    """(row, doc_id, classes, inside, words, times), written once for all passes.

    classes has two bytes for each token; inside is what the words of ``known`` add; words are those of shared classes
    that are not known, with how often they occur.
    """

    def f(batches):
        codes = Codes(words, known or {})
        for b in batches:
            got, inside, said, times = [], [], [], []
            for t in b.column("text").to_pylist():
                tokens = (t or "").lower().split()
                code = codes.of(tokens)
                got.append((code & 0xFFFF).astype("<i2").tobytes())
                inside.append(-int((code >> 17).sum()))
                rare = Counter(tokens[i] for i in np.flatnonzero(code & 1 << 16).tolist())
                said.append(list(rare.keys()))
                times.append(list(rare.values()))
            cols = [pa.array(got, pa.binary()), pa.array(inside, pa.int64()), pa.array(said, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), *cols], names=["row", "doc_id", "classes", "inside", "words", "times"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return common.materialise(rows.mapInArrow(common.trimmed(f), "row long, doc_id long, classes binary, inside long, words array<string>, times array<long>"), "classes")


def word_terms(tokens: DataFrame, counts: DataFrame, sizes: np.ndarray) -> DataFrame:
    """(row, inside): sum of log P(word | class) over a row's tokens of shared classes, in units of 1 / UNIT."""
    size = F.get(F.array(*[F.lit(float(n)) for n in sizes[FREQUENT:]]), F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(SHARED)).cast("int"))
    # whole units add up the same in any order
    logs = counts.select("word", F.round(F.log(F.try_divide("n", size)) * UNIT).cast("long").alias("log"))
    said = tokens.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    rare = said.join(logs, "word").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("rare"))
    return tokens.select("row", "inside").join(rare, "row", "left").select("row", (F.col("inside") + F.coalesce("rare", F.lit(0))).alias("inside"))


def _decoded(column) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i2") for x in column.to_pylist()]


def summed(trained: DataFrame, blocks: int) -> DataFrame:
    """At most PARTS rows (block, n, p) with the sums of those of ``blocks`` blocks; no task adds up more than PARTS."""

    def add(rows: pa.Table) -> pa.Table:
        # in the order of blocks: sums of floats depend on it
        order = np.argsort(rows["block"].to_numpy())
        total = sum(np.frombuffer(rows["p"][int(i)].as_py()) for i in order)
        return pa.table({"block": [rows["part"][0].as_py()], "n": [sum(rows["n"].to_pylist())], "p": pa.array([total.tobytes()], pa.binary())})

    while blocks > PARTS:
        trained = trained.withColumn("part", F.floor(F.col("block") / PARTS)).groupBy("part").applyInArrow(add, "block long, n long, p binary")
        blocks = -(-blocks // PARTS)
    return trained


def fit(tokens: DataFrame, sizes: np.ndarray, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The network's layers; the same for the same documents, however they are partitioned."""
    params = initial(sizes)
    blocks = max(1, -(-int(sizes.sum()) // BLOCK))
    dealt = tokens.where(F.length("classes") > 0).select("doc_id", "classes", F.pmod(F.xxhash64("doc_id", F.crc32("classes")), F.lit(blocks)).alias("block"))

    def step(start, r):
        def f(rows: pa.Table) -> pa.Table:
            ids, got = rows["doc_id"].to_pylist(), rows["classes"].to_pylist()
            order = sorted(range(len(got)), key=lambda i: (ids[i] is None, ids[i] or 0, got[i]))
            classes = [np.frombuffer(got[i], "<i2") for i in order]
            flat, at = padded(classes)
            p, memory = [x.copy() for x in start], [np.full_like(x, 1e-6) for x in start]
            train(p, memory, flat, at[masked(classes, r, rounds)], RATE / (1 + r))
            return pa.table({"block": [rows["block"][0].as_py()], "n": [len(at)], "p": pa.array([_dump(p, len(at))], pa.binary())})

        return f

    for r in range(rounds):
        sums = sorted(summed(dealt.groupBy("block").applyInArrow(step(params, r), "block long, n long, p binary"), blocks).collect())  # at most PARTS rows
        if sums:
            params = _load(sum(np.frombuffer(s["p"]) for s in sums) / sum(s["n"] for s in sums), params)
    return params


def _some(got: list[np.ndarray]):
    """Documents, about SLICE tokens at a time."""
    i = 0
    while i < len(got):
        j, n = i, 0
        while j < len(got) and (j == i or n + len(got[j]) <= SLICE):
            n += len(got[j])
            j += 1
        yield got[i:j]
        i = j


def scores(tokens: DataFrame, params: list[np.ndarray], inside: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum), mean_log_likelihood of encoded documents; of classes alone without word_terms."""

    def f(batches):
        for b in batches:
            got = _decoded(b.column("classes"))
            sums = []
            for some in _some(got):
                flat, at = padded(some)
                run = np.concatenate([[0.0], np.cumsum(log_probabilities(params, flat, at))])
                end = np.cumsum([len(c) for c in some])
                sums.append(run[end] - run[end - [len(c) for c in some]])
            total = np.concatenate(sums) if sums else np.empty(0)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array([len(c) for c in got], pa.int64()), pa.array(total)], names=["row", "doc_id", "n_tokens", "log_likelihood"])

    rows = tokens.select("row", "doc_id", "classes").mapInArrow(common.trimmed(f), "row long, doc_id long, n_tokens long, log_likelihood double")
    if inside is not None:
        rows = rows.join(inside, "row").withColumn("log_likelihood", F.col("log_likelihood") + F.col("inside") / UNIT)
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return rows.select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))


def score_documents(docs: DataFrame) -> DataFrame:
    counts = counted(docs)
    words, sizes, known = _vocabulary(counts, KNOWN)
    tokens = encoded(docs, words, known)
    return scores(tokens, fit(tokens, sizes), word_terms(tokens, counts, sizes))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.documents(spark, sf_dir))
