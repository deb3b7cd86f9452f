"""Phrase collocations: counts of all phrases of up to five words, scored against their parts.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and pieces
into words at spaces and tabs.  Phrases of 1 to ``MOST`` words are exploded into rows
(lang, size, phrase, count), combined inside each task first, and added up by a hash
aggregate per language.  A phrase counts as a candidate from ``LEAST`` occurrences on,
and then all its parts do.  So phrases go by length: those of two words are exploded
where both words are frequent, longer ones where all their pairs are.  Tasks know what is
frequent from a bit array of at most ``FILTER_BITS`` bits, filled by hashes: it lets all
frequent ones pass and now and then others, whose exact counts drop them later.  When the
array is too full to help, more rows are shuffled; results stay the same.

Counts of a phrase's first and last words are joined for every cut; the score is a
Decimal quotient, floored, and the cut of the lowest score counts (ties: the smallest).
A candidate goes where a one-word extension occurs as often (anti-join): a longer one
that holds it and occurs as often implies such an extension.  Ranks are taken in two
steps, so that no task sorts a whole language.

Nulls: a null text is empty, a null lang is ``und``.  Repeated rows count each.  Scores
and counts that tie are ranked by phrase in UTF-8 byte order, so ranks have no ties.
Empty tables and texts without words give no rows.  Other columns are not read.  A text
is taken whole; tasks hold ``CHUNK`` bytes of text, or one longer text, at a time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm import anchors, common

MOST = 5
LEAST = 100
TOP = 2000
CHUNK = 4 << 20
FILTER_BITS = 1 << 28
SALTS = 64
_SCHEMA = "lang string, phrase string, f long"
_U = np.uint64

_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[np.frombuffer(b" \t", np.uint8)] = 1
_KIND[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some texts: exact numbers, and which neighbours share a piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        raw, at = common.text_bytes(texts)
        raw, at = raw[at[0] : at[-1]], at - at[0]
        kind = _KIND[raw]
        inside = kind == 0
        edge = np.zeros(len(raw) + 1, bool)  # where a text begins
        edge[at] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        starts = np.flatnonzero(start).astype(np.int32)
        piece = np.cumsum((kind == 2) | edge[:-1], dtype=np.int32)[starts]
        self.joined = piece[1:] == piece[:-1]  # word i and i + 1 stand in one piece
        offsets = np.zeros(len(starts) + 1, np.int64)
        upto = np.cumsum(inside, dtype=np.int32)  # word bytes up to each place
        offsets[:-1] = upto[starts] - 1
        offsets[-1] = upto[-1] if len(raw) else 0
        spelt = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside]]))
        coded = spelt.dictionary_encode()
        self.spelt, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        names = langs.dictionary_encode()
        self.langs = names.dictionary
        row = np.searchsorted(at, starts, side="right") - 1
        self.lang = names.indices.to_numpy()[row].astype(np.int64)
        data, ends = common.text_bytes(self.spelt)
        data, ends = data[ends[0] : ends[-1]], ends - ends[0]
        each = anchors.of_slices(anchors.prefix(data), ends[:-1], ends[1:])
        seed = np.array([zlib.crc32(x.encode()) for x in self.langs.to_pylist()], _U)
        self.hash = (each[self.word] if len(each) else np.empty(0, _U)) ^ (anchors.mix(seed)[self.lang] if len(seed) else np.empty(0, _U))

    def hashes(self, size: int) -> np.ndarray:
        """Of the one or two words from each place on."""
        return self.hash if size == 1 else anchors.mix(self.hash[:-1] * _U(anchors.BASE) + self.hash[1:])

    def rows(self, size: int, first: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        parts = [self.spelt.take(pa.array(self.word[first + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
        lang = self.langs.take(pa.array(self.lang[first]))
        return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "f"])

    def totals(self) -> pa.RecordBatch:
        counts = np.bincount(self.lang, minlength=len(self.langs)).astype(np.int64)
        return pa.RecordBatch.from_arrays([self.langs.cast(pa.string()), pa.array([""] * len(counts), pa.string()), pa.array(counts)], names=["lang", "phrase", "f"])


def _chunks(batches):
    """Words of up to CHUNK bytes of text at a time."""
    for b in batches:
        size = pc.binary_length(b.column("text").cast(pa.large_binary())).to_numpy(zero_copy_only=False)
        chunk = (np.cumsum(size) - size) // CHUNK
        cuts = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
        for a, z in zip(cuts[:-1], cuts[1:]):
            yield Words(b.column("text").slice(a, z - a), b.column("lang").slice(a, z - a))


def counted(texts: DataFrame, sizes: tuple[int, ...], known: int = 0, bits=None) -> DataFrame:
    """(lang, size, phrase, f) of phrases of these sizes; with bits, of those whose every ``known`` words pass them.

    Size 0, the empty phrase, stands for all words of a language.  Sizes follow from phrases, and are not shuffled.
    """

    def grams(batches):
        passes = np.frombuffer(bits.value, np.uint8) if bits is not None else None
        for w in _chunks(batches):
            if not len(w.word):
                continue
            if 0 in sizes:
                yield w.totals()
            go = np.ones(len(w.word), bool)
            if passes is not None:
                at = w.hashes(known) & _U(len(passes) * 8 - 1)
                go = (passes[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1
            first = np.flatnonzero(go) if known < 2 else np.arange(len(w.word))
            gram = w.word[first] * len(w.langs) + w.lang[first]
            for size in range(1, max(sizes) + 1):
                if size > 1:  # phrases of one word more, where the next word still belongs to the piece
                    last = first + size - 1
                    on = last < len(w.word)
                    on[on] = w.joined[last[on] - 1] & (go[last[on]] if known < 2 else go[last[on] - 1])
                    first, gram = first[on], gram[on] * len(w.spelt) + w.word[last[on]]
                _, at, gram, n = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
                if size in sizes and len(at):
                    yield w.rows(size, first[at], n)

    counts = texts.mapInArrow(common.trimmed(grams), _SCHEMA).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    size = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1)
    return counts.select("lang", size.cast("int").alias("size"), "phrase", "f")


def _bits(frequent: DataFrame, size: int):
    """A bit array, as a broadcast of bounded size, that holds the hashes of these phrases of ``size`` words."""
    spark, rows = frequent.sparkSession, frequent.count()
    bits = min(FILTER_BITS, max(1 << 15, 1 << (16 * rows).bit_length()))

    def places(batches):
        for w in _chunks(batches):
            if len(w.word) >= size:
                at = w.hashes(size)[::size]  # each phrase has ``size`` words
                yield pa.RecordBatch.from_arrays([pa.array((at & _U(bits - 1)).astype(np.int64) + 1)], names=["p"])

    got = frequent.select("lang", F.col("phrase").alias("text")).mapInArrow(common.trimmed(places), "p long")
    got = got.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b"))
    out = bytearray(bits // 8)
    for r in got.collect():  # at most FILTER_BITS in all
        at = (r["k"] - 1) * 4096
        out[at : at + 4096] = r["b"]
    return spark.sparkContext.broadcast(bytes(out))


def phrases(docs: DataFrame, most: int = MOST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(phrases of up to ``most`` words that occur ``least`` times or more, words of each language)."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = common.materialise(counted(texts, (0, 1)).where((F.col("size") == 0) | (F.col("f") >= least)), "words")
    totals, out = words.where("size = 0").select("lang", F.col("f").alias("n")), words.where("size = 1")
    if most > 1:
        pairs = common.materialise(counted(texts, (2,), 1, _bits(out, 1)).where(F.col("f") >= least), "pairs")
        out = out.unionByName(pairs)
        if most > 2:
            longer = counted(texts, tuple(range(3, most + 1)), 2, _bits(pairs, 2)).where(F.col("f") >= least)
            out = out.unionByName(common.materialise(longer, "phrases"))
    return out, totals


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    found, totals = phrases(docs, most, least)
    rows = found.count()
    space, whole = F.lit(" "), F.col("size")
    candidates = found.where("size > 1").withColumnRenamed("f", "a")
    cut = lambda n: F.call_function("substring_index", F.col("phrase"), space, n)  # noqa: E731  the first n words, or with n < 0 the last
    longer = candidates.where("size > 2").select("lang", "a", F.explode(F.array(cut(whole - 1), cut(1 - whole))).alias("phrase")).distinct()
    kept = candidates.join(longer, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), whole - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", cut(F.col("k")).alias("first"), cut(F.col("k") - whole).alias("rest"))
    for name, f in (("first", "l"), ("rest", "r")):
        counts = found.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
        cuts = cuts.join(common.broadcast_if_small(counts, rows, 80), ["lang", name])
    cuts = cuts.join(totals, "lang")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("_x", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("_y", exact("l") * exact("r"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("_x div _y").alias("score"), "k", "l", "r")).alias("m"))
    best = best.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top).drop("rank")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.documents(spark, sf_dir))


OP11_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, s AS size, unnest(list_transform(generate_series(1, len(ws) - s + 1), lambda i: array_to_string(ws[i:i + s - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(generate_series(1, 5)) AS s)),
t AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM t WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, f AS a FROM t WHERE size > 1 AND f >= 100),
x AS (
  SELECT DISTINCT lang, unnest([array_to_string(ws[:size - 1], ' '), array_to_string(ws[2:], ' ')]) AS phrase, a FROM c WHERE size > 2),
k AS (SELECT c.* FROM c ANTI JOIN x USING (lang, phrase, a)),
cut AS (SELECT lang, phrase, a, i, array_to_string(ws[:i], ' ') AS first, array_to_string(ws[i + 1:], ' ') AS rest FROM (SELECT *, unnest(generate_series(1, size - 1)) AS i FROM k)),
s AS (
  SELECT cut.lang, cut.phrase, a, i, b.f AS l, e.f AS r, n, ((1000 * a::HUGEINT * n) // (b.f::HUGEINT * e.f))::BIGINT AS score
  FROM cut JOIN t b ON b.lang = cut.lang AND b.phrase = cut.first JOIN t e ON e.lang = cut.lang AND e.phrase = cut.rest JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score
FROM best QUALIFY rank <= 2000
"""
