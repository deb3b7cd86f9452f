"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of ``WINDOW`` words (a shorter item is one
window).  A window is contained in a document only if all its shingles are, so
for exact containment one prefix token, the window's rarest shingle, is
necessary: shingles are ordered by how often the corpus holds them, and only the
rarest of each window is joined.  A hit fixes where the window would start;
positional bounds (start not before the text, end not after it) and the window's
length drop impossible starts, and the words of the remaining ones are compared.

Shingles have ``SHINGLE`` words, fewer in items that are shorter.  A null or
empty text, and one of no words, is never hit; an empty table gives an empty
result.  Every row is a document of its own, also where rows share a doc_id or
have none, and gives one row; equal windows of several items count for each.
Other columns, whatever their names, are ignored, and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

WINDOW = 10
SHINGLE = 5


def _grams(tokens: Column, size: Column | int) -> Column:
    """Hash of every run of ``size`` words, by position."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(
        F.size(tokens) >= size,
        F.transform(F.slice(tokens, F.lit(1), F.size(tokens) - size + 1), lambda _, i: F.xxhash64(F.slice(tokens, i + 1, size))),
    ).otherwise(F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, w, words): distinct windows of each item."""
    items = benchmark.select(F.col("item_id"), common.words(F.col("text")).alias("t")).where(F.size("t") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("t") - window + 1, F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("t", i, window))).alias("words")).distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text: rows are told apart by doc_id and text, whatever doc_id is (null too)."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def _shingle_hits(docs: DataFrame, grams: DataFrame, sizes: list[int], n_grams: int) -> DataFrame:
    """(doc_id, text_hash, at, gram, size): where documents hold the windows' shingles."""
    rows = docs.select("doc_id", "text_hash", common.words(F.col("text")).alias("t"))

    def placed(size: int) -> Column:
        return F.transform(_grams(F.col("t"), size), lambda h, i: F.struct(h.alias("gram"), i.alias("at"), F.lit(size).alias("size")))

    every = F.flatten(F.array(*[placed(k) for k in sizes]))
    found = rows.select("doc_id", "text_hash", F.explode(every).alias("g")).select("doc_id", "text_hash", "g.gram", "g.at", "g.size")
    return found.join(common.broadcast_if_small(grams, n_grams, 16), ["gram", "size"], "left_semi")


def _candidates(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """(_d, _h, c): where in which documents windows may start; documents without any are absent."""
    wins = windows(benchmark, window)
    kinds = wins.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")).withColumn("n", F.size("words"))
    kinds = common.materialise(kinds.withColumn("win", F.monotonically_increasing_id()), "windows")
    size = F.least(F.lit(shingle), F.col("n"))
    parts = kinds.select("win", size.alias("size"), F.posexplode(_grams(F.col("words"), size)).alias("off", "gram"))
    grams = common.materialise(parts.select("gram", "size").distinct(), "grams")
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # 1 to SHINGLE
    if not sizes:
        spot = "struct<s:int,n:int,words:array<string>,item_ids:array<bigint>>"
        return docs.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.array().cast(f"array<{spot}>").alias("c")).where(F.lit(False))
    hits = common.materialise(_shingle_hits(docs, grams, sizes, grams.count()), "hits")
    rarity = hits.groupBy("gram", "size").agg(F.count("*").alias("seen"))
    # a shingle that no document holds is the rarest of all: its windows have no hit, and none is needed
    ranked = parts.join(rarity, ["gram", "size"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    prefix = ranked.groupBy("win").agg(F.min(F.struct("seen", "gram", "off", "size")).alias("p")).where("p.seen > 0")
    prefix = prefix.select("win", "p.gram", "p.off", "p.size").join(kinds.select("win", "n", "words", "item_ids"), "win").drop("win")
    prefix = common.materialise(prefix, "prefix")
    small = common.broadcast_if_small(prefix, prefix.count(), 400)
    cands = hits.join(small, ["gram", "size"]).select("doc_id", "text_hash", (F.col("at") - F.col("off")).alias("s"), "n", "words", "item_ids").where("s >= 0")
    grouped = cands.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_set(F.struct("s", "n", "words", "item_ids")).alias("c"))
    return common.materialise(grouped, "candidates")


def _with_candidates(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates grow with the documents, so they are joined by shuffle at every size."""
    return rows.join(candidates.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")


def _occurring(tokens: Column, candidates: Column) -> Column:
    """The candidates whose words stand where they should."""
    return F.filter(candidates, lambda x: (x.s + x.n <= F.size(tokens)) & (F.slice(tokens, x.s + 1, x.n) == x.words))


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("end"))
    return F.aggregate(
        spans,
        start,
        lambda a, x: F.struct((a.sum + F.greatest(x.s + x.n - F.greatest(a.end, x.s), F.lit(0))).cast("bigint").alias("sum"), F.greatest(a.end, x.s + x.n).alias("end")),
        lambda a: a.sum,
    )


def located(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items."""
    rows = _rows(docs)
    found = _with_candidates(rows, _candidates(rows, benchmark, window, shingle))
    kept = common.let(
        common.words(F.col("text")),
        lambda t: F.struct(F.size(t).cast("long").alias("n"), F.when(F.col("c").isNotNull(), _occurring(t, F.col("c"))).alias("c")),
    )
    none = F.array()
    spans = F.coalesce(F.array_sort(F.transform("r.c", lambda x: F.struct(x.s.cast("int").alias("s"), x.n.cast("int").alias("n")))), none.cast("array<struct<s:int,n:int>>"))
    items = F.coalesce(F.array_sort(F.array_distinct(F.transform(F.flatten(F.col("r.c.item_ids")), lambda x: x.cast("string")))), none.cast("array<string>"))
    out = found.select("doc_id", kept.alias("r")).select("doc_id", F.col("r.n").alias("n_words"), spans.alias("spans"), items.alias("items"))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
        "items",
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return located(docs, benchmark, window).drop("spans", "items")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """docs without the documents in which a window of an item occurs; all columns of docs stay."""
    every = docs.columns
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*every).alias("_row"))
    found = _with_candidates(rows, _candidates(_rows(docs), benchmark, window, shingle))
    hit = common.let(common.words(F.col("_row.text")), lambda t: F.size(_occurring(t, F.col("c"))) > 0)
    return found.where(F.col("c").isNull() | ~hit).select("_row.*")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


OP4_SQL = """
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS t FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS t FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(t[i:i + 9], ' ') AS w, least(len(t), 10) AS n
  FROM (SELECT item_id, t, unnest(range(1, greatest(len(t) - 9, 1) + 1)) AS i FROM bw WHERE len(t) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, i, n, array_to_string(t[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM dw, sizes WHERE len(t) >= n)),
hit AS (SELECT g.doc_id, g.i, g.n, w.item_id FROM grams g JOIN win w ON g.w = w.w AND g.n = w.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(t) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
