"""From raw documents to packed training sequences: five stages, each on what the one before kept.

A stage is (name, function); the function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents.

Nulls: a text that is null counts as empty and passes every stage; the packing
stage gives it a piece that holds the end token alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common, decontaminate, near_dedup, packing, quality, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs.select(*COLUMNS), common.table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays, the one of least doc_id.

    Of rows that agree in doc_id and text one stays, unless the text has no words.
    """
    groups = near_dedup.near_groups(docs, width=5, percent=80).where("n_shingles > 0")
    keys = groups.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.max("leader").alias("leader"), F.count("*").alias("n"))
    keys = common.materialise(keys, "keys")
    docs = docs.select(*COLUMNS)
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_h"))

    def these(rows: DataFrame) -> DataFrame:
        return common.broadcast_if_small(rows.select("_d", "_h"), rows.count(), 24)

    out = docs.join(these(keys.where("not leader")), same, "left_anti")
    repeated = keys.where("leader and n > 1")
    if repeated.limit(1).count() == 0:
        return out
    once = docs.join(these(repeated), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(these(repeated), same, "left_anti").unionByName(once)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 100-byte strings go; so do documents of which nothing else is left."""
    out = suffix_dedup.without_repeats(docs.select(*COLUMNS)).where("kept_text <> '' or coalesce(text, '') = ''")
    return out.select("doc_id", F.when(F.col("text").isNotNull(), F.col("kept_text")).alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which ten consecutive words of a benchmark item occur go."""
    return decontaminate.clean(docs.select(*COLUMNS), common.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifier, the sketches or the tokenizer; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"stage-{name}", tidy=True)
    return docs
