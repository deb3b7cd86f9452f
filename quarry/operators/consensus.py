"""Consensus filter over the scores of two tools and a quality summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import keep_first
from quarry.storage import materialise

MAX_CONTAMINATION = 10
#: Warnings that exclude a sequence.
EXCLUDED_WARNINGS = [
    "no viral genes detected; low-confidence DTR",
    "no viral genes detected; low-confidence ITR",
    ">1 viral region detected; contig >1.5x longer than expected genome length",
    ">1 viral region detected",
    "high kmer_freq may indicate large duplication; contig >1.5x longer than expected genome length; low-confidence DTR",
    "high kmer_freq may indicate large duplication; contig >1.5x longer than expected genome length; low-confidence ITR",
    "no viral genes detected; contig >1.5x longer than expected genome length",
    "high kmer_freq may indicate large duplication; contig >1.5x longer than expected genome length",
    "no viral genes detected; high kmer_freq may indicate large duplication; low-confidence ITR",
    "high kmer_freq may indicate large duplication; low-confidence ITR",
    "contig >1.5x longer than expected genome length",
    ">1 viral region detected; low-confidence ITR",
    ">1 viral region detected; low-confidence DTR",
    "contig >1.5x longer than expected genome length; low-confidence Provirus",
    "no viral genes detected; high kmer_freq may indicate large duplication",
    "low-confidence Provirus",
]
#: Quality tiers that need rescue, and the scores that rescue by number of hallmark genes.
LOW_QUALITY = ["Not-determined", "Low-quality"]
RESCUE = [(0, 0, 0.99), (1, 5, 0.95), (6, None, 0.90)]
RESCUE_QUANTILE = 0.90


def score_length_filter(df: DataFrame, length: str, score: str, min_length: float = 1000, min_score: float = 0.7) -> DataFrame:
    return df.where((F.col(length) >= min_length) & (F.col(score) >= min_score))


def hit_score(score: Column, cutoff: float) -> Column:
    """1 above the cutoff, else 0."""
    return F.when(score > cutoff, 1).otherwise(0)


def vote_label(a: Column, b: Column, neither: str, both: str, only_a: str, only_b: str) -> Column:
    """Label by two votes; a null vote is no vote."""
    x, y = F.coalesce(a, F.lit(False)), F.coalesce(b, F.lit(False))
    return F.when(x & y, both).when(x, only_a).when(y, only_b).otherwise(neither)


def not_excluded(value: Column, excluded: list[str]) -> Column:
    """Not exactly one of the excluded values; null stays."""
    return F.coalesce(~value.isin(excluded), F.lit(True))


def uncontaminated(df: DataFrame, label: str, plain: str, contamination: str, most: float = MAX_CONTAMINATION) -> DataFrame:
    """Rows of other labels than plain, and plain ones of at most so much contamination (null: not kept)."""
    return df.where((F.col(label) != plain) | (F.col(contamination) <= most))


def exact_quantile(df: DataFrame, value: str, share: float, out: str = "cut") -> DataFrame:
    """One row: the quantile with linear interpolation, nulls left out; null for no values.

    Values are counted and range-partitioned; ranks are running counts inside a partition, behind what earlier
    partitions hold.  No task sees all values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    rows = materialise(counts.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()), "values")
    parts = rows.groupBy("_p").agg(F.sum("_n").alias("_m"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_p").alias("_q"), F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_b"), F.sum("_m").over(Window.partitionBy(F.lit(0))).alias("_all"))  # a row for each partition
    upto = F.sum("_n").over(Window.partitionBy("_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("_u", upto).join(F.broadcast(parts), F.col("_p") == F.col("_q")).withColumn("_u", F.col("_u") + F.col("_b"))
    at = (F.col("_all") - 1) * F.lit(float(share))
    value_at = lambda place: F.min(F.when(F.col("_u") > place, F.col("_v")))  # noqa: E731  ranks from 0
    low = placed.agg(value_at(F.floor(at)).alias("_l"), value_at(F.ceil(at)).alias("_h"), F.max(at - F.floor(at)).alias("_f"))
    return low.select((F.col("_l") * (1 - F.col("_f")) + F.col("_h") * F.col("_f")).alias(out))


def rescued(hallmarks: Column, score: Column, enrichment: Column, cut: Column, tiers=RESCUE) -> Column:
    by_tier = F.lit(False)
    for low, high, least in tiers:
        inside = hallmarks >= low if high is None else hallmarks.between(low, high)
        by_tier = by_tier | (inside & (score >= least))
    return F.coalesce(by_tier, F.lit(False)) | F.coalesce(enrichment >= cut, F.lit(False))


def consensus(df: DataFrame, key: str, order: list[str], columns: dict[str, str], plain: str = "Virus", excluded: list[str] = EXCLUDED_WARNINGS, low: list[str] = LOW_QUALITY, most: float = MAX_CONTAMINATION, tiers=RESCUE, share: float = RESCUE_QUANTILE) -> DataFrame:
    """Rows that pass: contamination, warnings, and quality or rescue; the first of each key, good quality before rescued.

    columns names: label, contamination, warnings, quality, hallmarks, score, enrichment.  The quantile of enrichment is
    over the rows that pass the contamination filter.
    """
    c = {k: F.col(v) for k, v in columns.items()}
    clean = uncontaminated(df, columns["label"], plain, columns["contamination"], most)
    cut = exact_quantile(clean, columns["enrichment"], share, "_cut")
    rows = clean.where(not_excluded(c["warnings"], excluded)).join(F.broadcast(cut))  # one row
    poor = F.coalesce(c["quality"].isin(low), F.lit(False))
    rows = rows.withColumn("_poor", poor).where(~F.col("_poor") | rescued(c["hallmarks"], c["score"], c["enrichment"], F.col("_cut"), tiers))
    return keep_first(rows, [key], ["_poor", *order]).drop("_cut", "_poor")


def by_label(df: DataFrame, label: str, plain: str = "Virus") -> tuple[DataFrame, DataFrame]:
    """(rows of the plain label, the others)."""
    return df.where(F.col(label) == plain), df.where(F.col(label) != plain)


def reported_hits(df: DataFrame, evalue: str, bits: str, most_evalue: float | None = 10.0, least_bits: float | None = None) -> DataFrame:
    """Hits that are reported: by bit score where that is given, else by E-value; nulls are not."""
    if least_bits is not None:
        return df.where(F.col(bits) >= least_bits)
    return df if most_evalue is None else df.where(F.col(evalue) <= most_evalue)


def annotated(df: DataFrame, column: str, none: str = "No hit") -> DataFrame:
    """Rows that have an annotation: neither null nor what stands for none."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != none))
