"""Abundance and functional profiles in long form: (feature, sample, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNGROUPED = "UNGROUPED"
#: Features that pass a regrouping as they are.
PROTECTED = ["UNMAPPED", "UNINTEGRATED", "UNGROUPED"]
SEPARATOR = "|"


def _over(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("_k")).agg(F.sum(value).alias("_t"))


def per_million(df: DataFrame, sample: str, value: str, out: str = "cpm") -> DataFrame:
    """Values scaled to a million in each sample; null where a sample's total is 0.

    Totals are aggregated and joined back, so that a large sample is not gathered for a window.
    """
    t = _over(df, sample, value)
    scaled = F.when(F.col("_t") != 0, 1e6 * F.col(value) / F.col("_t"))
    return df.join(t, F.col(sample).eqNullSafe(F.col("_k"))).withColumn(out, scaled).drop("_k", "_t")


def abundance(df: DataFrame, sample: str, reads: str, length: str) -> DataFrame:
    """rpkm and tpm of counted reads."""
    rate = df.withColumn("_x", F.col(reads) / F.col(length))
    t = rate.groupBy(F.col(sample).alias("_k")).agg(F.sum(reads).alias("_n"), F.sum("_x").alias("_s"))
    out = rate.join(t, F.col(sample).eqNullSafe(F.col("_k")))
    return out.withColumn("rpkm", F.col(reads) / (F.col(length) / 1e3) / (F.col("_n") / 1e6)).withColumn("tpm", 1e6 * F.col("_x") / F.col("_s")).drop("_k", "_x", "_n", "_s")


def regrouped(df: DataFrame, groups: DataFrame, feature: str, sample: str, value: str) -> DataFrame:
    """Values summed by group (groups: feature, group; a feature may have several); unknown ones go to UNGROUPED."""
    g = groups.select(F.col("feature").alias("_f"), F.col("group").alias("_g"))
    out = df.join(g, F.col(feature) == F.col("_f"), "left")
    name = F.when(F.col(feature).isin(PROTECTED), F.col(feature)).otherwise(F.coalesce("_g", F.lit(UNGROUPED)))
    return out.select(name.alias("group"), sample, value).groupBy("group", sample).agg(F.sum(value).alias(value))


def renamed(df: DataFrame, names: DataFrame, feature: str) -> DataFrame:
    """feature: name, where it has a name."""
    n = names.select(F.col("id").alias("_i"), F.col("name").alias("_n"))
    return df.join(n, F.col(feature) == F.col("_i"), "left").withColumn(feature, F.when(F.col("_n").isNotNull(), F.concat(F.col(feature), F.lit(": "), F.col("_n"))).otherwise(F.col(feature))).drop("_i", "_n")


def stratified(df: DataFrame, feature: str) -> tuple[DataFrame, DataFrame]:
    """(stratified rows, community rows)."""
    has = F.col(feature).contains(SEPARATOR)
    return df.where(has), df.where(~has)


def wide(df: DataFrame, feature: str, sample: str, value: str, samples: list[str]) -> DataFrame:
    """A row per feature and a column per sample; missing values are 0."""
    return df.groupBy(feature).pivot(sample, samples).agg(F.sum(value)).na.fill(0, samples)


def merged(tables: dict[str, DataFrame], feature: str, value: str) -> DataFrame:
    """Tables of single samples side by side, by feature."""
    from functools import reduce

    long = reduce(lambda a, b: a.unionByName(b), [t.select(feature, F.lit(s).alias("sample"), value) for s, t in tables.items()])
    return wide(long, feature, "sample", value, list(tables))


def column_blocks(long: DataFrame, feature: str, sample: str, value: str, samples: DataFrame, per_block: int = 500) -> DataFrame:
    """(feature, block, values): an array of ``per_block`` samples' values in each row, 0 where there is none.

    samples: (sample, place) with places from 0.  For more samples than a table should have columns: the plan stays the
    same for any number of them.
    """
    at = samples.select(F.col(sample).alias("_s"), F.col("place").alias("_at"))
    rows = long.join(at, F.col(sample) == F.col("_s")).groupBy(feature, F.col("_at").alias("_at")).agg(F.sum(value).cast("double").alias("_v"))
    held = rows.groupBy(feature, F.floor(F.col("_at") / per_block).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("_at", F.lit(per_block)).cast("int"), "_v"))).alias("_m"))  # at most per_block entries
    return held.select(feature, "block", F.transform(F.sequence(F.lit(0), F.lit(per_block - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(0.0))).alias("values"))
