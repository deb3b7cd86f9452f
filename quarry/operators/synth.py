"""Seeded synthetic contigs with known clusters.

Every value follows from the row number and the seed, so the table is the same whatever its partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.sequences import mutate


def uniform(seed: int, salt: str, *keys: Column) -> Column:
    """In [0, 1), from the keys."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def mock_contigs(spark: SparkSession, n: int, seed: int = 42, virus: float = 0.5, prokaryote: float = 0.3, mean_log: float = 7.0, sd_log: float = 0.5, least: int = 200, most: int = 20_000, strains: float = 0.2, rate: float = 0.02, duplicates: float = 0.1) -> DataFrame:
    """sequence_id, true_cluster, source_category, length, strain_mutated, mutation_rate, duplication_copy, is_synthetic, seq.

    Shares of categories sum to 1 with eukaryotes as the rest.  Of each original, a share has a mutated strain in the same
    cluster and a share an exact copy; lengths are lognormal, cut to [least, most].
    """
    base = spark.range(n).withColumn("u", uniform(seed, "category", F.col("id")))
    base = base.withColumn("source_category", F.when(F.col("u") < virus, "virus").when(F.col("u") < virus + prokaryote, "prokaryote").otherwise("eukaryote"))
    normal = F.sqrt(-2 * F.log(1 - uniform(seed, "a", F.col("id")))) * F.cos(6.283185307179586 * uniform(seed, "b", F.col("id")))
    base = base.withColumn("length", F.least(F.lit(most), F.greatest(F.lit(least), F.exp(mean_log + sd_log * normal).cast("int"))))
    letter = lambda i: F.substring(F.lit("ACGT"), (F.pmod(F.xxhash64(F.col("id"), i, F.lit(seed)), F.lit(4)) + 1).cast("int"), F.lit(1))
    base = base.withColumn("seq", F.array_join(F.transform(F.sequence(F.lit(1), F.col("length")), letter), ""))
    kinds = F.array(
        F.struct(F.lit("o").alias("kind"), F.lit(True).alias("yes")),
        F.struct(F.lit("s").alias("kind"), (uniform(seed, "strain", F.col("id")) < strains).alias("yes")),
        F.struct(F.lit("d").alias("kind"), (uniform(seed, "copy", F.col("id")) < duplicates).alias("yes")),
    )
    rows = base.withColumn("k", F.explode(F.filter(kinds, lambda x: x.yes)))
    kind = F.col("k.kind")
    return rows.select(
        F.format_string("mock_%09d_%s", F.col("id"), kind).alias("sequence_id"),
        F.format_string("cluster_%09d", F.col("id")).alias("true_cluster"),
        "source_category",
        F.col("length").cast("long").alias("length"),
        F.when(kind == "s", "Yes").otherwise("No").alias("strain_mutated"),
        F.when(kind == "s", F.lit(str(rate))).otherwise("NA").alias("mutation_rate"),
        F.when(kind == "d", 1).otherwise(0).alias("duplication_copy"),
        F.lit("Yes").alias("is_synthetic"),
        F.when(kind == "s", mutate(F.col("seq"), F.lit(rate), seed)).otherwise(F.col("seq")).alias("seq"),
    )
