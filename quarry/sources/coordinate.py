"""Intervals sorted by contig and position over many files, with an index by which a lookup reads few of them.

Files hold ranges of (contig, start).  The index has a row for each file, contig and bin of ``BIN`` positions in which
intervals of that file start, with how far they reach: a lookup takes the files whose bins begin before the asked range
ends and reach its start.  So long intervals are found from wherever they start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BIN = 1 << 14


def write_sorted(df: DataFrame, path: str, contig: str = "contig", start: str = "start", end: str = "end", files: int | None = None) -> None:
    """Rows in files by ranges of (contig, start), sorted, and the index; rows of one place may share a file with others."""
    by = [F.col(contig), F.col(start), F.col(end)]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows").select(F.col("_metadata.file_name").alias("file"), F.col(contig).alias("contig"), F.col(start).alias("first"), F.col(end).alias("reach"))
    index = rows.groupBy("file", "contig", F.floor(F.col("first") / BIN).alias("bin")).agg(F.min("first").alias("first"), F.max("reach").alias("reach"), F.count("*").alias("rows"))
    index.orderBy("contig", "bin", "file").write.parquet(f"{path}/index")


def files_of(spark: SparkSession, path: str, contig, first: int, last: int) -> list[str]:
    """Names of the files that hold an interval which meets [first, last]."""
    index = spark.read.parquet(f"{path}/index")
    hits = index.where(F.col("contig").eqNullSafe(F.lit(contig)) & (F.col("bin") <= last // BIN) & (F.col("first") <= last) & (F.col("reach") >= first))
    return sorted(r["file"] for r in hits.select("file").distinct().collect())  # names of files, by an index that is pruned to one contig


def lookup(spark: SparkSession, path: str, contig, first: int, last: int, names: tuple[str, str, str] = ("contig", "start", "end")) -> DataFrame:
    """Intervals of a contig that meet [first, last], in order; reads only files that hold some."""
    files = files_of(spark, path, contig, first, last)
    every = spark.read.parquet(f"{path}/rows")
    rows = spark.read.schema(every.schema).parquet(*[f"{path}/rows/{f}" for f in files]) if files else every.limit(0)
    c, s, e = names
    return rows.where(F.col(c).eqNullSafe(F.lit(contig)) & (F.col(s) <= last) & (F.col(e) >= first))


def lookups(spark: SparkSession, path: str, asked: DataFrame, names: tuple[str, str, str] = ("contig", "start", "end")) -> DataFrame:
    """Rows with the asked ranges (ask, contig, first, last) that they meet: by bins, as a join, for many ranges at once."""
    c, s, e = names
    rows = spark.read.parquet(f"{path}/rows")
    binned = lambda a, z: F.explode(F.sequence(F.floor(F.col(a) / BIN), F.floor(F.col(z) / BIN)))
    left = rows.withColumn("_bin", binned(s, e))
    right = asked.select("ask", F.col("contig").alias("_c"), F.col("first").alias("_f"), F.col("last").alias("_l")).withColumn("_b", binned("_f", "_l"))
    met = left.join(right, (F.col(c) == F.col("_c")) & (F.col("_bin") == F.col("_b")) & (F.col(s) <= F.col("_l")) & (F.col(e) >= F.col("_f")))
    once = F.col("_bin") == F.greatest(F.floor(F.col(s) / BIN), F.floor(F.col("_f") / BIN))  # a pair that shares several bins counts in the first
    return met.where(once).select("ask", *rows.columns)
