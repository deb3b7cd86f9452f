"""Expressions on sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_letters(seq: Column, letters: str) -> Column:
    up = F.upper(seq)
    return F.length(up) - F.length(F.translate(up, letters, ""))


def gc_percent(seq: Column) -> Column:
    """Null for an empty sequence."""
    n = F.length(seq)
    return F.when(n > 0, 100.0 * count_letters(seq, "GC") / n)


def fragment(seq: Column, start: Column, end: Column) -> Column:
    """seq[start:end], from 0."""
    return F.substring(seq, start + 1, end - start)


def cut_up(df: DataFrame, seq: str = "seq", size: int = 10_000) -> DataFrame:
    """Rows of (piece, start, end) for each sequence: pieces of size, the rest joined to the last one."""
    pieces = F.greatest(F.floor(F.length(seq) / F.lit(size)), F.lit(1)).cast("int")
    out = df.withColumn("_n", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    out = out.withColumn("start", F.col("piece") * size).withColumn("end", F.when(F.col("piece") == F.col("_n") - 1, F.length(seq)).otherwise((F.col("piece") + 1) * size))
    return out.withColumn(seq, fragment(F.col(seq), F.col("start"), F.col("end"))).drop("_n")


def merge_cut_up(assigned: DataFrame, contig: str = "contig", label: str = "bin") -> DataFrame:
    """The label of most pieces of a contig; ties: the least label."""
    counts = assigned.groupBy(contig, label).agg(F.count("*").alias("_n"))
    return counts.groupBy(contig).agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias(label))


def mutate(seq: Column, rate: Column, seed: int) -> Column:
    """Each letter is drawn anew from ACGT at the given rate, decided by hash; a quarter of the draws leave it as it was."""
    draw = lambda i, k: F.pmod(F.xxhash64(seq, i, F.lit(seed + k)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    drawn = lambda i: F.substring(F.lit("ACGT"), (F.floor(draw(i, 1) * 4) + 1).cast("int"), F.lit(1))
    return F.array_join(F.transform(F.split(seq, ""), lambda c, i: F.when(draw(i, 0) < rate, drawn(i)).otherwise(c)), "")


def bed(pieces: DataFrame, contig: str = "id") -> DataFrame:
    """(chrom, chromStart, chromEnd, name) of the pieces of cut_up."""
    return pieces.select(F.col(contig).cast("string").alias("chrom"), F.col("start").alias("chromStart"), F.col("end").alias("chromEnd"), F.concat_ws(".", F.col(contig).cast("string"), F.col("piece")).alias("name"))
