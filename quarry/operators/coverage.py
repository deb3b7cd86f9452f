"""Depth of contigs under alignments, by sweeping over the places where depth changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.scan import Ordered, Running


def segments(alns: DataFrame, contig: str, start: str, end: str, limit: int | None = None) -> DataFrame:
    """(contig, first, last, depth): stretches of equal depth above 0, from closed intervals.

    An interval counts one up at its start and one down behind its end; steps at one place are added up before they are
    summed along the contig, so a contig costs its distinct places, and one that holds most of them is cut into pieces.
    """
    steps = alns.where(F.col(start) <= F.col(end)).select(F.col(contig).alias("contig"), F.inline(F.array(F.struct(F.col(start).cast("long").alias("first"), F.lit(1).cast("long").alias("step")), F.struct((F.col(end).cast("long") + 1).alias("first"), F.lit(-1).cast("long").alias("step")))))
    steps = steps.groupBy("contig", "first").agg(F.sum("step").alias("step")).where("step <> 0")
    swept = Ordered(steps, ["contig"], ["first"], limit).with_columns(depth=Running("sum", "step"), next=Running("lead", "first")).rows()
    return swept.where("depth > 0").select("contig", "first", (F.col("next.x") - 1).alias("last"), "depth")


def depths(alns: DataFrame, contigs: DataFrame, start: str = "start", end: str = "end", limit: int | None = None) -> DataFrame:
    """(contig, length, covered, most, mean, variance) of the depth at each position of contigs (contig, length).

    Alignments count as far as they lie in their contig; the variance is the sample variance over positions, null for a
    contig of one.  Contigs without alignments have depth 0; alignments of other contigs are left out.
    """
    inside = alns.join(contigs.select("contig", "length"), "contig").withColumns({"_a": F.greatest(F.col(start).cast("long"), F.lit(1).cast("long")), "_z": F.least(F.col(end).cast("long"), F.col("length").cast("long"))})
    runs = segments(inside, "contig", "_a", "_z", limit).withColumn("n", F.col("last") - F.col("first") + 1)
    sums = runs.groupBy("contig").agg(F.sum("n").alias("covered"), F.max("depth").alias("most"), F.sum(F.col("n") * F.col("depth")).alias("_s"), F.sum((F.col("n") * F.col("depth") * F.col("depth")).cast("decimal(38,0)")).alias("_q"))
    out = contigs.select("contig", F.col("length").cast("long").alias("length")).join(sums, "contig", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    n, s = F.col("length").cast("decimal(18,0)"), zero("_s").cast("decimal(18,0)")
    spread = (F.coalesce(F.col("_q"), F.lit(0)).cast("decimal(19,0)") * n - s * s).cast("double") / (n * (n - 1)).cast("double")
    return out.select("contig", "length", zero("covered").alias("covered"), zero("most").alias("most"), (zero("_s") / F.col("length")).alias("mean"), F.when(F.col("length") > 1, spread).alias("variance"))
