"""Statistics of sequence lengths per assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length thresholds of the size distribution.
THRESHOLDS = [0, 100, 250, 500, 1000, 2500, 5000, 10000, 15000, 20000, 25000, 30000, 35000, 40000, 45000, 50000, 75000, 100000, 125000, 150000, 200000, 250000, 500000]


def length_stats(df: DataFrame, group: str, length: str, tie: str) -> DataFrame:
    """Per group: contigs, total, least, largest, mean and median length, N50 and N90.

    Lengths are summed upwards.  N50 is the length at which half the total is reached; N90 the length at the first
    other row at which a tenth is; none: 0.  Equal lengths of a group are first counted together, so that the
    running sum has a row for each length and not for each sequence.
    """
    counted = df.groupBy(group, length).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(length)
    upwards, every = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(group)
    run = counted.withColumns({"upto": F.sum(F.col(length) * F.col("n")).over(upwards), "total": F.sum(F.col(length) * F.col("n")).over(every), "place": F.sum("n").over(upwards), "rows": F.sum("n").over(every)})
    before = F.col("upto") - F.col(length) * F.col("n")
    # how many of the rows of this length still lie below the share of the total: the next one reaches it
    reach = lambda share: F.greatest(F.ceil((share * F.col("total") - before) / F.greatest(F.col(length), F.lit(1))), F.lit(1))
    run = run.withColumn("at50", F.when(F.col("upto") >= 0.5 * F.col("total"), F.struct(F.col(length).alias("l"), reach(0.5).alias("k"))))
    run = run.withColumn("at10", F.when(F.col("upto") >= 0.1 * F.col("total"), F.struct(F.col(length).alias("l"), reach(0.1).alias("k"), F.col("n").alias("n"), F.lead(length).over(w).alias("next"))))
    middle = lambda place: F.min(F.when(F.col("place") >= place, F.col(length)))
    known = F.col(length).isNotNull()
    known_rows = F.sum(F.when(known, F.col("n")))
    out = run.withColumn("place", F.when(known, F.col("place") - F.coalesce(F.sum(F.when(~known, F.col("n"))).over(every), F.lit(0)))).withColumn("known", F.sum(F.when(known, F.col("n"))).over(every)).groupBy(group).agg(
        F.sum("n").alias("contigs"),
        F.sum(F.col(length) * F.col("n")).alias("total_size_bp"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        (F.sum(F.col(length) * F.col("n")) / known_rows).alias("avg_length"),
        ((middle(F.floor((F.col("known") + 1) / 2)) + middle(F.floor(F.col("known") / 2) + 1)) / 2.0).alias("median_length"),
        F.min("at50").alias("a"),
        F.min("at10").alias("b"),
    )
    # the row that sets N50 can't set N90: then the next row does, of this length or of the next
    same = (F.col("a.l") == F.col("b.l")) & (F.col("a.k") == F.col("b.k"))
    following = F.when(F.col("b.k") < F.col("b.n"), F.col("b.l")).otherwise(F.coalesce("b.next", F.lit(0)))
    return out.withColumns({"n50_length": F.coalesce("a.l", F.lit(0)), "n90_length": F.when(same, following).otherwise(F.coalesce("b.l", F.lit(0)))}).drop("a", "b")


def size_distribution(df: DataFrame, group: str, length: str, thresholds: list[int] = THRESHOLDS) -> DataFrame:
    """Per group and threshold: how many sequences are that long, their total and its share; thresholds without any are left out.

    Each sequence counts once, for the largest threshold that it reaches; sums run downwards over the thresholds.
    """
    steps = F.array(*[F.lit(t) for t in thresholds])
    level = F.array_max(F.filter(steps, lambda t: t <= F.col(length)))
    counted = df.withColumn("min_length", level).where("min_length is not null").groupBy(group, "min_length").agg(F.count("*").alias("n"), F.sum(length).alias("s"))
    totals = df.groupBy(group).agg(F.sum(length).alias("t")).withColumnRenamed(group, "_g")
    reached = counted.groupBy(group).agg(F.collect_list(F.struct("min_length", "n", "s")).alias("x"))
    rows = reached.select(group, "x", F.explode(steps).alias("min_length"))
    part = F.filter("x", lambda e: e.min_length >= F.col("min_length"))
    add = lambda f: F.aggregate(part, F.lit(0).cast("bigint"), lambda a, e: a + e[f])
    rows = rows.select(group, F.col("min_length"), add("n").alias("num_contigs"), add("s").alias("total_length")).where("num_contigs > 0")
    return rows.join(totals, F.col(group).eqNullSafe(F.col("_g"))).select(group, "min_length", "num_contigs", "total_length", (100.0 * F.col("total_length") / F.col("t")).alias("percent"))


def size_tier(size: Column, tiers: list[tuple[int, int]], above: int) -> Column:
    """The value of the first tier whose limit size does not pass; ``above`` beyond all of them, null for null."""
    out = F.when(size.isNull(), F.lit(None).cast("int"))
    for limit, value in tiers:
        out = out.when(size <= limit, F.lit(value))
    return out.otherwise(F.lit(above))
