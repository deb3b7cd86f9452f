"""Row order: ordinals, first rows, adjacent rows, runs, top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.scan import Ordered, Running
from quarry.storage import materialise


def ordinal(df: DataFrame, order: list[str | Column], out: str = "ord") -> DataFrame:
    """Numbers from 1 in the given order, without gathering the rows in one task.

    Rows are range-partitioned and numbered inside their partition; only the partitions' counts are added up in order.
    """
    ranged = df.repartitionByRange(*[F.col(c) if isinstance(c, str) else c for c in order]).withColumn("_p", F.spark_partition_id())
    rows = materialise(ranged, "ranged")
    inside = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    counts = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select(F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return inside.join(before, F.col("_p") == F.col("_q")).withColumn(out, F.col("_b") + F.col("_i")).drop("_p", "_q", "_b", "_i")


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_k(df: DataFrame, keys: list[str], order: list[str | Column], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each key, numbered; k = 0: all."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn(out, F.row_number().over(w))
    return rows.where(F.col(out) <= k) if k else rows


def with_runs(df: DataFrame, group: list[str], order: list[str | Column], value: str, out: str = "run", limit: int | None = None) -> DataFrame:
    """Number of the run of equal adjacent values, from 1 in each group; nulls are equal."""
    rows = Ordered(df, group, order, limit).with_columns(_before=Running("lag", value))
    return rows.with_columns(**{out: Running("sum", _starts("_before", value).cast("long"))}).rows().drop("_before")


def _starts(neighbour: str, value: str) -> Column:
    """The neighbour is another value, or there is none."""
    return F.col(neighbour).isNull() | ~F.col(neighbour)["x"].eqNullSafe(F.col(value))


def adjacent_distinct(df: DataFrame, group: list[str], order: list[str | Column], value: str, limit: int | None = None) -> DataFrame:
    """The first row of each run."""
    return Ordered(df, group, order, limit).with_columns(_before=Running("lag", value)).where(_starts("_before", value)).rows().drop("_before")


def adjacent_single(df: DataFrame, group: list[str], order: list[str | Column], value: str, limit: int | None = None) -> DataFrame:
    """Rows whose neighbours both have another value."""
    rows = Ordered(df, group, order, limit).with_columns(_before=Running("lag", value), _after=Running("lead", value))
    return rows.where(_starts("_before", value) & _starts("_after", value)).rows().drop("_before", "_after")


def counter(df: DataFrame, group: list[str], order: list[str | Column], starts: Column, out: str, limit: int | None = None) -> DataFrame:
    """A number that grows by one at each row for which starts holds."""
    return Ordered(df, group, order, limit).with_columns(**{out: Running("sum", F.when(starts, 1).otherwise(0))}).rows()


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def head(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)


def batches(df: DataFrame, order: list[str | Column], size: int = 500, out: str = "batch") -> DataFrame:
    """Rows in batches of ``size`` in the given order, numbered from 0."""
    return ordinal(df, order, "_ord").withColumn(out, F.floor((F.col("_ord") - 1) / size)).drop("_ord")


def renumbered(df: DataFrame, chunk: str, order: list[str | Column], starts: Column, per_chunk: int, out: str, limit: int | None = None) -> DataFrame:
    """Numbers over chunks that were numbered apart: a counter inside each chunk (from 0), behind chunk * per_chunk."""
    return counter(df, [chunk], order, starts, out, limit).withColumn(out, F.col(chunk) * per_chunk + F.col(out))
