"""Joins of several tables, by key or by position."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import ordinal


def outer_reduce(frames: list[DataFrame], key: str) -> DataFrame:
    """Full outer join of all tables on one key, which comes first."""
    if not frames:
        raise ValueError("no tables")
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def column_bind(left: DataFrame, right: DataFrame, left_order: list[str | Column], right_order: list[str | Column]) -> DataFrame:
    """Rows side by side by their position in each order; the shorter table is filled with nulls, with a warning."""
    n, m = left.count(), right.count()
    if n != m:
        warnings.warn(f"column_bind: {n} and {m} rows")
    a, b = ordinal(left, left_order), ordinal(right, right_order, "_o")
    return a.join(b, F.col("ord") == F.col("_o"), "full").withColumn("ord", F.coalesce("ord", "_o")).drop("_o")


def in_list(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def not_in_list(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def admitted(seqs: DataFrame, min_length: int = 1, exclude: DataFrame | None = None, keep: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Sequences of at least min_length that are not excluded and, if there is a keep list, are on it."""
    out = seqs.where(F.col("length") >= min_length)
    out = out if exclude is None else not_in_list(out, exclude, key)
    return out if keep is None else in_list(out, keep, key)


def best_hit(queries: DataFrame, hits: DataFrame, key: str, score: str, ties: list[str], fields: list[str], defaults: dict[str, object]) -> DataFrame:
    """queries with the fields of their best hit (largest score, then ties upwards), or the defaults."""
    first = F.struct((-F.col(score)).alias("_s"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)], *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)])
    best = hits.groupBy(key).agg(F.min(first).alias("_b"))
    out = queries.join(best, key, "left")
    return out.select(*queries.columns, *[F.coalesce(F.col(f"_b._f{i}"), F.lit(defaults.get(f))).alias(f) for i, f in enumerate(fields)])


def looked_up(df: DataFrame, table: DataFrame, key: str, value: str, default: object) -> DataFrame:
    """A dictionary lookup with a default."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(name, rows, equal): how many rows each table has, and whether all have as many."""
    counted = [f.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, f in frames.items()]
    every = reduce(lambda a, b: a.unionByName(b), counted)  # a row for each table
    same = every.agg((F.min("rows") == F.max("rows")).alias("equal"))
    return every.join(same)
