"""Projections over columns chosen by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    kept = set(keep)
    return df.toDF(*[c if c in kept else prefix + c for c in df.columns])


def prefixed_unless(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Prefix only columns that don't have it yet."""
    kept = set(keep)
    return df.toDF(*[c if c in kept or c.startswith(prefix.rstrip("_")) else prefix + c for c in df.columns])


def affixed(frames: list[DataFrame], prefixes: list[str] | None, suffixes: list[str] | None) -> list[DataFrame]:
    """A prefix and a suffix for each frame; lists must be as long as frames."""
    for given in (prefixes, suffixes):
        if given is not None and len(given) != len(frames):
            raise ValueError(f"{len(given)} affixes for {len(frames)} tables")
    pre, suf = prefixes or [""] * len(frames), suffixes or [""] * len(frames)
    return [f.toDF(*[p + c + s for c in f.columns]) for f, p, s in zip(frames, pre, suf)]


def containing(df: DataFrame, part: str, key: Iterable[str] = ()) -> DataFrame:
    """key and the columns whose name holds part, in any case."""
    key = list(key)
    return df.select(*key, *[c for c in df.columns if c not in key and part.lower() in c.lower()])


def ending(df: DataFrame, suffix: str, key: Iterable[str] = ()) -> DataFrame:
    key = list(key)
    return df.select(*[F.col(f"`{c}`") for c in [*key, *[c for c in df.columns if c not in key and c.endswith(suffix)]]])


def without(df: DataFrame, part: str) -> DataFrame:
    """df without the columns whose name holds part, in any case."""
    return df.drop(*[c for c in df.columns if part.lower() in c.lower()])


def suffixed_key(df: DataFrame, key: str, suffix: str, out: str | None = None) -> DataFrame:
    """key_<suffix column's value>: keys of several samples stay apart."""
    return df.withColumn(out or key, F.concat_ws("_", key, suffix))


def with_origin(df: DataFrame, source: str, sample: str | None = None) -> DataFrame:
    """sample_id first (if given), source_file last."""
    return df.select(*([F.lit(sample).alias("sample_id")] if sample is not None else []), "*", F.lit(source).alias("source_file"))


def first_column(df: DataFrame) -> DataFrame:
    return df.select(df.columns[0])


def without_artefacts(df: DataFrame) -> DataFrame:
    """df without the row numbers that an earlier export left as a column."""
    return df.drop(*[c for c in df.columns if c in ("Unnamed: 0", "_c0", "")])
