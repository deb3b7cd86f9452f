"""Tables that are published as a whole: readers see the last finished version, whatever a writer is doing.

A version is a folder of its own, written first.  Then an entry that names it, with its rows and columns, is added to the
log: one small table for each entry, which Spark commits in one step.  The entry of the highest number counts.  A writer
that dies leaves an unnamed folder and no entry.  A reset is an entry too; versions stay until ``clear`` drops those that
no entry names last.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTRY = "number long, folder string, rows long, columns string, at timestamp"


class NotPublished(LookupError):
    """There is no finished version, or it was reset."""


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        found = spark.read.schema(_ENTRY).parquet(f"{path}/log/*")
        return found if found.limit(1).count() else None
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def last(spark: SparkSession, path: str):
    """The entry that counts, or None."""
    log = _log(spark, path)
    return None if log is None else log.orderBy(F.desc("number"), F.desc("folder")).first()


def _enter(spark: SparkSession, path: str, number: int, folder: str | None, rows: int | None, columns: str | None) -> None:
    entry = spark.createDataFrame([(number, folder, rows, columns)], "number long, folder string, rows long, columns string").withColumn("at", F.current_timestamp())
    entry.coalesce(1).write.mode("errorifexists").parquet(f"{path}/log/{number:012d}")


def publish(df: DataFrame, path: str) -> int:
    """Write a version and name it; its number.  Two writers can't take one number: the later one fails."""
    spark, path = df.sparkSession, path.rstrip("/")
    before = last(spark, path)
    number, folder = (before["number"] if before else 0) + 1, f"{path}/versions/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    _enter(spark, path, number, folder.rsplit("/", 1)[-1], written.count(), df.schema.json())
    return number


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether a finished version counts, as a sentinel file would say."""
    entry = last(spark, path.rstrip("/"))
    return bool(entry and entry["folder"])


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The version that counts, or one by its number."""
    path = path.rstrip("/")
    log = _log(spark, path) if number is not None else None
    entry = last(spark, path) if number is None else log and log.where(F.col("number") == number).first()
    if not entry or not entry["folder"]:
        raise NotPublished(path)
    return spark.read.schema(T.StructType.fromJson(json.loads(entry["columns"]))).parquet(f"{path}/versions/{entry['folder']}")


def reset(spark: SparkSession, path: str) -> None:
    """From now on nothing is published, until the next version."""
    path = path.rstrip("/")
    entry = last(spark, path)
    if entry and entry["folder"]:
        _enter(spark, path, entry["number"] + 1, None, None, None)


def publish_once(make, spark: SparkSession, path: str) -> DataFrame:
    """The published table; made and published first where there is none."""
    if not is_done(spark, path):
        publish(make(), path)
    return read(spark, path)


def clear(spark: SparkSession, path: str) -> int:
    """Delete version folders that aren't the one that counts; how many.  For times without writers or readers."""
    path, entry = path.rstrip("/"), last(spark, path.rstrip("/"))
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in (fs.listStatus(at) if fs.exists(at) else []) if not (entry and s.getPath().getName() == entry["folder"])]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
