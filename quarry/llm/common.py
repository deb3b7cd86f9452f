"""Helpers shared by the document operators: shared storage, size checks, text normalisation."""

from __future__ import annotations

import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side is broadcast; larger sides take the shuffle path.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, set up for checkpoint() too."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "/tmp/checkpoints/quarry"  # a single machine, as in tests
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back; cuts lineage, survives lost executors.

    tidy: let the shuffle files of the finished job go at once, where they are large.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    if tidy:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()  # they go only when the driver collects its garbage
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that materialise wrote and nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/quarry-" in folder:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast only when the counted rows prove it small; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and rows * row_bytes <= BROADCAST_BYTES else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null stays null."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: What separates words of letters, digits and non-ASCII characters, after lower_ascii.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), NOT_WORD), "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also inside higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw, at


def trim() -> None:
    """Give memory that is free back to the system: Python workers stay when a task is done."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(f):
    """f, a function of Arrow batches, that trims when its task is done."""

    def g(batches):
        yield from f(batches)
        trim()

    return g
