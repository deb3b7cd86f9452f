"""Cutting lineage between the rounds of iterative operators, in storage that all executors share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame


def shared_dir(spark) -> str:
    """spark.checkpoint.dir, which a cluster must name; else a folder of this machine, for local sessions."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "/tmp/checkpoints/quarry"
    return path.rstrip("/")


def materialise(df: DataFrame, name: str = "table", options: dict[str, str] | None = None) -> DataFrame:
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_dir(spark)}/quarry-{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that materialise wrote and nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/quarry-" in folder:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def released(f):
    """f, a function of Arrow batches, that gives memory back when its task is done: Python workers stay."""

    def g(batches):
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return g


class Growing:
    """A table to which the rounds of an operator add; read as one scan, however many rounds there were."""

    def __init__(self, df: DataFrame, name: str = "table"):
        self.spark, self.schema, self.empty = df.sparkSession, df.schema, True
        self.path = f"{shared_dir(self.spark)}/quarry-{name}-{uuid.uuid4().hex}"

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)
        self.empty = False

    def table(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema) if self.empty else self.spark.read.schema(self.schema).parquet(self.path)


def moved(spark, folder: str, target: str, name) -> None:
    """Move the data files of a folder into another one, under name(file name)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, to = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(target)
    fs = source.getFileSystem(conf)
    fs.mkdirs(to)
    for s in fs.listStatus(source):
        file = s.getPath().getName()
        if not file.startswith(("_", ".")):
            fs.rename(s.getPath(), jvm.org.apache.hadoop.fs.Path(f"{target}/{name(file)}"))
