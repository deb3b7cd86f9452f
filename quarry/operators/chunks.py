"""Work on chunks of about equal bytes, each kept once it is done, and gathered in the rows' order.

Rows are numbered and cut where the running sum of their sizes passes a share of the whole, so that chunks are balanced by
size and follow the order.  A run calls a function on every chunk that has no result yet; a chunk whose call fails leaves
its error and no rows, and the others are kept.  Running again does what is missing.  The results of a run are one table,
committed in one step, and the manifest says which of them holds a chunk; a chunk done twice counts once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.scan import Ordered, Running


class Incomplete(RuntimeError):
    """Chunks without a result, and why."""


def by_size(df: DataFrame, order: list[str], size: str, chunks: int) -> DataFrame:
    """df with place (from 1) and chunk (from 0): at most ``chunks``, each of about as much of the sizes' sum.

    Only the order's columns, the sizes and a hash of each row are put in order, and joined back.  Rows that the order
    doesn't tell apart follow their sizes and hashes; each gets a place of its own.
    """
    told = df.withColumns({"_key": F.struct(*order), "_size": F.coalesce(F.col(size), F.lit(0)).cast("long"), "_hash": F.xxhash64(*df.columns)})
    keys = told.select("_key", "_size", "_hash")
    by = [*[F.col("_key")[c].asc_nulls_last() for c in order], F.col("_size"), F.col("_hash")]  # missing keys last, as in SQL
    rows = Ordered(keys, [], by, limit=0).with_columns(place=Running("count"), _upto=Running("sum", "_size")).rows()
    total = keys.agg(F.greatest(F.coalesce(F.sum("_size"), F.lit(0)), F.lit(1)).alias("_all"))  # one row
    middle = F.col("_upto") - F.col("_size") / 2  # a row belongs where its middle lies
    placed = rows.join(F.broadcast(total)).withColumn("chunk", F.least(F.lit(chunks - 1), F.floor(middle * chunks / F.col("_all"))).cast("int"))
    placed = placed.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("place", "chunk"))).alias("_places"))
    told = told.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy("_size", "_hash")))
    return told.join(placed, "_key").select(*df.columns, F.col("_places")[F.col("_nth") - 1].alias("_at")).select(*df.columns, "_at.place", "_at.chunk")


def _results(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("recursiveFileLookup", True).parquet(f"{path}/runs")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """(chunk, run, done, error, rows): for each chunk the first run that did it, else its last error."""
    found = _results(spark, path)
    if found is None:
        return None
    ends = found.where("place < 0").select("chunk", "run", "done", "error", "rows", "at")
    return ends.groupBy("chunk").agg(F.min(F.struct((~F.col("done")).alias("o"), F.when(F.col("done"), F.unix_micros("at")).otherwise(-F.unix_micros("at")).alias("t"), "run", "done", "error", "rows")).alias("m")).select("chunk", "m.run", "m.done", "m.error", "m.rows")


def run(chunked: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], gives: T.StructType, path: str) -> DataFrame:
    """call on each chunk's rows, in their order, that has no result yet; the manifest.  A chunk is one task's memory."""
    spark, names = chunked.sparkSession, gives.names
    before = manifest(spark, path)
    rows = chunked if before is None else chunked.join(F.broadcast(before.where("done").select("chunk")), "chunk", "left_anti")  # a row for each chunk
    this = uuid.uuid4().hex
    schema = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("run", T.StringType()), T.StructField("place", T.LongType()), T.StructField("value", T.StringType()), T.StructField("done", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField("rows", T.LongType())])

    whole = {f.name: "Int64" for f in gives if isinstance(f.dataType, T.IntegralType)}  # pandas makes floats of them where some are missing

    def one(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place", ignore_index=True)
        error, lines = None, []
        try:
            got = call(part.drop(columns=["chunk"]))[names].astype(whole)
            lines = [json.dumps(r, default=str) for r in got.astype(object).where(got.notna(), None).to_dict("records")]  # floats in full; missing values are null
        except Exception as e:  # kept as the chunk's result: others go on
            error = f"{type(e).__name__}: {e}"[:2000]
        n = len(lines)
        out = pd.DataFrame({"chunk": [int(key[0])] * (n + 1), "run": this, "place": [*range(n), -1], "value": [*lines, None]})
        out["done"], out["error"], out["rows"] = [None] * n + [error is None], [None] * n + [error], [None] * n + [n]
        return out[schema.names]

    rows.groupBy("chunk").applyInPandas(one, schema).withColumn("at", F.current_timestamp()).write.parquet(f"{path}/runs/{this}")
    return manifest(spark, path)


def gather(spark: SparkSession, path: str, gives: T.StructType, chunks: int | None = None) -> DataFrame:
    """chunk, place (from 0 in each chunk) and the columns of all results; it is an error if a chunk has none.

    chunks: how many there must be; else those that the manifest knows.  Order by (chunk, place) for the rows' order.
    """
    known = manifest(spark, path)
    state = [] if known is None else known.select("chunk", "done", "error").collect()  # a row for each chunk
    missing = [f"{r['chunk']}: {r['error']}" for r in state if not r["done"]]
    if chunks is not None:
        missing += [f"{c}: not run" for c in sorted(set(range(chunks)) - {r["chunk"] for r in state})]
    if missing or not state:
        raise Incomplete("; ".join(missing) or "no chunk was run")
    rows = _results(spark, path).where("place >= 0").join(F.broadcast(known.select("chunk", "run")), ["chunk", "run"])
    return rows.select("chunk", "place", F.from_json("value", gives).alias("v")).select("chunk", "place", "v.*")
