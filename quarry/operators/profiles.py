"""Sequences against position-specific score profiles, in shards of profiles of bounded size.

A profile gives each of its positions a score for each letter of an alphabet; its score on a sequence is the best sum over
all places where it fits as a whole.  Profiles are dealt to shards whose matrices take at most ``SHARD_BYTES`` (or one
profile); for each shard the sequences are read once, in parallel, and scored against all of its profiles, which every
task holds.  Each shard's reported hits are added to one table.  E-values are for the search as a whole, so results don't
depend on the number of shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.storage import Growing, materialise

SHARD_BYTES = 16 << 20
AMINO = "ACDEFGHIKLMNPQRSTVWY"


def sharded(profiles: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """profiles with the number of their shard, by a running sum of their sizes in the order of their names."""
    from quarry.operators.scan import Ordered, Running

    sized = profiles.withColumn("_bytes", F.size("scores").cast("long") * 8)
    upto = Ordered(sized, [], ["name"], limit=0).with_columns(_upto=Running("sum", "_bytes")).rows()
    return upto.withColumn("shard", F.floor((F.col("_upto") - 1) / shard_bytes).cast("int")).drop("_bytes", "_upto")


def best_place(codes: np.ndarray, matrix: np.ndarray) -> tuple[float, int]:
    """(score, start) of the best place of a (positions, letters) matrix on a sequence's codes; the first on ties."""
    n = len(codes) - len(matrix) + 1
    total = np.zeros(n)
    for j, row in enumerate(matrix):
        total += row[codes[j : j + n]]
    at = int(total.argmax())
    return float(total[at]), at


def search(seqs: DataFrame, profiles: DataFrame, alphabet: str = AMINO, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(name, id, score, start, end) of hits that reach their profile's threshold; places from 1.

    seqs: (id, seq); profiles: (name, scores: positions x letters in one array, threshold), names are unique.  Letters
    outside the alphabet score as the worst of a position.  Null sequences, and profiles longer than a sequence, have no hit.
    """
    spark, width = seqs.sparkSession, len(alphabet)
    code = np.full(256, width, np.uint8)
    code[np.frombuffer((alphabet + alphabet.lower()).encode(), np.uint8)] = [*range(width)] * 2
    dealt = materialise(sharded(profiles.select("name", "scores", "threshold"), shard_bytes), "profiles")
    kind, names = seqs.schema["id"].dataType, ["name", "id", "score", "start", "end"]
    schema = f"name string, id {kind.simpleString()}, score double, start long, end long"
    hits = Growing(spark.createDataFrame([], schema), "hits")
    count = dealt.agg(F.max("shard")).first()[0]
    for shard in range(0 if count is None else count + 1):
        held = []
        for r in dealt.where(F.col("shard") == shard).orderBy("name").collect():  # at most shard_bytes
            matrix = np.array(r["scores"], float).reshape(-1, width)
            held.append((r["name"], np.concatenate([matrix, matrix.min(1, keepdims=True)], 1), r["threshold"]))
        table = spark.sparkContext.broadcast(held)

        def each(batches, table=table):
            for b in batches:
                found = []
                for i, s in zip(b.column("id").to_pylist(), b.column("seq").to_pylist()):
                    codes = code[np.frombuffer((s or "").encode("ascii", "replace"), np.uint8)]
                    for name, matrix, threshold in table.value:
                        if 0 < len(matrix) <= len(codes):
                            score, at = best_place(codes, matrix)
                            if score >= threshold:
                                found.append((name, i, score, at + 1, at + len(matrix)))
                columns = list(zip(*found)) if found else [[]] * 5
                types = [pa.string(), b.column("id").type, pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        hits.add(seqs.select("id", "seq").mapInArrow(each, schema))
    return hits.table()


def with_evalues(hits: DataFrame, sequences: int, scale: float, most: float | None = 10.0) -> DataFrame:
    """Hits with evalue = sequences * exp(-scale * score), those of at most ``most``."""
    out = hits.withColumn("evalue", F.lit(float(sequences)) * F.exp(-F.lit(float(scale)) * F.col("score")))
    return out if most is None else out.where(F.col("evalue") <= most)
