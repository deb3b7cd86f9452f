"""Chunks with an ordered gather, and clustering in batches, against sequential models."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import chunks, incremental, similarity
from quarry.sources import tables
from quarry.streaming import sources as streaming

GIVES = tables.schema(id=tables._S, n=tables._L, x=tables._D)


def test_chunks_are_balanced_and_gathered_in_order(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"s{i:03d}", "A" * rng.randint(0, 80)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, seq string").withColumn("bytes", F.length("seq")).repartition(5)
    cut = chunks.by_size(df, ["id"], "bytes", 8)
    sums = {r["chunk"]: r["b"] for r in cut.groupBy("chunk").agg(F.sum("bytes").alias("b")).collect()}
    assert sorted(sums) == list(range(8)) and max(sums.values()) - min(sums.values()) <= 160
    assert [r["id"] for r in cut.orderBy("place").collect()] == [x[0] for x in rows] and [r["chunk"] for r in cut.orderBy("place").collect()] == sorted(r["chunk"] for r in cut.collect())
    path, broken = str(tmp_path / "out"), str(tmp_path / "broken")

    def work(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"x": part["seq"].str.len() / 3, "id": part["id"], "n": part["seq"].str.len()})

    (tmp_path / "broken").write_text("")

    def fails(part):
        if part["place"].min() > 200 and __import__("os").path.exists(broken):
            raise RuntimeError("no more licences")
        return work(part)

    state = {r["chunk"]: r for r in chunks.run(cut, fails, GIVES, path).collect()}
    assert any(not r["done"] for r in state.values()) and any(r["done"] for r in state.values()) and "no more licences" in max(r["error"] or "" for r in state.values())
    with pytest.raises(chunks.Incomplete, match="no more licences"):
        chunks.gather(spark, path, GIVES)
    (tmp_path / "broken").unlink()
    done = {c for c, r in state.items() if r["done"]}
    again = {r["chunk"]: r for r in chunks.run(cut, fails, GIVES, path).collect()}
    assert all(r["done"] for r in again.values()) and all(again[c]["run"] == state[c]["run"] for c in done)  # kept, not done again
    for _ in range(2):
        got = chunks.gather(spark, path, GIVES, 8).orderBy("chunk", "place").collect()
        assert [(r["id"], r["n"], r["x"]) for r in got] == [(i, len(s), len(s) / 3) for i, s in rows]
        chunks.run(cut, work, GIVES, path)  # nothing is left to do
    with pytest.raises(chunks.Incomplete, match="9: not run"):
        chunks.gather(spark, path, GIVES, 10)
    none = chunks.by_size(df.limit(0), ["id"], "bytes", 3)
    assert none.count() == 0


def test_whole_numbers_stay_whole_beside_missing_ones(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "c d e"), (5, "f")], "id long, text string").withColumn("bytes", F.length("text"))
    gives = tables.schema(id=tables._L, n=tables._L, blanks=tables._L)

    def measured(part):
        return part[["id"]].assign(n=part["text"].str.len(), blanks=part["text"].str.count(" ").where(part["text"].str.len() > 0))

    chunks.run(chunks.by_size(df, ["id"], "bytes", 2), measured, gives, str(tmp_path / "out"))
    got = chunks.gather(spark, str(tmp_path / "out"), gives).orderBy("id")
    assert [(r["id"], r["n"], r["blanks"]) for r in got.collect()] == [(1, 3, 1), (2, None, None), (3, 0, None), (4, 5, 2), (5, 1, 0)]


def test_rows_of_one_key_have_places_of_their_own(spark):
    rows = [(None, "x"), (2, "b"), (1, "a"), (2, "b"), (2, "ccc"), (None, None)]
    df = spark.createDataFrame(rows, "id long, seq string").withColumn("bytes", F.length("seq")).repartition(3)
    got = chunks.by_size(df, ["id"], "bytes", 2).orderBy("place").collect()
    assert [(r["place"], r["id"], r["seq"]) for r in got] == [(1, 1, "a"), (2, 2, "b"), (3, 2, "b"), (4, 2, "ccc"), (5, None, None), (6, None, "x")]


def sequences(seed, n):
    rng, out = random.Random(seed), []
    for _ in range(n):
        s = "".join(rng.choices("ACGT", k=rng.randint(300, 900)))
        out += [s] + ["".join(rng.choice("ACGT") if rng.random() < 0.01 else c for c in s)[: rng.randint(250, 900)] for _ in range(rng.randint(0, 3))]
    rng.shuffle(out)
    return [(i, s, len(s)) for i, s in enumerate(out)] + [(len(out), "AC", 2)]


def model(batches):
    sketch = lambda s: frozenset(similarity.minimizers(np.frombuffer(s.encode(), np.uint8), similarity.K, similarity.WINDOW).tolist())
    share = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    heads, out = {}, {}
    for batch in batches:
        of = {i: sketch(s) for i, s, _ in batch}
        best = {i: min(((-share(x, h), c) for c, h in heads.items() if 100 * share(x, h) >= 40), default=None) for i, x in of.items()}
        out |= {i: b[1] for i, b in best.items() if b}
        left = sorted(((-n, i) for i, _, n in batch if not best[i]))
        least = {}  # equal sketches are one node, under its least id
        for _, i in left:
            least[of[i]] = min(i, least.get(of[i], i)) if of[i] else i
        length = {i: n for i, _, n in batch}
        mine = {}
        for _, i in sorted((-length[i], i) for _, i in left if not of[i] or least[of[i]] == i):
            near = [c for c in mine if 100 * share(of[i], of[c]) >= 40 and mine[c] == c]
            mine[i] = near[0] if near else i
        out |= {i: mine[least[of[i]] if of[i] else i] for _, i in left}
        heads |= {i: of[i] for i, c in mine.items() if c == i}
    return out


def test_batches_join_known_centroids_first(spark, tmp_path):
    rows = sequences(5, 40)
    batches = [rows[k::3] for k in range(3)]
    schema = "id long, seq string, length long"
    path = str(tmp_path / "clusters")
    for k, b in enumerate(batches):
        assert incremental.add(spark.createDataFrame(b, schema), path, k)
        if k == 1:
            assert not incremental.add(spark.createDataFrame(b, schema), path, k)  # a repeated batch changes nothing
    got = incremental.result(spark, path)
    assert {r["id"]: r["centroid"] for r in got.collect()} == model(batches) and got.count() == len(rows)
    spark.createDataFrame([(1, 1)], "id long, centroid long").write.parquet(f"{path}/members/batch=7")  # half-written
    assert incremental.result(spark, path).count() == len(rows)
    folder = str(tmp_path / "in")
    for k, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(folder)
        for _ in range(2):  # the second time nothing has arrived
            incremental.stream(streaming.arriving(spark, folder, spark.createDataFrame([], schema).schema), str(tmp_path / "streamed"), str(tmp_path / "state")).awaitTermination()
    assert {r["id"]: r["centroid"] for r in incremental.result(spark, str(tmp_path / "streamed")).collect()} == model(batches)
