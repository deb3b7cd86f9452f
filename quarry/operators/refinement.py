"""Choosing among bins that share contigs: the best bin takes its contigs, the others are scored again without them.

A bin's score is the sum of the weights of the contigs that it still has, so scores only fall, and bins that share no
contig, not even over other bins, don't change each other's.  So each component of bins is gone through in order by one
task, if it has at most so many rows.  Of a larger one, a round gives a task the best bins, as many as have that many rows;
the task chooses one by one until the best of them has fallen behind what the best of the others had before the round,
which is at least what that has now.  The result is that of choosing one by one.  Scores are added up in whole numbers.
"""

from __future__ import annotations

import heapq
import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.operators.scan import Ordered, Running
from quarry.storage import Growing, materialise

#: Rows (bin, contig) that one task goes through in order.
TASK_ROWS = 2_000_000


def refined(bins: DataFrame, weights: DataFrame, least: float = 0, limit: int = TASK_ROWS) -> DataFrame:
    """(contig, bin, score): each contig's bin in the choice, and that bin's score when it was chosen.

    bins: (bin, contig); weights: (contig, weight), finite and not negative.  Ties go to the least bin.  Bins that have
    fallen to ``least`` or less are not chosen; contigs without a weight are left out.  In the order of (score down, bin)
    the bins were chosen one by one.
    """
    rows = bins.select("bin", "contig").where("bin is not null").distinct().join(weights.select("contig", "weight"), "contig").where("weight >= 0")
    rows = materialise(rows.select("bin", "contig", "weight"), "bins")
    live = materialise(rows.join(components(rows), "bin"), "bins")
    score = live.groupBy("bin").agg(F.sum("weight").alias("score")).schema["score"].dataType
    chosen = Growing(live.select("contig", "bin", F.lit(None).cast(score).alias("score")), "chosen")
    free = [F.lit(None).cast(score).alias("bar"), F.lit(None).cast(live.schema["bin"].dataType).alias("bar_bin")]
    while True:
        sizes = materialise(live.groupBy("component").agg(F.count("*").alias("n")), "sizes")
        large = sizes.where(F.col("n") > limit).select("component")
        small = sizes.where(F.col("n") <= limit)
        # small components share tasks, a quarter of the limit or so in each
        deals = max(1, -(-4 * (small.agg(F.sum("n")).first()[0] or 0) // limit))
        alone = F.col("n") > limit // 8
        small = small.select("component", F.when(alone, F.col("component")).alias("own"), F.when(~alone, F.pmod(F.xxhash64("component"), F.lit(deals))).alias("deal"))
        chosen.add(_in_order(live.join(small, "component").select("bin", "contig", "weight", "own", "deal", *free), score, least))
        if large.limit(1).count() == 0:
            return chosen.table()
        live = live.join(large, "component", "left_semi")
        scores = live.groupBy("component", "bin").agg(F.sum("weight").alias("score"), F.count("*").alias("n")).where(F.col("score") > least)
        scores = Ordered(materialise(scores, "scores"), ["component"], [F.desc("score"), "bin"]).with_columns(upto=Running("sum", "n"), place=Running("count")).rows()
        scores = materialise(scores, "scores")
        others = scores.where(F.col("upto") > limit).where("place > 1").groupBy("component").agg(F.min(F.struct((-F.col("score")).alias("s"), "bin")).alias("m"))
        others = others.select("component", (-F.col("m.s")).cast(score).alias("bar"), F.col("m.bin").alias("bar_bin"))
        best = scores.where(F.col("upto") <= limit).select("component", "bin").join(others, "component", "left")
        batch = live.drop("component").join(best, "bin").select("bin", "contig", "weight", F.col("component").alias("own"), F.lit(None).cast("long").alias("deal"), "bar", "bar_bin")
        whole = live.join(scores.where(F.col("upto") > limit).where("place = 1").select("bin", "score"), "bin").select("contig", "bin", "score")  # a best bin that is itself beyond the limit
        taken = materialise(_in_order(batch, score, least).unionByName(whole), "taken")
        chosen.add(taken)
        live = materialise(live.join(taken.select("contig"), "contig", "left_anti").join(scores.select("bin"), "bin", "left_semi").select("bin", "contig", "weight", "component"), "bins")


def components(rows: DataFrame) -> DataFrame:
    """(bin, component): bins that share a contig, or are linked by others that do, have a component, one of them, in common.

    In a round each bin goes over to the first one, in an order by hash that is new each time, of those that it shares a
    contig with; what went to the same one is one bin from then on, so that few rounds are needed.
    """
    nodes = rows.select(F.col("bin").alias("node"), "contig")
    of, turn = rows.select("bin", F.col("bin").alias("component")).distinct(), 0
    while True:
        turn += 1
        first = nodes.groupBy("contig").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node")).alias("m"), F.count("*").alias("n")).where("n > 1").select("contig", "m")
        shared = materialise(nodes.join(first, "contig").select("node", "contig", "m"), "shared")
        heads = materialise(shared.groupBy("node").agg(F.min("m").alias("m")).select("node", F.col("m.node").alias("head")), "heads")
        if heads.limit(1).count() == 0:
            return of
        of = materialise(of.join(heads, F.col("component") == F.col("node"), "left").select("bin", F.coalesce("head", "component").alias("component")), "components")
        nodes = materialise(shared.join(heads, "node").select(F.col("head").alias("node"), "contig").distinct(), "nodes")


def _whole(values: pa.ChunkedArray) -> tuple[np.ndarray, int]:
    """Numbers as whole numbers of 1 / scale, and scale."""
    if pa.types.is_integer(values.type):
        w, scale = values.to_numpy().astype(np.int64), 1
    else:
        ratios = [x.as_integer_ratio() for x in values.to_pylist()]
        scale = math.lcm(*{d for _, d in ratios})
        w = np.array([n * (scale // d) for n, d in ratios], object)
    small = float(w.astype(float).sum()) < 2**62
    return w.astype(np.int64 if small else object), scale


def _in_order(rows: DataFrame, score: T.DataType, least: float) -> DataFrame:
    """(contig, bin, score) of bins chosen one by one in each group (own, deal), as far as they are before the bar."""
    kinds = [to_arrow_type(rows.schema[c].dataType) for c in ("contig", "bin")]
    number = to_arrow_type(score)

    def said(value: int, scale: int):
        if pa.types.is_decimal(number):
            return Decimal(f"{value * 10**number.scale // scale}E-{number.scale}")
        return value / scale if pa.types.is_floating(number) else value

    def each(t: pa.Table) -> pa.Table:
        bins, contigs = (t[c].combine_chunks().dictionary_encode() for c in ("bin", "contig"))
        names = bins.dictionary.to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        names, place = [names[i] for i in order], np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        b, c = place[bins.indices.to_numpy()], contigs.indices.to_numpy()
        w, scale = _whole(t["weight"])
        floor = math.floor(Fraction(least) * scale)
        bar = t["bar"][0].as_py()
        bar = None if bar is None else (-Fraction(bar) * scale, t["bar_bin"][0].as_py())
        left = np.zeros(len(names), w.dtype)
        np.add.at(left, b, w)
        by_bin, by_contig = np.argsort(b, kind="stable"), np.argsort(c, kind="stable")
        at_bin, at_contig = np.searchsorted(b[by_bin], np.arange(len(names) + 1)), np.searchsorted(c[by_contig], np.arange(len(contigs.dictionary) + 1))
        free = np.ones(len(contigs.dictionary), bool)
        heap = [(-s, i) for i, s in enumerate(left.tolist()) if s > floor]
        heapq.heapify(heap)
        got, whose, scores = [], [], []
        while heap:
            s, i = heapq.heappop(heap)
            now = int(left[i])
            if now != -s:  # it has fallen since
                if now > floor:
                    heapq.heappush(heap, (-now, i))
                continue
            if bar is not None and (s, names[i]) > bar:
                break
            took = c[by_bin[at_bin[i] : at_bin[i + 1]]]
            took = took[free[took]]
            free[took] = False
            hit = np.concatenate([by_contig[at_contig[x] : at_contig[x + 1]] for x in took.tolist()])
            np.subtract.at(left, b[hit], w[hit])
            got.append(took)
            whose += [i] * len(took)
            scores += [said(now, scale)] * len(took)
        taken = contigs.dictionary.take(pa.array(np.concatenate(got) if got else np.empty(0, np.int64)))
        return pa.table([taken.cast(kinds[0]), pa.array([names[i] for i in whose], kinds[1]), pa.array(scores, number)], names=["contig", "bin", "score"])

    schema = T.StructType([rows.schema["contig"], rows.schema["bin"], T.StructField("score", score)])
    return rows.groupBy("own", "deal").applyInArrow(each, schema)


def dereplicated(genomes: DataFrame, near: DataFrame, score: str) -> DataFrame:
    """(id, centroid): genomes (id, score column) in the order of their score; each takes its near ones (src, dst) along."""
    from quarry.operators import clustering

    both = near.select("src", "dst").union(near.select("dst", "src"))
    return clustering.greedy_centroids(clustering.ranked(genomes.select("id", score), [F.desc_nulls_last(score), "id"]), both)
