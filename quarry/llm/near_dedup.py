"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A sketch has ``COORDINATES`` coordinates.  In round i < COORDINATES every
shingle goes to a hashed bin with a hashed value plus i; in round
COORDINATES + b every shingle goes to bin b.  Each bin keeps its least value, so
after at most two times COORDINATES rounds every coordinate is filled, most sets
need few rounds, and coordinates agree with the sets' Jaccard similarity, with
the concentration of independent draws.

Documents with equal shingle sets are one node.  Nodes that agree in a band of
four coordinates meet in a bucket, and nodes of a bucket are candidates if their
sketches agree in ``LEAST_SHARE`` of the coordinates.  Only what candidates
connect matters: every bucket's nodes are tried against one of them, and buckets
whose nodes are then still in several parts are compared in blocks, each part
with the others, until every pair is connected or rejected.

Connected candidates are compared exactly on their full shingle sets: small
groups at once; large ones first against ``HUBS`` of their nodes, and what that
leaves in several parts block by block, each part with the others.  Blocks are
bounded by documents and by shingles.

A pair of similarity 0.8 is missed by all bands with probability 5e-8, and its
sketches agree in less than LEAST_SHARE with probability 1e-10.

Every row is a document of its own, also where rows share a doc_id, with its
(doc_id, text hash) as its key; a null doc_id comes after all others.  Ties of
similarity at the threshold are links.  Null and empty texts, and texts of white
space, have no shingles and no links.  An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import anchors, common

COORDINATES = 128
BANDS = 32
#: Documents, and shingles of them, that a block of a candidate group holds.
BLOCK = 256
BLOCK_SHINGLES = 1 << 18
#: Share of equal coordinates below which nodes are no candidates: 7 standard deviations under 0.8.
LEAST_SHARE = 0.55
#: Nodes of a large group that all others are tried against first.
HUBS = 8
#: Sketches of a bucket that are compared with as many others in one task.
SKETCHES = 512
_U = np.uint64


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles (fewer words: all as one)."""
    data = (text or "").encode().lower()  # bytes: A-Z only
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, _U)
    word = anchors.of_slices(anchors.prefix(raw), start, end)
    k = min(width, len(word))
    out = np.zeros(len(word) - k + 1, _U)
    for i in range(k):
        out = anchors.mix(out * _U(anchors.BASE) + word[i : i + len(out)])
    return np.unique(out)


def sketch(values: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """t coordinates of a non-empty set; each names the round and the least value in its bin."""
    out = np.zeros(t, _U)
    empty = np.ones(t, bool)
    for i in range(2 * t):
        h = anchors.mix(values + _U((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        if i < t:
            b = (h >> _U(57)).astype(np.int64) if t == 128 else (h % _U(t)).astype(np.int64)
            low = np.full(t, ~_U(0))
            np.minimum.at(low, b, h << _U(7))
            new = empty & (low != ~_U(0))
            out[new] = low[new] + _U(i)
            empty &= ~new
        elif empty[i - t]:
            out[i - t] = h.min() + _U(i)
            empty[i - t] = False
        if not empty.any():
            break
    return anchors.mix(out)


def _sketched(width: int):
    rows = COORDINATES // BANDS
    band = anchors.mix(np.arange(BANDS, dtype=_U) + _U(77))

    def f(batches):
        for batch in batches:
            n, low, high, marks, keys = [], [], [], [], []
            last_text = last = None
            for text in batch.column("text").to_pylist():
                if last is None or text != last_text:
                    s = shingles(text, width)
                    if len(s):
                        c = sketch(s)
                        k = band.copy()
                        for j in range(rows):
                            k = anchors.mix(k * _U(anchors.BASE) + c[j::rows])
                        last = (len(s), anchors.mix(s).sum(dtype=_U), anchors.mix(s ^ _U(0xABCDEF)).sum(dtype=_U), (c & _U(255)).astype(np.uint8).tobytes(), k.view(np.int64))
                    else:
                        last = (0, _U(0), _U(0), None, None)
                    last_text = text
                for c, v in zip((n, low, high, marks, keys), last):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(np.array(low, _U).view(np.int64)), pa.array(np.array(high, _U).view(np.int64)), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "marks", "bands"],
            )

    return f


@F.pandas_udf(T.DoubleType())
def _share(a, b):
    """Share of equal marks of two sketches."""
    x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1)
    return a.__class__((x == y).mean(1) if len(a) else [], index=a.index, dtype=float)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): least node reachable, for all nodes of the undirected edges (src, dst).

    Each round takes the least label among a node and its neighbours, then the label's own label; labels at least
    halve their distance to the root of a star, and the loop ends when none changes.
    """
    # every node is first tied to its least neighbour, and that one to the others: nodes of many edges keep one
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst").distinct()
    down = common.materialise(down, f"{name}-edges")
    low = down.groupBy("src").agg(F.min("dst").alias("m"))
    rest = down.join(low, "src").where("dst <> m").select(F.greatest("dst", "m").alias("src"), F.least("dst", "m").alias("dst")).distinct()
    few = low.select("src", F.col("m").alias("dst")).union(rest).distinct()
    both = common.materialise(few.union(few.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), f"{name}-ties")
    labels = both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("component"))
    labels = common.materialise(labels, f"{name}-labels")
    while True:
        near = both.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("component").alias("c"))
        stepped = labels.join(near, F.col("node") == F.col("src")).select("node", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        after = stepped.join(jump, F.col("component") == F.col("_n"), "left").select("node", "old", F.least("component", F.coalesce("_c", "component")).alias("component"))
        after = common.materialise(after, f"{name}-labels")
        labels = after.select("node", "component")
        if after.where("component < old").limit(1).count() == 0:
            return labels


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), COORDINATES)


class _Parts:
    """Which part each row of a task belongs to, and the links that joined parts."""

    def __init__(self, part: np.ndarray):
        self.part, self.label, self.links = part, np.unique(part, return_inverse=True)[1], []

    def join(self, i: int, js: np.ndarray) -> None:
        for j in js.tolist():
            if self.label[i] != self.label[j]:
                self.links.append((int(self.part[i]), int(self.part[j])))
                self.label[self.label == self.label[j]] = self.label[i]

    def table(self) -> pa.Table:
        src, dst = zip(*self.links) if self.links else ((), ())
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})


def _across(side: np.ndarray):
    """(i, rows that i is compared with): side 0 with side 1, or all with all where there is one side."""
    one, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(one) or not len(other):
        every = np.arange(len(side))
        return ((i, every[i + 1 :]) for i in range(len(side) - 1))
    return ((i, other) for i in one.tolist())


def _agreeing(rows: pa.Table) -> pa.Table:
    """Links of parts of a bucket of which sketches agree: a spanning forest of the pairs of two blocks."""
    marks, parts = _matrix(rows["marks"]), _Parts(rows["part"].to_numpy())
    for i, others in _across(rows["side"].to_numpy()):
        others = others[parts.label[others] != parts.label[i]]
        if len(others):
            parts.join(i, others[(marks[others] == marks[i]).mean(1) >= LEAST_SHARE])
    return parts.table()


def _verified(percent: int):
    """Links of parts by the exact similarity of two of their documents: a spanning forest of the pairs of two blocks."""

    def f(rows: pa.Table) -> pa.Table:
        marks, parts = _matrix(rows["marks"]), _Parts(rows["part"].to_numpy())
        sets = [np.frombuffer(x, _U) for x in rows["set"].to_pylist()]
        size = np.array([len(x) for x in sets], np.int64)
        end = np.cumsum(size)
        begin = end - size
        slot = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32) if len(sets) else np.empty(0, np.int32)
        said = np.zeros(int(slot.max()) + 1 if len(slot) else 1, bool)
        for i, others in _across(rows["side"].to_numpy()):
            others = others[parts.label[others] != parts.label[i]]
            if not len(others):
                continue
            others = others[(marks[others] == marks[i]).mean(1) >= LEAST_SHARE]
            if not len(others):
                continue
            said[slot[begin[i] : end[i]]] = True
            shared = np.array([np.count_nonzero(said[slot[begin[j] : end[j]]]) for j in others.tolist()])
            said[slot[begin[i] : end[i]]] = False
            parts.join(i, others[100 * shared >= percent * (size[i] + size[others] - shared)])
        return parts.table()

    return f


_EDGE = "src long, dst long"


def _in_tasks(rows: DataFrame, *keys: str):
    """rows grouped by keys, each group dealt by all of them: a join by the first alone must not fix where groups go."""
    return rows.repartition(*keys).groupBy(*keys)


def _block_pairs(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Rows (``key``, node, part, ...) dealt to pairs of blocks (i, j) of their key, with the side they stand on.

    Only keys with several parts are dealt.  The largest part has blocks of its own, which are not paired with each
    other.  ``blocks`` is how many blocks so many nodes (n) of so many shingles (weight) take.
    """
    total = rows.groupBy(key, "part").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    top = total.groupBy(key).agg(F.max(F.struct("n", "weight", "part")).alias("top"), F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.count("*").alias("_parts")).where("_parts > 1")
    many = top.select(F.col("top.n").alias("n"), F.col("top.weight").alias("weight"), F.col("top.part").alias("_top"), key, (F.col("n") - F.col("top.n")).alias("n2"), (F.col("weight") - F.col("top.weight")).alias("w2"))
    many = many.withColumn("_a", blocks.cast("int")).withColumns({"n": F.col("n2"), "weight": F.col("w2")}).withColumn("_b", blocks.cast("int")).select(key, "_top", "_a", "_b")
    rows = rows.drop("weight").join(many, key).withColumn("_h", F.xxhash64("node", F.lit("block")))
    inside = F.col("part") == F.col("_top")
    rows = rows.withColumn("_own", F.when(inside, F.pmod("_h", "_a")).otherwise(F.col("_a") + F.pmod("_h", "_b")).cast("int"))
    first = F.when(inside, F.col("_a")).otherwise(F.lit(0))
    rows = rows.withColumn("_other", F.explode(F.sequence(first, F.col("_a") + F.col("_b") - 1)))
    side = F.when(F.col("_own") <= F.col("_other"), 0).otherwise(1)
    return rows.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other"), "side": side}).drop("_h", "_a", "_b", "_top", "_own", "_other")


def _part_of(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with ``part``: the label of their node, itself where it has none."""
    return rows.join(labels.select(F.col("node").alias("_n"), "component"), F.col("node") == F.col("_n"), "left").withColumn("part", F.coalesce("component", "node")).drop("_n", "component")


def _candidates(nodes: DataFrame) -> DataFrame:
    """Edges (src, dst) that connect all nodes which candidate pairs connect."""
    marks = nodes.select("node", "marks")
    left = nodes.select("node", F.explode("bands").alias("band"))
    hubs = left.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("_m")).where("hub < _m").drop("_m")
    left = common.materialise(left.join(hubs, "band"), "buckets")
    pairs = left.where("node <> hub").select("node", "hub").distinct()
    judged = pairs.join(marks.withColumnRenamed("marks", "a"), "node").join(marks.select(F.col("node").alias("hub"), F.col("marks").alias("b")), "hub")
    edges = common.materialise(judged.where(_share("a", "b") >= LEAST_SHARE).select(F.col("node").alias("src"), F.col("hub").alias("dst")), "near-hubs")
    labels = components(edges, "hubs")
    # buckets whose nodes are still in several parts
    parted = common.materialise(_part_of(left.select("node", "band"), labels), "parts")
    rest = _block_pairs(parted.withColumn("weight", F.lit(1)), "band", F.ceil(F.col("n") / SKETCHES)).join(marks, "node")
    more = common.materialise(_in_tasks(rest.select("band", "i", "j", "part", "side", "marks"), "band", "i", "j").applyInArrow(_agreeing, _EDGE).distinct(), "agreeing")
    return edges.union(more)


def _sets(docs: DataFrame, nodes: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    """(node, marks, weight, set) of the nodes of candidate groups; weight: shingles."""

    def f(batches):
        for batch in batches:
            sets = pa.array([shingles(t, width).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("group"), batch.column("marks"), batch.column("weight"), sets], names=["node", "group", "marks", "weight", "set"])

    need = nodes.join(groups, "node").select("node", F.col("component").alias("group"), "marks", F.col("n_shingles").alias("weight"), F.col("rep.doc_id").alias("_d"), F.col("rep.text_hash").alias("_h"))
    need = common.materialise(need, "members")
    few = common.broadcast_if_small(need, need.count(), 40 + COORDINATES)
    texts = docs.join(few, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h"))).groupBy("node").agg(*[F.first(c).alias(c) for c in ("group", "marks", "weight", "text")])
    return common.materialise(texts.mapInArrow(common.trimmed(f), "node long, group long, marks binary, weight long, set binary"), "sets")


def _links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, percent: int) -> DataFrame:
    """Exact links (src, dst) that connect what is similar within candidate groups."""
    sets = _sets(docs, nodes, groups, width)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES), F.lit(1))
    hub = [F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(HUBS)]
    total = sets.groupBy("group").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.array(*hub).alias("_hubs")).withColumn("_blocks", blocks.cast("int"))
    total = common.materialise(total.select("group", "_blocks", "_hubs"), "groups")
    whole = sets.join(total.where("_blocks = 1").select("group"), "group", "left_semi")
    kernel = _verified(percent)
    small = whole.select("group", "marks", "set", F.col("node").alias("part"), F.lit(0).alias("side")).groupBy("group").applyInArrow(kernel, _EDGE)
    links = common.materialise(small, "links-small")
    large = total.where("_blocks > 1")
    if large.limit(1).count() == 0:
        return links
    members = sets.join(large, "group")
    chunk = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("_blocks")).cast("int")
    tried = members.select("group", chunk.alias("i"), "marks", "set", F.col("node").alias("part"), F.lit(1).alias("side"))
    hubs = members.where(F.array_contains("_hubs", F.col("node"))).select("group", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("i"), "marks", "set", F.col("node").alias("part"), F.lit(0).alias("side"))
    by_hub = common.materialise(_in_tasks(tried.union(hubs), "group", "i").applyInArrow(kernel, _EDGE).distinct(), "links-hubs")
    parted = _part_of(members.drop("_blocks", "_hubs"), components(by_hub, "parts"))
    rest = _block_pairs(parted, "group", blocks).select("group", "i", "j", "part", "side", "marks", "set")
    by_block = common.materialise(_in_tasks(rest, "group", "i", "j").applyInArrow(kernel, _EDGE).distinct(), "links-blocks")
    return links.union(by_hub).union(by_block)


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, leader of every row; links have 100 * intersection >= percent * union.

    component_id is the least doc_id of the group, leader the row of that doc_id (of several the one of least text_hash).
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    rows = docs.mapInArrow(common.trimmed(_sketched(width)), "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, marks binary, bands array<long>")
    rows = common.materialise(rows, "sketches")
    some = rows.where("n_shingles > 0")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("rep")
    nodes = some.groupBy("set_a", "set_b").agg(rep, *[F.first(c).alias(c) for c in ("n_shingles", "marks", "bands")])
    nodes = common.materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    links = _links(docs, nodes, components(_candidates(nodes), "candidates"), width, percent)
    labels = components(links, "links")
    named = _part_of(nodes.select("node", "set_a", "set_b", "rep"), labels)
    reps = named.groupBy("part").agg(F.min("rep").alias("first"))
    named = named.join(reps, "part").select("set_a", "set_b", "first")
    leader = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    linked = some.select("doc_id", "text_hash", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"])
    linked = linked.select("doc_id", "text_hash", "n_shingles", F.col("first.doc_id").alias("component_id"), leader.alias("leader"))
    none = rows.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("leader"))
    return linked.union(none)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(common.documents(spark, sf_dir), width=4, percent=80)
    return groups.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
