"""Token ids packed into fixed-size rows and written as binary matrices.

Documents are tokenized and end with one end token; overlong ones are cut
losslessly into row-sized pieces.  Every task packs its own documents, best-fit
decreasing over windows of ``WINDOW`` tokens: a segment tree over the remaining
capacities (0 .. capacity), which counts open rows, finds the smallest capacity
that a piece fits in, in log(capacity) steps.  No ids are shuffled; each window
leaves at most a few rows under-filled.

A row holds the id matrix line (little-endian unsigned 32-bit, padded), the
cumulative segment lengths, and where positions reset to what: a document's
later pieces go on counting where the piece before stopped.

A null text is empty and gives the end token alone.  Repeated rows, and rows that share
a doc_id or have none, are packed one by one; pieces of one length are taken in the order
of their rows, and of rows with the same room left the latest is filled.  An empty table
writes no rows.  A long text is tokenized whole.  Other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common, packing

WINDOW = 1 << 21
PAD = 0

ROW = "row_id long, ids binary, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, resets array<struct<at: int, position: long>>"


class CapacityTree:
    """Counts open rows by remaining capacity; finds the smallest capacity that is large enough."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int = 1) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i //= 2

    def at_least(self, need: int) -> int | None:
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:  # up to the first right sibling that holds any, then down its left side
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i *= 2
                    if not self.count[i]:
                        i += 1
                return i - self.size
            i //= 2
        return None


def best_fit_decreasing(lengths, capacity: int) -> list[list[int]]:
    """Indexes of the pieces of each row."""
    tree, rooms, rows = CapacityTree(capacity), {}, []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[i]
        room = tree.at_least(n)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = rooms[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        tree.add(room - n)
        rooms.setdefault(room - n, []).append(row)
    return rows


def _packed(path: str, capacity: int, end_id: int):
    def flush(pieces, first):
        rows = best_fit_decreasing([len(p[2]) for p in pieces], capacity)
        out = []
        for k, members in enumerate(rows):
            ids = np.full(capacity, PAD, "<u4")
            ends = np.cumsum([0] + [len(pieces[i][2]) for i in members])
            for i, a, b in zip(members, ends[:-1], ends[1:]):
                ids[a:b] = pieces[i][2]
            starts, ends = [pieces[i][1] for i in members], ends.tolist()
            resets = [{"at": a, "position": s} for a, s in zip(ends, starts)]
            out.append((first + k, ids.tobytes(), ends[-1], [pieces[i][0] for i in members], starts, ends, resets))
        return out

    def batch(rows):
        types = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.struct([("at", pa.int32()), ("position", pa.int64())])))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row_id", "ids", "n_tokens", "doc_ids", "starts", "cu_seqlens", "resets"])

    def f(batches):
        encode, next_id = packing.encoder(path), TaskContext.get().partitionId() << 32
        pieces, held = [], 0
        for b in batches:
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = np.append(np.array(encode(text or ""), "<u4"), np.uint32(end_id))
                for s, n in packing.cut(len(ids), capacity):
                    pieces.append((d, s, ids[s : s + n]))
                    held += n
                if held >= WINDOW:
                    rows = flush(pieces, next_id)
                    next_id += len(rows)
                    yield batch(rows)
                    pieces, held = [], 0
        if pieces:
            yield batch(flush(pieces, next_id))

    return f


def packed_rows(docs: DataFrame, capacity: int = packing.CAPACITY, path: str | None = None, end_id: int = packing.END_ID) -> DataFrame:
    """Rows of ``ROW``; row_id is unique, ids has capacity * 4 bytes."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(common.trimmed(_packed(path or packing.vocabulary_path(), capacity, end_id)), ROW)


def write(docs: DataFrame, target: str, capacity: int = packing.CAPACITY, path: str | None = None) -> None:
    """The packed rows as Parquet files of fixed-size binary ids; read them with ``read`` or any Parquet reader."""
    packed_rows(docs, capacity, path).write.parquet(target)


def read(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(ROW).parquet(target)


def positions(starts: list[int], cu_seqlens: list[int]) -> np.ndarray:
    """Position of every token of a row within its document: it resets at each segment to where the segment starts."""
    return np.concatenate([np.arange(s, s + b - a) for s, a, b in zip(starts, cu_seqlens[:-1], cu_seqlens[1:])]).astype(np.int64)


def reset_positions(resets: list[dict], n_tokens: int) -> np.ndarray:
    """The same from a row's stored resets."""
    return positions([x["position"] for x in resets], [x["at"] for x in resets] + [n_tokens])


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per packed row, as written to the shared folder and read back: its segments and checksums of its ids and positions."""

    def digest(batches):
        for b in batches:
            ids = [zlib.crc32(x) for x in b.column("ids").to_pylist()]
            pos = [zlib.crc32(reset_positions(x, n).astype("<u4").tobytes()) for x, n in zip(b.column("resets").to_pylist(), b.column("n_tokens").to_pylist())]
            cols = [b.column(c) for c in ("row_id", "n_tokens", "doc_ids", "starts", "cu_seqlens")] + [pa.array(ids, pa.int64()), pa.array(pos, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["row_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", "ids_crc32", "positions_crc32"])

    target = f"{common.shared_dir(spark)}/packed-{uuid.uuid4().hex}"
    write(common.documents(spark, sf_dir), target)
    return read(spark, target).mapInArrow(digest, "row_id long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, ids_crc32 long, positions_crc32 long")
