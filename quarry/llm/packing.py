"""Packing of token sequences into fixed-size rows by exact-complement hashing.

Only the histogram of piece lengths (at most ``capacity`` numbers) decides the
plan, so the plan is exact for all pieces and of bounded size.  For every gap
that a longest remaining piece leaves, single lengths, sums of pairs and sums of
triples are looked up by their sum; combinations that fill the gap exactly are
consumed as often as the availability counts allow.  Where no exact complement
is left, the best fits go in, one after the other.  Pieces then get their places
by their rank within their length, without any group meeting in one task.

Null and empty texts are sequences of the end token alone; an empty table gives
no pieces.  Every row is a document of its own, also where rows share a doc_id;
pieces of equal length take their places in any order.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"

_encoders: dict[str, object] = {}


def vocabulary_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str):
    """text -> ids, as the tokenizers library gives them without special tokens added.

    The same vocabulary as ranks, where it lies beside the file, gives equal ids several times faster; texts that
    hold the string of a special token go through the file itself.
    """
    if path in _encoders:
        return _encoders[path]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    special = [t.content for t in plain.get_added_tokens_decoder().values()]
    ranks_path = os.path.splitext(path)[0] + ".tiktoken"

    def slow(text: str):
        return plain.encode(text, add_special_tokens=False).ids

    _encoders[path] = slow
    if os.path.exists(ranks_path):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str):
            return slow(text) if any(s in text for s in special) else fast.encode_ordinary(text)

        _encoders[path] = encode
    return _encoders[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but that the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, nth long"


def _pieces(path: str, capacity: int, end_id: int):
    """Pieces of each document; nth counts the task's pieces of the same length."""

    def f(batches):
        encode, task = encoder(path), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            out = []
            last_text, last = None, None
            for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if last is None or text != last_text:
                    ids = np.array(encode(text or ""), np.uint32)
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    last = [(i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(cut(len(ids), capacity))]
                    last_text = text
                for i, s, n, crc in last:
                    out.append((d, i, s, n, crc, task, seen[n]))
                    seen[n] += 1
            cols = list(zip(*out)) or [()] * 7
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return f


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a row, how many such rows) for the given counts of each length: the fewest rows that are found.

    Exact complements use up short pieces, which the last rows may lack.  So complements are consumed for all longest
    pieces, or only for those from some length on and best fits below it; of equal plans the one of more complements counts.
    """
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    best, size = None, 0
    for part in (0, 1 / 4, 1 / 3, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1):
        rows = _plan(counts, capacity, int(part * capacity))
        total = sum(times for _, times in rows)
        if best is None or total < size:
            best, size = rows, total
        if size == least:
            break
    return best


def _plan(counts: dict[int, int], capacity: int, lowest: int) -> list[tuple[tuple[int, ...], int]]:
    """A plan that looks for complements of pieces of at least ``lowest`` tokens, and for best fits of the others."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    rows: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...]) -> None:
        need = defaultdict(int)
        for x in lengths:
            need[x] += 1
        times = min(int(left[x]) // k for x, k in need.items())
        if times:
            for x, k in need.items():
                left[x] -= times * k
            rows.append((lengths, times))

    if left[capacity]:
        take((capacity,))
    for big in range(capacity - 1, 0, -1):
        gap = capacity - big
        exact = big >= lowest
        if exact and left[big] and left[gap]:  # single lengths that fill the gap
            take((big, gap))
        if exact and left[big]:  # pairs, the largest partner first: it is the harder one to place
            x = np.arange(1, min(gap // 2, gap - 1) + 1)
            for y in x[(left[x] > 0) & (left[gap - x] > 0) & (gap - x <= big)].tolist():
                take((big, gap - y, y))
        if exact and left[big]:  # triples, likewise
            have = np.flatnonzero(left[: min(gap, big) + 1])
            for x in have[::-1].tolist():
                rest = gap - x
                y = have[(have <= rest // 2) & (rest - have <= x)]
                for z in y[left[rest - y] > 0].tolist():
                    if not left[big] or not left[x]:
                        break
                    take((big, x, rest - z, z))
                if not left[big]:
                    break
        while left[big]:  # no exact complement is left: the best fits, again and again
            content, room = [big], gap
            left[big] -= 1
            while room and (fits := np.flatnonzero(left[: room + 1])).size:
                content.append(int(fits[-1]))
                left[fits[-1]] -= 1
                room -= content[-1]
            times = min([int(left[x]) // content.count(x) for x in set(content)])
            for x in content:
                left[x] -= times
            rows.append((tuple(content), times + 1))
    return rows


def _places(rows: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length: rows of (first rank, first sequence, offset) in which consecutive ranks get consecutive sequences."""
    ranks: dict[int, int] = defaultdict(int)
    out: dict[int, list] = defaultdict(list)
    sequence = 0
    for lengths, times in rows:
        offset = 0
        for n in lengths:
            out[n].append((ranks[n], sequence, offset))
            ranks[n] += times
            offset += n
        sequence += times
    return {n: np.array(x, np.int64) for n, x in out.items()}


def _running(totals: DataFrame, keys: list[str], order: str, count: str) -> DataFrame:
    """Counts of earlier ``order`` values per key, over a summary table of one row per key and task."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("before", F.coalesce(F.sum(count).over(w), F.lit(0)))


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    spark = docs.sparkSession
    path = path or vocabulary_path()
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = common.materialise(docs.mapInArrow(common.trimmed(_pieces(path, capacity, end_id)), _PIECES), "pieces")
    totals = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    places = _places(plan(counts, capacity))
    before = _running(totals, ["length"], "task", "n").select(F.col("length").alias("_l"), F.col("task").alias("_t"), "before")

    def assign(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(length[order]) != 0)) if len(order) else []
            for i, j in itertools.pairwise([*cuts, len(order)]):
                rows = order[i:j]
                slots = places[int(length[rows[0]])]
                k = np.searchsorted(slots[:, 0], rank[rows], side="right") - 1
                seq[rows] = slots[k, 1] + rank[rows] - slots[k, 0]
                off[rows] = slots[k, 2]
            cols = [batch.column(c) for c in ("doc_id", "piece", "start")] + [pa.array(length.astype(np.int64)), batch.column("ids_crc32"), pa.array(seq), pa.array(off)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    n = totals.count()
    small = common.broadcast_if_small(before, n, 24)
    ranked = pieces.join(small, (F.col("length") == F.col("_l")) & (F.col("task") == F.col("_t"))).withColumn("rank", F.col("nth") + F.col("before")).drop("_l", "_t", "task", "nth", "before")
    return ranked.mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir))
