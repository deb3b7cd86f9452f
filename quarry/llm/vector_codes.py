"""Product codes of vectors by heap Lloyd: bounds in heaps say which parts must be compared again.

A vector's components become integers, floor(``SCALE`` * x), and the vector is cut into
``PARTS`` equal parts (padded with zeros where its length is no multiple).  Each part
position has a codebook that starts as that part of the rows of least vec_id, and moves
by Lloyd's rounds: every part goes to its nearest entry (ties: lower index), then every
entry to the floored mean of its parts; unused entries stay.

Rows are kept in blocks (one row of a table for up to ``BLOCK`` vectors), and each block
keeps a heap for every position and entry.  A part stands in its entry's heap under
lower - upper: its distance to the second nearest entry less that to its own, when it was
last compared.  A round can have closed that gap by no more than the entry's own move and
the largest move of another entry.  These are summed up over the rounds, the sum at
insertion is added to the key, and so only parts whose key the sum has reached are popped
and compared with all entries again, in exact integers.  All others keep their entry.
Keys are rounded down, so rounding can only cause a needless comparison.

A round is one pass over the blocks without a shuffle; what moved comes back as changes
of sums and counts, added up by task and then by Spark: a table of fixed size for the
driver.  Each round's blocks are written to the shared folder, and the round before goes.

Rows whose vector is null or holds null or non-finite components are dropped, and so are
vectors of another length than the first kept one (by vec_id, nulls last, then vector).
Repeated rows and ids count each as a row of its own; fewer rows than ``ENTRIES`` give as
many entries.  Null ids and labels stay as they are, null labels are one label.  An empty
table gives no rows; vectors without components have error 0.  Other columns are neither
read nor kept.  A component too large for exact 64-bit distances is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import common

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 4096
BLOCK_BYTES = 1 << 20
_EPS = 1e-9


def whole(vectors: np.ndarray) -> np.ndarray:
    """(rows, PARTS, width) integers of float rows."""
    n, size = vectors.shape
    width = -(-size // PARTS)
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= math.sqrt(2**62 / (4 * PARTS * width)):
        raise ValueError("a component is too large for exact distances")
    out = np.zeros((n, PARTS * width), np.int64)
    out[:, :size] = scaled
    return out.reshape(n, PARTS, width)


def distances(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries."""
    out = np.empty((len(part), len(entries)), np.int64)
    for k, e in enumerate(entries):
        gap = part - e
        out[:, k] = (gap * gap).sum(1)
    return out


class Codebooks:
    """Entries of all positions, and how far they can have closed the gaps of their parts so far."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # (PARTS, k, width)
        self.closed = np.zeros(entries.shape[:2])

    def moved(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """Entries at the floored means of their parts."""
        new = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], self.entries).astype(np.int64)
        out = Codebooks(new)
        gap = (new - self.entries).astype(float)
        moves = np.sqrt((gap * gap).sum(2)) * (1 + _EPS)
        for p, m in enumerate(moves):
            for c in range(len(m)):
                out.closed[p, c] = (self.closed[p, c] + m[c] + np.delete(m, c).max(initial=0)) * (1 + _EPS)
        return out

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Heaps:
    """One heap of (key, row) for each position and entry of a block; a row's heap is its code."""

    def __init__(self, k: int, state: bytes | None = None):
        self.k, self.heaps = k, [[] for _ in range(PARTS * k)]
        if state is not None:
            sizes = np.frombuffer(state, np.int32, PARTS * k)
            held = np.frombuffer(state, np.dtype([("key", "<f4"), ("row", "<u2")]), offset=sizes.nbytes)
            for i, (to, n) in enumerate(zip(np.cumsum(sizes), sizes)):
                self.heaps[i] = held[to - n : to]  # a list only when it is touched

    def state(self) -> bytes:
        kind = np.dtype([("key", "<f4"), ("row", "<u2")])
        return np.array([len(h) for h in self.heaps], np.int32).tobytes() + b"".join(np.asarray(h, kind).tobytes() for h in self.heaps)

    def _open(self, i: int) -> list:
        if not isinstance(self.heaps[i], list):
            self.heaps[i] = list(zip(self.heaps[i]["key"].tolist(), self.heaps[i]["row"].tolist()))
        return self.heaps[i]

    def popped(self, p: int, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their entries) of position p whose gap may be closed."""
        rows, old = [], []
        for c in range(self.k):
            i = p * self.k + c
            h = self.heaps[i]
            if len(h) and h[0][0] <= closed[c]:
                h = self._open(i)
                while h and h[0][0] <= closed[c]:
                    rows.append(heapq.heappop(h)[1])
                    old.append(c)
        return np.array(rows, np.int64), np.array(old, np.int64)

    def push(self, p: int, rows: np.ndarray, entry: np.ndarray, gap: np.ndarray, closed: np.ndarray) -> None:
        key = (gap + closed[entry]).astype(np.float32)
        key = np.nextafter(key, np.float32(-np.inf))
        for c in range(self.k):
            of = entry == c
            new = list(zip(key[of].tolist(), rows[of].tolist()))
            if not new:
                continue
            h = self._open(p * self.k + c)
            if len(new) > len(h):
                h += new
                heapq.heapify(h)
            else:
                for x in new:
                    heapq.heappush(h, x)

    def codes(self, n: int) -> np.ndarray:
        out = np.zeros((n, PARTS), np.int64)
        for i, h in enumerate(self.heaps):
            rows = h["row"] if isinstance(h, np.ndarray) else np.array([x[1] for x in h], np.int64)
            out[rows, i // self.k] = i % self.k
        return out


def advance(data: np.ndarray, heaps: Heaps, books: Codebooks, first: bool) -> np.ndarray:
    """Bring a block's heaps up to the codebooks; the change of (sums, count) of each position and entry."""
    n, _, width = data.shape
    delta = np.zeros((PARTS, heaps.k, width + 1), np.int64)
    for p in range(PARTS):
        closed = books.closed[p]
        rows, old = (np.arange(n), None) if first else heaps.popped(p, closed)
        if not len(rows):
            continue
        part = data[rows, p]
        d = distances(part, books.entries[p])
        entry = d.argmin(1)
        if heaps.k > 1:
            two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(float))
            gap = two[:, 1] - two[:, 0] - _EPS * (two[:, 1] + two[:, 0])
        else:
            gap = np.full(len(rows), np.inf)
        heaps.push(p, rows, entry, gap, closed)
        one = np.concatenate([part, np.ones((len(rows), 1), np.int64)], 1)
        go = slice(None) if first else entry != old
        np.add.at(delta[p], entry[go], one[go])
        if not first:
            np.subtract.at(delta[p], old[go], one[go])
    return delta


def _pack(data: np.ndarray) -> bytes:
    kind = np.int16 if not data.size or np.abs(data).max() < 1 << 15 else np.int64
    return data.astype(kind).tobytes()


def _unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if len(raw) == 2 * n * PARTS * width else np.int64).astype(np.int64).reshape(n, PARTS, width)


def usable(rows: DataFrame) -> DataFrame:
    """Rows whose embedding is there and finite throughout."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & ~bad)


def _first(rows: DataFrame, n: int) -> list:
    return rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(n).select("embedding").collect()


def compressed(rows: DataFrame) -> DataFrame:
    """vec_id, label, code, error and the codebooks' digest of every usable row."""
    spark, ids, labels = rows.sparkSession, rows.schema["vec_id"].dataType, rows.schema["label"].dataType
    out_schema = T.StructType([T.StructField("vec_id", ids), T.StructField("label", labels), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    rows = usable(rows)
    if not (first := _first(rows, 1)):
        return spark.createDataFrame([], out_schema).withColumn("codebooks_sha256", F.lit(None).cast("string"))
    size = len(first[0][0])
    width, per_block = -(-size // PARTS), max(1, min(BLOCK, BLOCK_BYTES // max(1, 8 * size)))
    rows = rows.where(F.size("embedding") == size)
    first = _first(rows, ENTRIES)
    start = whole(np.array([r[0] for r in first], np.float64).reshape(len(first), size))
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    k = books.entries.shape[1]
    schema = T.StructType([T.StructField("ids", T.ArrayType(ids)), T.StructField("labels", T.ArrayType(labels)), T.StructField("data", T.BinaryType()), T.StructField("state", T.BinaryType()), T.StructField("delta", T.BinaryType())])

    def row(ids, labels, data, heaps, delta):
        kinds = [pa.list_(ids.type), pa.list_(labels.type), pa.binary(), pa.binary(), pa.binary()]
        values = [[ids], [labels], [_pack(data)], [heaps.state()], [delta.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(ids)], x[0]) if pa.types.is_list(t) else pa.array(x, t) for t, x in zip(kinds, values)], names=schema.names)

    def opened(books):
        def f(batches):
            for b in batches:
                for at in range(0, b.num_rows, per_block):
                    some = b.slice(at, per_block)
                    flat = some.column("embedding").flatten().to_numpy(zero_copy_only=False)
                    data = whole(flat.reshape(some.num_rows, size))
                    heaps = Heaps(k)
                    delta = advance(data, heaps, books, True)
                    yield row(some.column("vec_id"), some.column("label"), data, heaps, delta)

        return f

    def blocks(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, labels = b.column("ids")[i].values, b.column("labels")[i].values
                yield ids, labels, _unpack(b.column("data")[i].as_py(), len(ids), width), Heaps(k, b.column("state")[i].as_py())

    def moved(books):
        def f(batches):
            for ids, labels, data, heaps in blocks(batches):
                delta = advance(data, heaps, books, False)
                yield row(ids, labels, data, heaps, delta)

        return f

    def ended(books):
        def f(batches):
            for ids, labels, data, heaps in blocks(batches):
                advance(data, heaps, books, False)
                code = heaps.codes(len(data))
                error = np.zeros(len(data), np.int64)
                for p in range(PARTS):
                    gap = data[:, p] - books.entries[p][code[:, p]]
                    error += (gap * gap).sum(1)
                text = [bytes(c).hex() for c in code.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error)], names=out_schema.names)

        return f

    def summed(batches):
        total = np.zeros(PARTS * k * (width + 1), np.int64)
        for b in batches:
            for d in b.column("delta").to_pylist():
                total += np.frombuffer(d, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["delta"])

    table = common.materialise(rows.mapInArrow(common.trimmed(opened(books)), schema), "codes")
    total = np.zeros((PARTS, k, width + 1), object)
    for r in range(ROUNDS):
        got = table.select("delta").mapInArrow(common.trimmed(summed), "delta array<bigint>").select(F.posexplode("delta").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        change = np.zeros(total.size, object)
        for x in got.collect():  # one number for each component of the codebooks
            change[x["at"]] = int(x["v"])
        total = total + change.reshape(total.shape)
        books = books.moved(total[..., :-1], total[..., -1])
        if r + 1 < ROUNDS:
            old, table = table, common.materialise(table.mapInArrow(common.trimmed(moved(books)), schema), "codes")
            common.discard(old)
    out = common.materialise(table.mapInArrow(common.trimmed(ended(books)), out_schema), "coded")
    common.discard(table)
    return out.withColumn("codebooks_sha256", F.lit(books.digest()))


def label_errors(coded: DataFrame) -> DataFrame:
    """coded with the errors summed over each label; null is a label."""
    sums = coded.groupBy(F.col("label").alias("_l")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(common.broadcast_if_small(sums, sums.count(), 32), F.col("label").eqNullSafe(F.col("_l"))).drop("_l")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = label_errors(compressed(common.table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql() -> str:
    step = """a{r} AS (SELECT i, p, min(d * 16 + k) AS best FROM (SELECT e.i, e.p, c.k, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{r} c USING (p, j) GROUP BY ALL) GROUP BY i, p)"""
    move = """c{s} AS (
  SELECT c.p, c.k, c.j, coalesce(m.x, c.x) AS x FROM c{r} c
  LEFT JOIN (SELECT p, best % 16 AS k, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM a{r} JOIN e USING (i, p) GROUP BY ALL) m USING (p, k, j))"""
    ctes = [
        """t AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
        "e AS (SELECT i, (s - 1) // (len(v) // 8) AS p, (s - 1) % (len(v) // 8) AS j, v[s] AS x FROM (SELECT i, v, unnest(generate_series(1, len(v))) AS s FROM t))",
        "c0 AS (SELECT p, i - 1 AS k, j, x FROM e WHERE i <= 16)",
    ]
    for r in range(ROUNDS):
        ctes += [step.format(r=r), move.format(r=r, s=r + 1)]
    ctes.append(step.format(r=ROUNDS))
    return f"""WITH {", ".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes)},
h AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, k, j)) AS codebooks_sha256 FROM c{ROUNDS}),
o AS (SELECT i, string_agg(printf('%02x', (best % 16)::BIGINT), '' ORDER BY p) AS code, sum(best // 16)::BIGINT AS error FROM a{ROUNDS} GROUP BY i)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o JOIN t USING (i), h"""


OP12_SQL = _sql()
