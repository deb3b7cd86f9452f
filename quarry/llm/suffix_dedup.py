"""Removal of repeated byte strings through a sparse suffix array.

Suffixes that windows select (see ``anchors``) stand for all suffixes.  Splitters
sampled from the suffixes' leading tokens (their first five bytes, and 24 bits of
the hash of their first ``GRAM`` bytes, as one integer) range-partition them, so
that a token which very many suffixes start with is dealt to many buckets; every
bucket is sorted by multikey quicksort on (leading token, gram, surroundings), so
that equal strings stand side by side.  Splitters are whole leading tokens and
equal strings share theirs, so a run of equal suffixes can't cross a bucket's
boundary; ``_bucket_of`` sends all of a token to one side.

1. Suffixes with the same surroundings (all bytes of all windows that select
   them) repeat the earliest of them in full.
2. Where suffixes agree in their gram only, the earliest of each kind of
   surroundings is compared window by window: one fetch of those bytes, then
   either a sort in the gram's bucket or, for grams with very many kinds, rows
   per window which map tasks combine first.
3. Each document gets its repeated windows back and drops the bytes they cover.

Strings are equal where 64 bits of their content's hash are and where, besides,
the hash of the gram inside them (64 bits) and its place are.

A null text is empty; an empty table gives an empty result.  Documents shorter
than ``span`` bytes keep everything.  Every row is a document of its own.  Rows
that share a doc_id come in the order of their text's hash, and rows without one
last; of rows that agree in both, one is the first and the others repeat it.
Other columns, whatever their names, are ignored, or kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import anchors, common

SPAN = 100
GRAM = 32
BLOCK = 1 << 17
#: Kinds of surroundings of one gram beyond which its windows are dealt one by one.
MANY_KINDS = 4096
_U = np.uint64

_SUFFIX = "bucket int, lead long, gram long, around long, doc_id long, first long, shape int, again boolean"


def _blocks(raw: np.ndarray, at: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, document index of each part, byte offset of each part) of about BLOCK bytes.

    Longer documents are cut into parts that overlap by span - 1 bytes: every window is in one part.
    """
    parts, size = [], 0
    for i in range(len(at) - 1):
        lo, hi = int(at[i]), int(at[i + 1])
        s = lo
        while hi - s >= span:
            e = min(hi, s + BLOCK + span - 1)
            parts.append((i, s - lo, s, e))
            size += e - s
            if size >= BLOCK:
                yield _join(raw, parts)
                parts, size = [], 0
            if e == hi:
                break
            s = e - span + 1
    if parts:
        yield _join(raw, parts)


def _join(raw, parts):
    data = np.concatenate([raw[s:e] for _, _, s, e in parts])
    ends = np.cumsum([e - s for _, _, s, e in parts])
    return data, ends, np.array([p[0] for p in parts]), np.array([p[1] for p in parts])


def _lead(data: np.ndarray, p: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """The leading token at p: five bytes, which sort as they do, and then bits of the gram's hash."""
    out = np.zeros(len(p), _U)
    for k in range(5):
        out = (out << _U(8)) | data[p + k].astype(_U)
    return (((out << _U(24)) | (gram >> _U(40))) ^ _U(1 << 63)).view(np.int64)


def _suffixes(raw, at, ids, span, gram):
    """Columns of the selected suffixes of a batch."""
    out = []
    for data, ends, doc, offset in _blocks(raw, at, span):
        p, a, b, h, sums = anchors.runs(data, ends, span, gram)
        part = np.searchsorted(ends, p, side="right")
        start = np.append(0, ends[:-1])[part]
        shape = ((p - a) << 8 | (b - a)).astype(np.int32)
        around = anchors.mix(anchors.of_slices(sums, a, b + span) + shape.astype(_U))
        out.append((_lead(data, p, h), h.view(np.int64), around.view(np.int64), ids[doc[part]], a - start + offset[part], shape))
    if not out:
        z = np.empty(0, np.int64)
        return z, z, z, z, z, z.astype(np.int32)
    return tuple(np.concatenate(c) for c in zip(*out))


def _bucket_of(lead: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    return np.searchsorted(splitters, lead, side="right").astype(np.int32)


def _slices(batches, size: int = 8 << 20):
    """The batches' rows, about ``size`` bytes of text at a time."""
    for batch in batches:
        at = common.text_bytes(batch.column("text"))[1]
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def _emit(splitters, span, gram):
    def f(batches):
        for batch in _slices(batches):
            raw, at = common.text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            lead, g, around, doc, first, shape = _suffixes(raw, at, ids, span, gram)
            # the earliest of the batch's equal suffixes stands for them; the others repeat it and go anywhere
            order = np.lexsort([first, doc, around, g])
            again = np.empty(len(order), bool)
            again[order] = ~_new(g[order], around[order])
            bucket = np.where(again, doc % (len(splitters) + 1), _bucket_of(lead, splitters)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (bucket, lead, g, around, doc, first, shape, again)],
                names=["bucket", "lead", "gram", "around", "doc_id", "first", "shape", "again"],
            )

    return f


def multikey_quicksort(columns: list[np.ndarray], small: int = 1 << 14) -> np.ndarray:
    """Order of rows by columns, left to right: three-way partition on one token, then the next token among equals.

    Parts of up to ``small`` rows are finished by a stable sort on the remaining columns.
    """
    n = len(columns[0])
    done: list[np.ndarray] = []
    todo = [(np.arange(n), 0)]
    while todo:
        rows, k = todo.pop()
        if len(rows) <= small or k >= len(columns):
            done.append(rows[np.lexsort([c[rows] for c in columns[k:][::-1]])] if k < len(columns) and len(rows) > 1 else rows)
            continue
        x = columns[k][rows]
        pivot = np.sort(x[[0, len(x) // 4, len(x) // 2, 3 * len(x) // 4, len(x) - 1]])[2]
        todo += [(rows[x > pivot], k), (rows[x == pivot], k + 1), (rows[x < pivot], k)]
    return np.concatenate(done) if done else np.empty(0, np.int64)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the row before."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[0] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _table(batches, names) -> list[np.ndarray]:
    got = [b for b in batches if b.num_rows]
    return [np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in got]) if got else np.empty(0, np.int64) for n in names]


_FOUND = "doc_id long, first long, shape int, kind int, gram long"


def _compare(batches):
    """In a bucket: kind 0 are repeated suffixes, 1 (many kinds: 2) those whose windows are still to be compared."""
    lead, gram, around, doc, first, shape, again = _table(batches, ("lead", "gram", "around", "doc_id", "first", "shape", "again"))
    if not len(lead):
        return
    names = ["doc_id", "first", "shape", "kind", "gram"]
    if again.any():
        yield pa.RecordBatch.from_arrays([pa.array(c[again]) for c in (doc, first, shape, np.zeros(len(doc), np.int32), gram)], names=names)
    lead, gram, around, doc, first, shape = (c[~again] for c in (lead, gram, around, doc, first, shape))
    order = multikey_quicksort([lead, gram, around, doc, first])
    gram, around, doc, first, shape = (c[order] for c in (gram, around, doc, first, shape))
    same_gram = np.cumsum(_new(lead[order], gram)) - 1
    new = _new(same_gram, around)
    kinds = np.bincount(same_gram[new], minlength=1)[same_gram]
    kind = np.where(new, np.where(kinds > MANY_KINDS, 2, 1), 0).astype(np.int32)
    keep = ~new | (kinds > 1)
    yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (doc, first, shape, kind, gram)], names=names)


def _fetch(span):
    """Bytes around the asked-for suffixes of a document."""

    def f(batches):
        for batch in batches:
            raw, at = common.text_bytes(batch.column("text"))
            doc, asks = batch.column("doc_id").to_pylist(), batch.column("asks").to_pylist()
            out = [[], [], [], [], [], []]
            for i, d in enumerate(doc):
                text = raw[at[i] : at[i + 1]].tobytes()
                for x in asks[i]:
                    piece = text[x["first"] : x["first"] + (x["shape"] & 255) + span]
                    for c, v in zip(out, (x["gram"], x["kind"], d, x["first"], x["shape"], piece)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                names=["gram", "kind", "doc_id", "first", "shape", "bytes"],
            )

    return f


def _windows(span, gram, doc, first, shape, pieces):
    """(gram, content hash at its place, document, start) of each window of the fetched bytes."""
    lengths = np.array([len(x) for x in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sums = anchors.prefix(data)
    begin = np.cumsum(lengths) - lengths
    count = np.maximum(lengths - span + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    off = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[row] + off
    content = anchors.of_slices(sums, at, at + span)
    place = ((shape[row] >> 8) - off).astype(np.int64).astype(_U)
    key = anchors.mix(content + anchors.mix(gram[row].view(_U) + place))
    return gram[row], key.view(np.int64), doc[row], first[row] + off


def _chunks(rows: int, step: int):
    return (slice(i, min(i + step, rows)) for i in range(0, rows, step))


def _compare_windows(span):
    """Among suffixes with equal grams: windows that stand earlier too."""

    def f(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        gram, doc, first, shape = _table(got, ("gram", "doc_id", "first", "shape"))
        pieces = [x for b in got for x in b.column("bytes").to_pylist()]
        order = multikey_quicksort([gram, doc, first])
        groups = np.flatnonzero(_new(gram[order]))
        i = 0
        while i < len(groups):  # whole grams, about 20,000 suffixes at a time
            j = i + 1
            while j < len(groups) and groups[j] - groups[i] < 20_000:
                j += 1
            rows = order[groups[i] : groups[j] if j < len(groups) else len(order)]
            yield _later(*_windows(span, gram[rows], doc[rows], first[rows], shape[rows], [pieces[r] for r in rows]))
            i = j

    return f


def _later(gram, key, doc, start) -> pa.RecordBatch:
    """Runs of windows that aren't the earliest of their kind, as (doc_id, first, shape with its last offset)."""
    order = multikey_quicksort([key, gram, doc, start])
    again = order[~_new(key[order], gram[order])]
    d, s = doc[again], start[again]
    o = np.lexsort([s, d])
    d, s = d[o], s[o]
    fresh = _new(d) if len(d) else np.zeros(0, bool)
    fresh[1:] |= s[1:] - s[:-1] > 1
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(d)) - 1
    parts = [(d[h], x, min(s[t], x + 255) - x) for h, t in zip(head, tail) for x in range(int(s[h]), int(s[t]) + 1, 256)]
    cols = list(zip(*parts)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "first", "shape"])


def _deal_windows(span):
    """Windows of suffixes whose gram has very many kinds; the earliest of equal ones of a batch, and the others at once."""

    def f(batches):
        for b in batches:
            gram, doc, first, shape = _table([b], ("gram", "doc_id", "first", "shape"))
            if not len(gram):
                continue
            g, key, d, s = _windows(span, gram, doc, first, shape, b.column("bytes").to_pylist())
            order = multikey_quicksort([key, g, d, s])
            new = _new(key[order], g[order])
            for again, rows in ((False, order[new]), (True, order[~new])):
                cols = [pa.array(x[rows]) for x in (g, key, d, s)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(rows), again))], names=["gram", "key", "doc_id", "start", "again"])

    return f


def _compare_dealt(batches):
    gram, key, doc, start = _table(batches, ("gram", "key", "doc_id", "start"))
    if len(key):
        yield _later(gram, key, doc, start)


def _splitters(docs: DataFrame, buckets: int, span: int, gram: int, per_bucket: int = 200) -> np.ndarray:
    """Leading tokens that cut the suffixes into about equal parts, from suffixes of sampled documents."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = max(1, 2 * size // (span - gram))
    share = min(1.0, buckets * per_bucket / expected * 4)
    sample = docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("splitters")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def leads(batches):
        for batch in batches:
            raw, at = common.text_bytes(batch.column("text"))
            lead = _suffixes(raw, at, np.zeros(batch.num_rows, np.int64), span, gram)[0]
            yield pa.RecordBatch.from_arrays([pa.array(lead)], names=["lead"])

    cuts = [i / buckets for i in range(1, buckets)]
    if not cuts:
        return np.empty(0, np.int64)
    got = sample.mapInArrow(leads, "lead long").agg(F.percentile_approx("lead", cuts, 10_000)).first()[0]
    return np.unique(np.array(got or [], np.int64))


def repeated(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, first, shape): byte strings of ``span`` at first .. first + (shape & 255) also start earlier; doc_id is unique."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    buckets = common.partitions(spark)
    splitters = _splitters(docs, buckets, span, gram)
    suffixes = docs.mapInArrow(common.trimmed(_emit(splitters, span, gram)), _SUFFIX)
    found = common.materialise(suffixes.repartitionById(buckets, F.col("bucket")).mapInArrow(common.trimmed(_compare), _FOUND), "suffixes", tidy=True)
    asked = found.where("kind > 0").groupBy("doc_id").agg(F.collect_list(F.struct("first", "shape", "kind", "gram")).alias("asks"))
    pieces = common.materialise(docs.join(asked, "doc_id").mapInArrow(common.trimmed(_fetch(span)), "gram long, kind int, doc_id long, first long, shape int, bytes binary"), "pieces", tidy=True)
    out = "doc_id long, first long, shape int"
    few = pieces.where("kind = 1").repartition(buckets, "gram").mapInArrow(common.trimmed(_compare_windows(span)), out)
    dealt = pieces.where("kind = 2").mapInArrow(common.trimmed(_deal_windows(span)), "gram long, key long, doc_id long, start long, again boolean")
    many = dealt.repartition(buckets, "key").mapInArrow(common.trimmed(_compare_dealt), out)
    return found.where("kind = 0").select("doc_id", "first", "shape").unionByName(few).unionByName(many)


def _cover(spans: np.ndarray, size: int, span: int) -> np.ndarray:
    """Maximal covered runs as rows (start, end)."""
    s = np.sort(spans[spans < np.int64(size) << np.int64(8)])
    start, end = s >> 8, np.minimum((s >> 8) + (s & 255) + span, size)
    if not len(s):
        return np.empty((0, 2), np.int64)
    reach = np.maximum.accumulate(end)
    head = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return np.stack([start[head], np.append(reach[head[1:] - 1], reach[-1])], 1)


def _spans_of(value) -> np.ndarray:
    return np.empty(0, np.int64) if value is None else np.asarray(value, np.int64)


def keyed(docs: DataFrame, key: str = "__key") -> DataFrame:
    """docs with a unique number for each row, in the order in which documents come: doc_id where that is one already."""
    own = F.col("doc_id").cast("long")
    ids = docs.groupBy(own.alias("d")).agg(F.count("*").alias("n"))
    if ids.where("n > 1 or d is null").limit(1).count() == 0:
        return docs.withColumn(key, own)
    # ties go by where a row stands, so that equal rows spread over the sorted ranges
    docs = docs.withColumn("__place", F.monotonically_increasing_id())
    return common.materialise(docs.orderBy(own.asc_nulls_last(), F.xxhash64("text"), "__place").drop("__place").withColumn(key, F.monotonically_increasing_id()), "keyed")


def with_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """docs with ``__repeats``: packed starts and lengths of each document's repeated windows (null: none)."""
    docs = keyed(docs)
    packed = repeated(docs.select(F.col("__key").alias("doc_id"), "text"), span, gram).groupBy("doc_id")
    packed = packed.agg(F.collect_list(F.shiftleft("first", 8).bitwiseOR(F.col("shape").bitwiseAND(255))).alias("__repeats"))
    return docs.join(packed.withColumnRenamed("doc_id", "__d"), F.col("__key") == F.col("__d"), "left").drop("__d", "__key")


def digest(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def f(batches):
        for batch in batches:
            raw, at = common.text_bytes(batch.column("text"))
            ids, repeats = batch.column("doc_id").to_pylist(), batch.column("__repeats")
            out = []
            for i, d in enumerate(ids):
                data = raw[at[i] : at[i + 1]]
                keep = np.ones(len(data), bool)
                cover = _cover(_spans_of(repeats[i].values.to_numpy() if repeats[i].is_valid else None), len(data), span)
                for s, e in cover.tolist():
                    keep[s:e] = False
                left = data[keep].tobytes()
                out.append((d, len(data), len(data) - len(left), len(cover), hashlib.sha256(left).hexdigest()))
            cols = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = with_repeats(docs.select(F.col("doc_id").cast("long"), "text"), span, gram)
    return rows.mapInArrow(common.trimmed(f), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, column: str = "kept_text") -> DataFrame:
    """docs with ``column``: the text without its repeated bytes, widened to whole characters."""

    @F.pandas_udf("string")
    def kept(text, repeats):
        out = []
        for t, r in zip(text, repeats):
            data = (t or "").encode()
            at, left = 0, []
            for s, e in _cover(_spans_of(r), len(data), span).tolist():
                left.append(data[at:s])
                at = e
            left.append(data[at:])
            out.append(b"".join(x.decode("utf-8", "ignore").encode() for x in left).decode())
        return text.__class__(out, index=text.index, dtype=object)

    return with_repeats(docs, span, gram).withColumn(column, kept("text", "__repeats")).drop("__repeats")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(common.documents(spark, sf_dir))
