"""FASTA files as DataFrames (file, ord, id, description, seq, length), and back.

How a file is compressed follows from its first bytes, whatever its name says.  Files whose name fits go to Spark's text
reader, which splits plain and bzip2 files and takes up records at their starts; others (also xz, which Spark doesn't know)
are read whole by a task, up to the 2 GB of a binary cell, and taken apart as they are unpacked.
"""

from __future__ import annotations

import bz2
import lzma
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EXTENSIONS = (".fa", ".fasta", ".fna")
#: The first bytes of compressed files, and the endings by which Spark's text reader unpacks a file.
MAGIC = {"gzip": "1F8B", "bzip2": "425A68", "xz": "FD377A585A00"}
ENDINGS = {".gz": "gzip", ".bz2": "bzip2", ".deflate": "zlib", ".zst": "zstd", ".lz4": "lz4", ".snappy": "snappy"}
_RECORDS = "file string, ord long, v string"


def _files(spark: SparkSession, path: str | list[str]) -> dict[str, str]:
    """path -> kind of the files that a path, folder or pattern names; looks at six bytes of each."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in [path] if isinstance(path, str) else path:
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        for status in fs.globStatus(at) or []:
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [(fs, s) for s in inside if s.isFile() and s.getLen() and not s.getPath().getName().startswith(("_", "."))]

    def kind(x) -> tuple[str, str]:
        fs, status = x
        stream = fs.open(status.getPath())
        try:
            start = bytes(b & 255 for b in (stream.read() for _ in range(6)) if b >= 0).hex().upper()
        finally:
            stream.close()
        return status.getPath().toString(), next((k for k, m in MAGIC.items() if start.startswith(m)), "plain")

    with ThreadPoolExecutor(16) as pool:  # a short read for each file
        return dict(pool.map(kind, found))


def kind_of_name(path: str) -> str:
    return next((k for e, k in ENDINGS.items() if path.endswith(e)), "plain")


def compression(spark: SparkSession, path: str) -> DataFrame:
    """(file, kind): how files are compressed, by their first bytes; null for plain ones."""
    rows = [(p.rsplit("/", 1)[-1], None if k == "plain" else k) for p, k in _files(spark, path).items()]
    return spark.createDataFrame(rows, "file string, kind string")


def unpacked(raw: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content in parts; several gzip, bzip2 or xz streams may follow each other."""
    start = raw[:6].hex().upper()
    kind = next((k for k, m in MAGIC.items() if start.startswith(m)), None)
    if kind is None:
        yield raw
        return
    make = {"gzip": lambda: zlib.decompressobj(31), "bzip2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor}[kind]
    d, at = make(), 0
    while at < len(raw):
        part = raw[at : at + step]
        at += len(part)
        while part:
            if d.eof:  # another stream, or zeros that fill up the file
                if kind != "bzip2" and not (part := part.lstrip(b"\0")):
                    break
                d = make()
            yield d.decompress(part)
            part = d.unused_data if d.eof else b""
    if not d.eof:
        raise ValueError("a compressed file ends too early")


def record_parts(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Records, each without the mark at its start."""
    rest = b"\n"
    for part in parts:
        *records, rest = (rest + part).split(b"\n>")
        yield from records
    yield rest


def _whole(spark: SparkSession, paths: list[str]) -> DataFrame:
    def each(batches):
        for b in batches:
            for path, raw in zip(b.column("path"), b.column("content")):
                file, at, held, size = path.as_py().rsplit("/", 1)[-1], 0, [], 0
                for r in record_parts(unpacked(raw.as_py())):
                    if r.strip():
                        held.append((at, r.decode("utf-8", "replace")))
                        at, size = at + 1, size + len(r)
                    if size > 8 << 20:
                        yield _batch(file, held)
                        held, size = [], 0
                if held:
                    yield _batch(file, held)

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(each, _RECORDS)


def _batch(file: str, held: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file] * len(held)), pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.string())], names=["file", "ord", "v"])


def scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of FASTA files, plain, gzip, bzip2 or xz, one row each; blanks in sequences are dropped.

    ord grows along a file; empty files have no rows.
    """
    kinds = _files(spark, path)
    named = [p for p, k in kinds.items() if kind_of_name(p) == k]
    other = [p for p in kinds if p not in set(named)]
    parts = []
    if named or not other:
        lines = spark.read.option("lineSep", "\n>").text(named or path)
        parts.append(lines.select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("ord"), F.regexp_replace("value", "^>", "").alias("v")))
    if other:
        parts.append(_whole(spark, other).withColumn("v", F.regexp_replace("v", "^\n?>?", "")))
    records = (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).where(F.trim("v") != "")
    head = F.regexp_replace(F.split("v", "\n", 2)[0], r"\r$", "")
    body = F.regexp_replace(F.coalesce(F.get(F.split("v", "\n", 2), F.lit(1)), F.lit("")), r"\s", "")
    out = records.select("file", "ord", F.split(head, r"\s", 2)[0].alias("id"), head.alias("description"), body.alias("seq"))
    return out.withColumn("length", F.length("seq").cast("long"))


def last_of_id(seqs: DataFrame) -> DataFrame:
    """One row per id: the last of equal ids."""
    w = Window.partitionBy("id").orderBy(F.desc("ord"))
    return seqs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def scan_dir(spark: SparkSession, folder: str) -> DataFrame:
    """All FASTA files of a folder, with assembly: the file's name without its last extension."""
    glob = "{" + ",".join(f"*{e}" for e in EXTENSIONS) + "}"
    lines = scan(spark, f"{folder.rstrip('/')}/{glob}")
    return lines.withColumn("assembly", F.regexp_replace("file", r"\.[^.]*$", ""))


def records(seqs: DataFrame, header: str = "id") -> DataFrame:
    return seqs.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col("seq")).alias("value"))


def write(seqs: DataFrame, path: str, header: str = "id", order: str | None = None) -> None:
    """A folder of FASTA text files; with an order, sequences are sorted over all files."""
    out = seqs.orderBy(order) if order else seqs
    records(out, header).write.text(path)


def count(spark: SparkSession, path: str) -> int:
    """Records, by the marks at their starts, however files are compressed."""
    return scan(spark, path).count()
