"""Readers and writers, on files made here."""

import bz2
import datetime
import gzip
import lzma

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry import adapters
from quarry.sources import fasta, sinks, tables
from quarry.streaming import sources as streaming


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x first one\nAC\nGT\n>y\n>x again\r\nacgt\r\n>z last\nTTT")
    got = fasta.scan_dir(spark, str(tmp_path))
    assert rows(got.select("assembly", "id", "description", "seq", "length"), "ord") == [("a", "x", "x first one", "ACGT", 4), ("a", "y", "y", "", 0), ("a", "x", "x again", "acgt", 4), ("a", "z", "z last", "TTT", 3)]
    assert rows(fasta.last_of_id(got).select("id", "seq"), "id") == [("x", "acgt"), ("y", ""), ("z", "TTT")]
    assert fasta.count(spark, str(tmp_path / "a.fa")) == 4
    fasta.write(got.select("id", "seq"), str(tmp_path / "out"))
    assert rows(fasta.scan(spark, str(tmp_path / "out")).select("id", "seq"), "id", "seq") == [("x", "ACGT"), ("x", "acgt"), ("y", ""), ("z", "TTT")]


def test_fasta_by_content(spark, tmp_path):
    text = "".join(f">r{i} d\nACGT\n\n{'AC' * i}\n" for i in range(50)).encode()
    packed = {"a.txt": text, "b.gz": text, "c.fa": gzip.compress(text), "d.fa": bz2.compress(text), "e.gz": lzma.compress(text), "f.bz2": gzip.compress(text[:700]) + gzip.compress(text[700:]), "g.fa.gz": gzip.compress(text), "h.fa": b""}
    for name, raw in packed.items():
        (tmp_path / name).write_bytes(raw)
    got = fasta.scan(spark, str(tmp_path))
    want = [(f"r{i}", f"r{i} d", "ACGT" + "AC" * i) for i in range(50)]
    for name in list(packed)[:-1]:
        assert rows(got.where(F.col("file") == name).select("id", "description", "seq"), "ord") == want, name
    assert got.count() == 7 * 50 == fasta.count(spark, str(tmp_path))
    assert dict(rows(fasta.compression(spark, str(tmp_path)))) == {"a.txt": None, "b.gz": None, "c.fa": "gzip", "d.fa": "bzip2", "e.gz": "xz", "f.bz2": "gzip", "g.fa.gz": "gzip"}
    assert rows(fasta.scan(spark, str(tmp_path / "e.gz")).agg(F.sum("length"))) == [(50 * 4 + 2 * sum(range(50)),)]
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "cut.fa").write_bytes(gzip.compress(text)[:-20])
    with pytest.raises(Exception, match="ends too early"):
        fasta.scan(spark, str(tmp_path / "z")).count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        fasta.scan(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_records_do_not_depend_on_parts(step):
    text = b">a\nAC\n>b\n>c x\nG\n"
    for raw in (text, gzip.compress(text), bz2.compress(text) + bz2.compress(b">d\nT"), lzma.compress(text)):
        got = [r for r in fasta.record_parts(fasta.unpacked(raw, step)) if r.strip()]
        assert got[:3] == [b"a\nAC", b"b", b"c x\nG" + (b"" if len(got) > 3 else b"\n")] and got[3:] in ([], [b"d\nT"])


def test_sniffing(spark, tmp_path):
    for name, text, sep in (("a.txt", "a;b\n1;2\n3;4\n", ";"), ("b.csv", "a\n1\n", ","), ("c.dat", "x\n", "\t")):
        (tmp_path / name).write_text(text)
        assert tables.sniff(spark, str(tmp_path / name)) == sep
    with pytest.raises(ValueError):
        tables.by_name("x.dat")


def test_alignments(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("q\tt\t99.5\t10\t0\t0\t10\t1\t5\t14\t1e-9\t50\t100\t200\n")
    r = tables.read_alignments(spark, str(tmp_path / "x.tsv")).first()
    assert (r["qstart"], r["qend"], r["tstart"], r["tend"], r["qlen"]) == (1, 10, 5, 14, 100.0)


def test_sample_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("# comment\nsample_id,accession,assembly,R1,R2\ns1,,co,,\n ,ACC,,/a_1,/a_2\ns3,,co,,\n,,,,\ns3,X,,,\n")
    got = tables.completed_samples(tables.read_samples(spark, str(tmp_path / "s.csv")), "/d/")
    assert ("ACC", "ACC", "ACC", "/a_1", "/a_2") in rows(got) and ("s1", None, "co", "/d/s1_1.fastq.gz", "/d/s1_2.fastq.gz") in rows(got)
    assert rows(tables.sample_problems(got), "problem") == [(None, "no sample id or accession"), ("s3", "occurs more than once")]
    co = tables.co_assemblies(got.where("assembly = 'co'")).first()
    assert co["sample_id"] == ["s1", "s3"]


def test_reports(spark, tmp_path):
    (tmp_path / "s1.json").write_text('{"summary": {"before_filtering": {"total_reads": 10, "total_bases": 100, "gc_content": 0.5}, "after_filtering": {"total_reads": 8, "total_bases": 80, "gc_content": 0.4}}}')
    r = tables.read_qc_reports(spark, str(tmp_path / "s1.json")).first()
    assert (r["sample"], r["total_reads_before_filtering"], r["gc_content_after_filtering"]) == ("s1", 10, 0.4)
    (tmp_path / "runs.xml").write_text('<SET><RUN accession="R1"><SRAFiles><SRAFile size="1073741824"/><SRAFile size="5400000"/></SRAFiles></RUN><RUN accession="R2"/></SET>')
    got = tables.read_runs(spark, str(tmp_path / "runs.xml"))
    assert rows(got, "accession", "gigabytes") == [("R1", 0.01), ("R1", 1.0), ("R2", None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    sinks.write_table(df, str(tmp_path / "t.csv"), single=True)
    assert rows(tables.read(spark, str(tmp_path / "t.csv"), df.schema, ","), "id") == [(1, "a"), (2, None)]
    assert sinks.write_json_if_changed(df, str(tmp_path / "j"), ["id"]) is True
    assert sinks.write_json_if_changed(df, str(tmp_path / "j"), ["id"]) is False
    lines = sinks.cluster_lines(spark.createDataFrame([(5, "5,1")], "centroid long, members string"))
    assert rows(lines) == [("5\t5,1",)]


def test_adapter(spark):
    a = adapters.REGISTRY["binner"]
    seqs = spark.createDataFrame([("c1", "ACGT")], "id string, seq string")
    got = a.run(seqs.withColumnRenamed("id", "id"), lambda b: pd.DataFrame({"contig": b["id"], "bin": "b1"}))
    assert rows(got) == [("c1", "b1")]
    with pytest.raises(adapters.ContractError):
        a.run(seqs.drop("seq"), lambda b: b)


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = "k string, ts timestamp"
    one = spark.createDataFrame([("a", datetime.datetime(2024, 1, 1))], schema)
    for _ in range(2):
        one.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streaming.append(streaming.arriving(spark, str(tmp_path / "in"), one.schema).select("k"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    counts = streaming.windowed_counts(spark.read.parquet(str(tmp_path / "in")), "ts", "k", "1 day")
    assert [r["events"] for r in counts.select(F.col("events")).collect()] == [2]
