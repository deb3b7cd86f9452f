"""Small operators: reports, headers, batches, compressed files, configuration text."""

import gzip
import io
import lzma
import random

import pytest
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import sequences, strings
from quarry.operators import clustering, columns, consensus, joins, lengths, ordering, taxonomy
from quarry.sources import fasta, sinks, tables


def test_exact_quantile_has_no_single_task_result(spark):
    rng = random.Random(4)
    for n, share in ((0, 0.5), (1, 0.9), (2, 0.5), (101, 0.9), (100, 0.9), (57, 0.0), (57, 1.0)):
        values = [float(rng.randrange(20)) for _ in range(n)] + [None]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        want = df.agg(F.percentile("v", share)).first()[0]
        got = consensus.exact_quantile(df, "v", share).first()[0]
        assert got == want or abs(got - want) < 1e-9


def test_median_of_counted_lengths(spark):
    rng = random.Random(5)
    rows = [(g, rng.randrange(1, 9)) for g in "abc" for _ in range(rng.randrange(1, 12))] + [("d", 3), ("d", 8)]
    df = spark.createDataFrame(rows, "g string, l long").withColumn("id", F.monotonically_increasing_id())
    want = {r["g"]: tuple(r)[1:] for r in df.groupBy("g").agg(F.count("*"), F.sum("l"), F.avg("l"), F.median("l")).collect()}
    got = {r["g"]: (r["contigs"], r["total_size_bp"], r["avg_length"], r["median_length"]) for r in lengths.length_stats(df, "g", "l", "id").collect()}
    assert got == want


def test_greedy_rounds_over_a_chain_and_random_graphs(spark):
    rng = random.Random(6)
    for pairs in ([(i, i + 1) for i in range(12)], [(rng.randrange(30), rng.randrange(30)) for _ in range(60)], []):
        pairs = {(a, b) for a, b in pairs if a != b}
        near = pairs | {(b, a) for a, b in pairs}
        want = {}
        for i in range(30):
            if i not in want:
                want[i] = i
                want.update({b: i for a, b in near if a == i and b not in want})
        nodes = spark.createDataFrame([(i, i) for i in range(30)], "id long, place long")
        edges = spark.createDataFrame(sorted(near), "src long, dst long")
        assert {r["id"]: r["centroid"] for r in clustering.greedy_centroids(nodes, edges).collect()} == want


def test_lineages_of_a_cycle_are_an_error(spark):
    tree = spark.createDataFrame([(1, "a", "genus", 2), (2, "b", "family", 1)], "taxid long, name string, rank string, parent long")
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.lineages(tree, most=5)


def test_row_counts_and_bind_warning(spark):
    a, b = spark.range(3), spark.range(5)
    assert {tuple(r) for r in joins.row_counts({"a": a, "b": b}).collect()} == {("a", 3, False), ("b", 5, False)}
    assert {r["equal"] for r in joins.row_counts({"a": a, "c": spark.range(3)}).collect()} == {True}
    with pytest.warns(UserWarning, match="3 and 5"):
        joins.column_bind(a.toDF("x"), b.toDF("y"), ["x"], ["y"])


def test_batches_and_renumbering_over_chunks(spark):
    got = ordering.batches(spark.range(12).withColumn("x", -F.col("id")), ["x"], 5)
    assert {r["id"]: r["batch"] for r in got.collect()} == {i: (11 - i) // 5 for i in range(12)}
    genes = spark.createDataFrame([(c, i, int(i % 3 == 0)) for c in (0, 1) for i in range(6)], "chunk long, i long, first int")
    got = ordering.renumbered(genes, "chunk", ["i"], F.col("first") == 1, 100, "n")
    assert {(r["chunk"], r["i"]): r["n"] for r in got.collect()} == {(c, i): c * 100 + i // 3 + 1 for c in (0, 1) for i in range(6)}
    assert ordering.top_k(genes, ["chunk"], ["i"], 0).count() == 12


def test_samples_rows_and_sizes(spark):
    rows = [("s1", "x", "a", "1", "2"), ("s2", "y", "a", "3", "4"), ("s3", "z", "b", "5", "6")]
    df = spark.createDataFrame(rows, "sample_id string, accession string, assembly string, R1 string, R2 string")
    back = tables.expanded(tables.co_assemblies(df)).select(df.columns)
    assert sorted(map(tuple, back.collect())) == rows
    twice = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a long, b string")
    assert [tuple(r) for r in tables.repeated_rows(twice).collect()] == [(1, None, 2)]
    assert tables.total_gigabytes(spark.createDataFrame([(1.25,), (2.5,)], "gigabytes double")).first()[0] == 3.75


def test_factors_by_position(spark, tmp_path):
    (tmp_path / "f.csv").write_text("name,avg,std,x,factor\nAname,x,y,10.5,2,z,0.75\nBname,3,1,q,1.5\nshort,1\n")
    got = sorted(map(tuple, tables.read_factors(spark, str(tmp_path / "f.csv")).collect()))
    assert got == [("Aname", 10.5, 2.0, 0.75), ("Bname", 3.0, 1.0, 1.5)]


def test_compression_by_first_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(gzip.compress(b">x\nACGT\n"))
    (tmp_path / "b").write_bytes(lzma.compress(b">x\nACGT\n"))
    (tmp_path / "c").write_bytes(b">x\nACGT\n")
    assert {tuple(r) for r in fasta.compression(spark, str(tmp_path)).collect()} == {("a", "gzip"), ("b", "xz"), ("c", None)}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, "b,c", None), (1, "a", 0.5)], "k long, v string, e double")
    out = io.StringIO()
    sinks.print_table(df.orderBy("k"), to=out)
    assert out.getvalue() == 'k,v,e\n1,a,0.5\n2,"b,c",\n'
    assert [r["value"] for r in sinks.hit_lines(df, ["k", "e"], ["k"]).collect()] == ["# k e", "1 0.5", "2 -"]
    sinks.write_sorted(df, str(tmp_path / "t.tsv"), ["k"])
    assert [r["k"] for r in tables.read(spark, str(tmp_path / "t.tsv")).collect()] == ["1", "2"]


def test_filters_and_strings(spark):
    hits = spark.createDataFrame([(1, 1e-5, 50.0, "A"), (2, 20.0, 10.0, "No hit"), (3, None, None, None)], "id long, e double, bits double, best string")
    assert [r["id"] for r in consensus.reported_hits(hits, "e", "bits").collect()] == [1]
    assert [r["id"] for r in consensus.reported_hits(hits, "e", "bits", least_bits=10.0).orderBy("id").collect()] == [1, 2]
    assert [r["id"] for r in consensus.annotated(hits, "best").collect()] == [1]
    assert hits.withColumnRenamed("id", "Unnamed: 0").transform(columns.without_artefacts).columns == ["e", "bits", "best"]
    row = spark.range(1).select(strings.elapsed(F.lit(3725.9)), strings.scrubbed(F.lit("a\t\nb")), strings.run_stamp(F.lit("2024-05-06 07:08:09").cast("timestamp")), lengths.size_tier(F.lit(7), [(5, 1), (10, 2)], 3)).first()
    assert tuple(row) == ("1h 2m 5s", "a b", "20240506_070809", 2)
    pieces = sequences.cut_up(spark.createDataFrame([("c", "A" * 25)], "id string, seq string"), size=10)
    assert [tuple(r) for r in sequences.bed(pieces).orderBy("chromStart").collect()] == [("c", 0, 10, "c.0"), ("c", 10, 25, "c.1")]


def test_configuration_text():
    text = config.defaults()
    assert config.EngineConfig.from_map(config.parse(text)) == config.EngineConfig()
    assert config.parse("min_length: 500 # short\n\nfasta: x.fa\n") == {"min_length": 500, "fasta": "x.fa"}
    with pytest.raises(config.ConfigError):
        config.parse("no value here")
