"""Whole analyses on small fixtures, and the command line."""

from pyspark.sql import functions as F

from quarry.__main__ import parser, run
from quarry.config import EngineConfig
from quarry.plans import pipelines
from quarry.sources import tables


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def scores(spark):
    data = [("k1|provirus_1_20", 5000, "Provirus", 0.99, 3, 1.0), ("k2", 5000, "Linear", 0.8, 6, 9.0), ("k3", 500, "Linear", 0.99, 1, 1.0), ("k4", 9000, "Linear", 0.97, 2, 2.0)]
    return spark.createDataFrame(data, "seq_name string, length long, topology string, virus_score double, n_hallmarks long, marker_enrichment double")


def test_identify(spark):
    cfg = EngineConfig()
    both = pipelines.combined_scores({"s1": scores(spark)}, cfg)
    assert {r[0] for r in both.select("genomad_seq_name").collect()} == {"k1_s1", "k2_s1", "k4_s1"}
    quality = spark.createDataFrame(
        [(1, "k1_s1", "Yes", "Medium-quality", None, None), (2, "k2_s1", "No", "Low-quality", 0.0, None), (3, "k4_s1", "No", "Low-quality", 11.0, None), (4, "other", "No", "High-quality", 1.0, None)],
        "ord int, contig_id string, provirus string, checkv_quality string, contamination double, warnings string",
    )
    passed, plain, other = pipelines.identify(both, quality, cfg)
    assert rows(passed.select("contig_id", "type"), "contig_id") == [("k1_s1", "Provirus (geNomad+CheckV)"), ("k2_s1", "Virus"), ("other", "Virus")]
    assert plain.count() == 2 and other.count() == 1


def test_cluster(spark):
    seqs = spark.createDataFrame([("a", 1, 100), ("b", 2, 90), ("c", 3, 100), ("d", 4, 50)], "id string, ord long, length long")
    aln = lambda q, t, n, tl, o: (o, q, t, 98.0, float(n), 1, n, 1, n, 1e-9, 100.0, float(tl))
    data = [aln("a", "b", 90, 90, 1), aln("b", "a", 90, 100, 2), aln("a", "d", 10, 50, 3), aln("c", "d", 50, 50, 4), aln("a", "a", 100, 100, 5)]
    alns = spark.createDataFrame(data, "ord long, qname string, tname string, pid double, len double, qstart int, qend int, tstart int, tend int, evalue double, qlen double, tlen double")
    assert rows(pipelines.cluster(seqs, alns, EngineConfig()), "id") == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "c")]
    layered = pipelines.cluster(seqs, alns, EngineConfig(cluster_layers=2))
    assert {r["id"]: r["centroid"] for r in layered.collect()} == {"a": "a", "b": "a", "c": "c", "d": "c"}


def test_merges(spark):
    spine = spark.createDataFrame([("x",), ("y",)], "id string")
    one = spark.createDataFrame([("x", "Na", "s")], "Accession string, Host string, Subfamily string")
    two = spark.createDataFrame([("z", "virulent")], "Accession string, TYPE string")
    three = spark.createDataFrame([("x", 3)], "Accession string, Protein_num long")
    got = pipelines.host_table(spine, one, two, three)
    assert got.columns == ["id", "cherry_Host", "phatyp_TYPE", "phavip_Protein_num"]
    assert rows(got, "id") == [("x", None, None, 3), ("y", None, None, None), ("z", None, "virulent", None)]
    cmp = pipelines.tool_comparison({"p": (one.withColumn("ord", F.lit(1)), "Accession"), "q": (None, "name"), "r": (two.withColumn("ord", F.lit(1)), "Accession")})
    assert {r["contig_id"] for r in cmp.collect()} == {"x", "z"} and pipelines.tool_comparison({"q": (None, "name")}) is None


def test_abundance_and_lineage(spark):
    a = spark.createDataFrame([("c1", 1.0, 2.0)], "Contig string, `r/S1_R1_x TPM` double, `r/S1_R1_x Mean` double")
    b = spark.createDataFrame([("c2", 3.0, 4.0)], "Contig string, `r/S2_R1_x TPM` double, `r/S2_R1_x Mean` double")
    got = pipelines.abundance_by_method([a, b], ("tpm", "mean"))
    assert got["tpm"].columns == ["vOTU_id", "S1", "S2"] and rows(got["tpm"], "vOTU_id") == [("c1", 1.0, None), ("c2", None, 3.0)]
    lin = pipelines.lineage_table(spark.createDataFrame([("k", 0.9, "Unclassified"), ("m", 0.8, "V;R;K;P;C;O;F")], "contig_id string, genomad_virus_score double, genomad_taxonomy string"))
    assert rows(lin.select("contig_id", "virus", "family"), "contig_id") == [("k", "Unassigned", None), ("m", "V", "F")]
    bins = spark.createDataFrame([("b.10",), ("b.2",), ("unbinned.1",)], "bin string")
    assert rows(pipelines.renamed_bins(bins, "asm"), "ids") == [("asm_1", "b.2"), ("asm_2", "b.10")]


def test_optional_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("name\tscore\n")
    (tmp_path / "b.tsv").write_text("other\tscore\nx\t1\n")
    for path in (None, str(tmp_path / "none.tsv"), str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")):
        assert tables.read_optional(spark, path, "name") is None
    assert tables.empty(spark, tables.BINS).count() == 0


def test_command_line(spark, tmp_path):
    out = str(tmp_path / "mock")
    run(spark, parser().parse_args(["mock", "--contigs", "5", "--out", out]))
    run(spark, parser().parse_args(["gc", "--fasta", f"{out}/fasta", "--out", str(tmp_path / "gc")]))
    assert spark.read.parquet(str(tmp_path / "gc")).count() == spark.read.parquet(f"{out}/truth").count() >= 5
