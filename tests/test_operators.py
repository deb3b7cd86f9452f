"""Edge cases of the operators, on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.config import ConfigError, EngineConfig, sample_id
from quarry.functions import sequences, strings
from quarry.operators import alignment, clustering, columns, consensus, joins, lengths, ordering, profile, sets, synth, taxonomy


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def n_stats(values):
    """Sequential model: upwards, the row that sets N50 never sets N90."""
    size, run, n50, n90 = sum(values), 0, 0, 0
    for v in sorted(values):
        run += v
        if not n50 and run >= 0.5 * size:
            n50 = v
        elif not n90 and run >= 0.1 * size:
            n90 = v
    return n50, n90


def test_length_stats_match_the_sequential_model(spark):
    rng = random.Random(5)
    groups = {"one": [7], "quirk": [1, 20, 21], "equal": [5] * 4, **{f"r{i}": [rng.randint(1, 30) for _ in range(rng.randint(1, 25))] for i in range(25)}}
    df = spark.createDataFrame([(g, i, v) for g, vs in groups.items() for i, v in enumerate(vs)], "g string, i long, l long")
    got = {r["g"]: (r["n50_length"], r["n90_length"]) for r in lengths.length_stats(df, "g", "l", "i").collect()}
    assert got == {g: n_stats(vs) for g, vs in groups.items()}
    assert got["one"] == (7, 0) and got["quirk"] == (20, 21)


def test_size_distribution_leaves_out_empty_thresholds(spark):
    df = spark.createDataFrame([("a", 50), ("a", 100), ("b", 300)], "g string, l long")
    got = rows(lengths.size_distribution(df, "g", "l").select("g", "min_length", "num_contigs", "total_length"), "g", "min_length")
    assert got == [("a", 0, 2, 150), ("a", 100, 1, 100), ("b", 0, 1, 300), ("b", 100, 1, 300), ("b", 250, 1, 300)]


def test_strict_union_names_what_differs(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(4, 3)], "y int, x int")
    assert rows(sets.strict_union([a, b]), "x") == [(1, 2), (3, 4)]
    with pytest.raises(sets.ColumnMismatch, match=r"missing \['y'\], extra \['z'\]"):
        sets.strict_union([a, b.withColumnRenamed("y", "z")])


def test_affixes_need_the_number_of_tables(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert columns.affixed([a, a], ["p_", "q_"], None)[1].columns == ["q_x"]
    with pytest.raises(ValueError):
        columns.affixed([a, a], ["p_"], None)


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, `S1 TPM` int, Subfamily_x int")
    assert columns.containing(df, "tpm", ["id"]).columns == ["id", "S1 TPM"]
    assert columns.without(df, "subfamily").columns == ["id", "S1 TPM"]
    assert columns.prefixed_unless(df.select("id").withColumn("checkv_a", F.lit(1)), "checkv_", ["id"]).columns == ["id", "checkv_a"]
    assert strings.sample_of_column("ref/S1_R1_x TPM") == "S1" and strings.sample_of_column("plain") is None


def test_strings(spark):
    df = spark.createDataFrame([("k1|provirus_1_20", "c_1 1-20/30", "a b||c", "a||b c", "  ")], "a string, b string, c string, d string, e string")
    got = df.select(strings.strip_region(F.col("a")), strings.strip_fragment(F.col("b")), strings.clean_id(F.col("c")), strings.clean_id(F.col("d")), strings.blank_to_null(F.col("e"))).first()
    assert tuple(got) == ("k1", "c", "a", "a", None)
    nulls = strings.null_values(spark.createDataFrame([("Na", "Nab")], "a string, b string"), ["Na"])
    assert rows(nulls) == [(None, "Nab")]


def test_ordinal_and_column_bind(spark):
    a = spark.range(100).repartition(7)
    got = ordering.ordinal(a, [F.desc("id")]).collect()
    assert all(r["ord"] == 100 - r["id"] for r in got)
    short = spark.createDataFrame([(5,), (3,)], "k int")
    bound = joins.column_bind(a.where("id < 3"), short, ["id"], ["k"]).orderBy("ord").select("id", "k")
    assert rows(bound) == [(0, 3), (1, 5), (2, None)]


def test_runs_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b"), (6, "a")], "o int, v string").withColumn("g", F.lit(1))
    assert [r[0] for r in rows(ordering.with_runs(df, ["g"], ["o"], "v").select("run"), "run")] == [1, 1, 2, 2, 3, 4]
    assert [r[0] for r in rows(ordering.adjacent_distinct(df, ["g"], ["o"], "v").select("o"), "o")] == [1, 3, 5, 6]
    assert [r[0] for r in rows(ordering.adjacent_single(df, ["g"], ["o"], "v").select("o"), "o")] == [5, 6]


def test_best_hit_ties_and_default(spark):
    q = spark.createDataFrame([("p1",), ("p2",)], "query string")
    h = spark.createDataFrame([("p1", 5.0, 2, "late"), ("p1", 5.0, 1, "first"), ("p1", 1.0, 0, "weak")], "query string, score double, ord int, marker string")
    assert rows(joins.best_hit(q, h, "query", "score", ["ord"], ["marker"], {"marker": "No hit"}), "query") == [("p1", "first"), ("p2", "No hit")]


def test_early_stop_and_coverage(spark):
    a = spark.createDataFrame([("p", 1, 60, 0.0), ("p", 2, 999, 1.0), ("p", 3, 40, 0.0), ("p", 4, 10, 0.0), ("q", 1, 111, 0.0)], "pair string, ord int, n int, evalue double")
    kept = alignment.early_stop(a, ["pair"], ["ord"], "n", F.lit(100))
    assert rows(kept.select("pair", "ord"), "pair", "ord") == [("p", 1), ("p", 3)]  # the row not admitted neither counts nor stops; q vanishes
    spans = spark.createDataFrame([("x", 1, 10), ("x", 11, 20), ("x", 5, 12), ("x", 30, 30)], "k string, s int, e int")
    assert rows(alignment.covered_length(spans, ["k"], "s", "e")) == [("x", 21)]


def test_consensus_edges(spark):
    schema = "id string, ord int, label string, cont double, warn string, qual string, hall int, score double, enr double"
    data = [
        ("edge", 1, "Virus", 10.0, None, "High-quality", 0, 0.0, 0.0),
        ("null contamination", 1, "Virus", None, None, "High-quality", 0, 0.0, 0.0),
        ("provirus", 1, "Provirus", None, None, None, 0, 0.0, 0.0),
        ("warned", 1, "Provirus", 1.0, ">1 viral region detected", "High-quality", 0, 0.0, 0.0),
        ("nearly warned", 1, "Provirus", 1.0, ">1 viral region detected!", "High-quality", 0, 0.0, 0.0),
        ("rescued", 1, "Virus", 1.0, None, "Low-quality", 5, 0.95, 0.0),
        ("lost", 1, "Virus", 1.0, None, "Low-quality", 0, 0.98, 0.0),
        ("enriched", 1, "Virus", 1.0, None, "Not-determined", 0, 0.0, 50.0),
        ("twice", 1, "Virus", 1.0, None, "Low-quality", 6, 0.90, 0.0),
        ("twice", 2, "Virus", 1.0, None, "High-quality", 0, 0.0, 0.0),
    ]
    names = {"label": "label", "contamination": "cont", "warnings": "warn", "quality": "qual", "hallmarks": "hall", "score": "score", "enrichment": "enr"}
    got = consensus.consensus(spark.createDataFrame(data, schema), "id", ["ord"], names)
    assert rows(got.select("id", "ord"), "id") == [("edge", 1), ("enriched", 1), ("nearly warned", 1), ("provirus", 1), ("rescued", 1), ("twice", 2)]


def sequential_greedy(order, edges):
    owner = {}
    for a in order:
        if a not in owner:
            owner[a] = a
            for b in edges.get(a, ()):
                owner.setdefault(b, a)
    return owner


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_rounds_match_the_sequential_model(spark, seed):
    rng = random.Random(seed)
    n = 40
    pairs = {(rng.randrange(n), rng.randrange(n)) for _ in range(80)} | {(0, 1), (1, 2), (2, 3)}
    pairs = {(a, b) for a, b in pairs if a != b}
    edges = {}
    for a, b in sorted(pairs):
        edges.setdefault(a, []).append(b)
    want = sequential_greedy(range(n), edges)
    nodes = spark.range(n).select("id", F.col("id").alias("place"))
    got = dict(rows(clustering.greedy_centroids(nodes, spark.createDataFrame(sorted(pairs), "src long, dst long"))))
    assert got == want


@pytest.mark.parametrize("most", [4, 1000])
def test_shared_kmers_counts_all_pairs(spark, most):
    rng = random.Random(7)
    common = "".join(rng.choices("ACGT", k=30))
    seqs = {i: common[i % 5 :] + "".join(rng.choices("ACGT", k=20)) for i in range(30)}
    sets = {i: {s[j : j + 8] for j in range(len(s) - 7)} for i, s in seqs.items()}
    want = sorted((a, b, len(sets[a] & sets[b])) for a in seqs for b in seqs if a < b and len(sets[a] & sets[b]) >= 20)
    got = clustering.shared_kmers(spark.createDataFrame(list(seqs.items()), "id long, seq string"), 8, 20, most)
    assert sorted((r["src"], r["dst"], r["shared"]) for r in got.collect()) == want and len(want) > 200


def test_clusters_list_the_centroid_first(spark):
    df = spark.createDataFrame([(1, 5), (5, 5), (2, 2)], "id long, centroid long")
    assert rows(clustering.clusters(df), "centroid") == [(2, 1, "2"), (5, 2, "5,1")]


def test_parts_need_enough_rows(spark):
    with pytest.raises(ValueError):
        clustering.balanced_parts(spark.range(2), ["id"], 3)


def test_mock_data_do_not_depend_on_partitioning(spark):
    a = synth.mock_contigs(spark, 12, most=400).orderBy("sequence_id").collect()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
    b = synth.mock_contigs(spark, 12, most=400).orderBy("sequence_id").collect()
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert a == b and all(len(r["seq"]) == r["length"] for r in a)
    by = {(r["true_cluster"], r["strain_mutated"], r["duplication_copy"]): r["seq"] for r in a}
    for (c, strain, copy), seq in by.items():
        original = by[c, "No", 0]
        different = sum(x != y for x, y in zip(seq, original))
        assert different == 0 if strain == "No" else different < 0.1 * len(seq)


def test_cut_up_joins_the_rest(spark):
    df = spark.createDataFrame([("a", "x" * 25), ("b", "y" * 3), ("c", "")], "id string, seq string")
    got = rows(sequences.cut_up(df, "seq", 10).select("id", "piece", "start", "end", F.length("seq")), "id", "piece")
    assert got == [("a", 0, 0, 10, 10), ("a", 1, 10, 25, 15), ("b", 0, 0, 3, 3), ("c", 0, 0, 0, 0)]


def test_lineage_is_lenient(spark):
    df = spark.createDataFrame([("a;b",), (None,)], "l string")
    assert {tuple(r) for r in taxonomy.split_lineage(df, "l", ("x", "y", "z")).drop("l").collect()} == {("a", "b", None), (None, None, None)}


def test_majority_vote_decisions(spark):
    hits = spark.createDataFrame([("c1", "g1", None), ("c1", "g1", None), ("c1", "g2", None), ("c2", "g1", "f1"), ("c2", "g2", "f1"), ("c2", "g3", "f1"), ("c3", None, None)], "contig string, genus string, family string")
    totals = hits.groupBy("contig").agg(F.count("*").alias("total_prot"))
    factors = spark.createDataFrame([("g1", 1.0, 10.0, 1.0)], "taxon string, factor double, avg_cds double, std_cds double")
    got = {r["contig"]: (r["rank"], r["taxon"], r["decision"]) for r in taxonomy.majority_vote(hits, "contig", totals, factors, ("genus", "family")).collect()}
    assert got == {"c1": ("genus", "g1", "taxon"), "c2": ("family", None, "none")}


def test_profiles(spark):
    df = spark.createDataFrame([("a", "s1", 1.0), ("b", "s1", 3.0), ("a", "s2", 0.0)], "feature string, sample string, value double")
    assert rows(profile.per_million(df, "sample", "value").select("feature", "sample", "cpm"), "sample", "feature") == [("a", "s1", 250000.0), ("b", "s1", 750000.0), ("a", "s2", None)]
    groups = spark.createDataFrame([("a", "G1"), ("a", "G2")], "feature string, group string")
    assert rows(profile.regrouped(df.where("sample = 's1'"), groups, "feature", "sample", "value"), "group") == [("G1", "s1", 1.0), ("G2", "s1", 1.0), ("UNGROUPED", "s1", 3.0)]


def test_config():
    assert EngineConfig.from_map({"min_length": 5}, {"min_length": None, "min_score": 0.5}) == EngineConfig(min_length=5, min_score=0.5)
    for bad in ({"cluster_layers": 9}, {"min_score": 2}, {"nothing": 1}, {"fasta": "a", "fasta_dir": "b"}):
        with pytest.raises(ConfigError):
            EngineConfig.from_map(bad)
    with pytest.raises(ConfigError):
        sample_id("a b")
