"""Depths, published tables, sorted files, deep lineages, many samples, factors."""

import os
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.operators import coverage, profile, taxonomy
from quarry.sources import coordinate, published, tables


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.mark.parametrize("limit", [None, 10])
def test_depths_against_positions(spark, limit):
    rng = random.Random(2)
    lengths = {"hot": 400, "b": 30, "none": 12, "one": 1}
    alns = [(c, s, s + rng.randint(-1, 60)) for c, n in [("hot", 300), ("b", 9), ("one", 2), ("other", 3)] for s in (rng.randint(-20, 420) if c != "one" else 1 for _ in range(n))]
    got = coverage.depths(spark.createDataFrame(alns, "contig string, start long, end long"), spark.createDataFrame(list(lengths.items()), "contig string, length int"), limit=limit)
    for r in got.collect():
        depth = [sum(c == r["contig"] and s <= i <= e for c, s, e in alns) for i in range(1, lengths[r["contig"]] + 1)]
        assert (r["covered"], r["most"], r["mean"]) == (sum(d > 0 for d in depth), max(depth), pytest.approx(statistics.mean(depth)))
        assert r["variance"] == (pytest.approx(statistics.variance(depth)) if len(depth) > 1 else None)
    assert got.count() == 4


def test_published_versions(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    assert not published.is_done(spark, path)
    with pytest.raises(published.NotPublished):
        published.read(spark, path)
    assert published.publish(df, path) == 1
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    seen = published.read(spark, path)
    with pytest.raises(Exception, match="lost"):
        published.publish(broken, path)
    assert published.read(spark, path).count() == 3 == seen.count()  # a writer that dies leaves what was there
    spark.range(9).write.parquet(f"{path}/versions/underway")
    assert published.read(spark, path).count() == 3  # a version without an entry isn't seen
    assert published.publish(spark.range(7), path) == 2 and published.read(spark, path).count() == 7 and published.read(spark, path, 1).count() == 3 == seen.count()
    published.reset(spark, path)
    assert not published.is_done(spark, path)
    made = []
    for _ in range(2):
        assert published.publish_once(lambda: made.append(1) or spark.range(4), spark, path).count() == 4
    assert made == [1] and published.last(spark, path)["number"] == 4
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        published._enter(spark, path, 4, "x", 0, "")
    assert published.clear(spark, path) == 4 and published.read(spark, path).count() == 4  # a half-written one, one underway, two older


def test_lookups_read_few_files(spark, tmp_path):
    rng = random.Random(4)
    ivs = [(rng.choice("ab"), s, s + rng.choice([5, 50, 40_000]), i) for i in range(3000) for s in [rng.randint(0, 1_000_000)]] + [("c", 1, 10**6, -1)]
    path = str(tmp_path / "sorted")
    coordinate.write_sorted(spark.createDataFrame(ivs, "contig string, start long, end long, i long"), path, files=24)
    total = len([f for f in os.listdir(f"{path}/rows") if f.endswith(".parquet")])
    for c, first, last in (("a", 500_000, 500_900), ("b", 0, 10), ("b", 999_999, 999_999), ("c", 700_000, 700_000), ("z", 1, 5)):
        got = coordinate.lookup(spark, path, c, first, last)
        assert rows(got.select("i"), "i") == [(i,) for i in sorted(i for x, s, e, i in ivs if x == c and s <= last and e >= first)]
        files = coordinate.files_of(spark, path, c, first, last)
        assert len(files) <= 4 < total and len(got.inputFiles()) <= max(len(files), 1) if files else got.count() == 0
    asked = [(k, rng.choice("abz"), s, s + rng.choice([0, 30_000])) for k in range(20) for s in [rng.randint(0, 10**6)]]
    got = coordinate.lookups(spark, path, spark.createDataFrame(asked, "ask long, contig string, first long, last long"))
    assert rows(got.select("ask", "i"), "ask", "i") == sorted((k, i) for k, c, f, z in asked for x, s, e, i in ivs if x == c and s <= z and e >= f)


def test_lineages_of_a_thousand_levels(spark):
    tree = [(i, f"n{i}", {0: "class", 500: "order", 999: "genus"}.get(i, "none"), max(i - 1, 0)) for i in range(1000)] + [(5000, "alone", "genus", 77_777)]
    got = {r["taxid"]: r for r in taxonomy.lineages(spark.createDataFrame(tree, "taxid long, name string, rank string, parent long")).collect()}
    assert len(got) == 1001 and (got[999]["genus"], got[999]["order"], got[999]["class"]) == ("n999", "n500", "n0") and got[499]["order"] is None
    assert got[5000]["genus"] == "alone"
    cycle = spark.createDataFrame([(i, "x", "genus", (i + 1) % 5) for i in range(5)] + [(i, "y", "genus", i - 1) for i in range(5, 40)], "taxid long, name string, rank string, parent long")
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.lineages(cycle)


def test_many_samples_in_one_scan(spark, tmp_path):
    paths = {}
    for i in range(60):
        f = tmp_path / f"s {i}+é%.tsv"
        f.write_text("feature\tvalue\n" + "".join(f"f{j}\t{i * j}\n" for j in range(3)))
        paths[f"s{i}"] = str(f)
    schema = tables.schema(feature=tables._S, value=tables._L)
    got = tables.read_named(spark, paths, schema)
    assert got.count() == 180 and {(r["sample_id"], r["value"]) for r in got.where("feature = 'f2'").collect()} == {(f"s{i}", 2 * i) for i in range(60)}
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().split("Relation"))
    assert size(got) == size(tables.read_named(spark, dict(list(paths.items())[:2]), schema))  # the same plan for any number of files
    (tmp_path / "other.csv").write_text("extra,feature\n1,x\n")
    loose = tables.read_named(spark, paths | {"o": str(tmp_path / "other.csv")})
    assert loose.count() == 181 and rows(loose.where("sample_id = 'o'").select("feature", "value", "extra")) == [("x", None, "1")]
    places = spark.createDataFrame([(f"s{i}", i) for i in range(60)], "sample_id string, place long")
    wide = profile.column_blocks(got, "feature", "sample_id", "value", places, 25)
    held = {(r["feature"], r["block"]): r["values"] for r in wide.collect()}
    assert held["f1", 1] == [float(i) for i in range(25, 50)] and held["f2", 2] == [2.0 * i for i in range(50, 60)] + [0.0] * 15


def test_factors_of_any_form(spark, tmp_path):
    f = tmp_path / "f.csv"
    f.write_text('name,avg,std,x,factor\nA,-1.5,1e2,q,0.75\n"B, b",x,3,+2,"a,b", .5 \r\nshort,1\n')
    assert sorted(rows(tables.read_factors(spark, str(f)))) == [("A", -1.5, 100.0, 0.75), ("B, b", 3.0, 2.0, 0.5)]
    f.write_text("name,avg,std,x,factor\nA,1,many,q,0.75\n")
    with pytest.raises(Exception, match="no number: many"):
        tables.read_factors(spark, str(f)).collect()


def test_refinement_equals_one_by_one(spark):
    from quarry.operators import refinement

    rng = random.Random(9)
    for n, m in ((12, 40), (30, 25)):
        bins = {f"b{i:02d}": {rng.randint(0, m) for _ in range(rng.randint(1, 12))} for i in range(n)} | {"twin": {1, 2, 3}, "twin2": {1, 2, 3}}
        weight = {c: rng.choice([0, 1, 2, 5]) for c in range(m)}
        left, want = {b: {c for c in cs if c in weight} for b, cs in bins.items()}, []
        while left and (best := min((-sum(weight[c] for c in cs), b) for b, cs in left.items()))[0] < 0:
            taken = left.pop(best[1])
            want += [(c, best[1], -best[0]) for c in taken]
            left = {b: cs - taken for b, cs in left.items()}
        pairs = spark.createDataFrame([(b, c) for b, cs in bins.items() for c in cs] + [("b00", min(bins["b00"]))], "bin string, contig int")
        got = refinement.refined(pairs, spark.createDataFrame(list(weight.items()), "contig int, weight int"))
        assert rows(got.select("contig", "bin", "score"), "contig") == sorted(want)
    assert refinement.refined(pairs.limit(0), spark.createDataFrame([(1, 1)], "contig int, weight int")).count() == 0


def test_refinement_of_one_large_component_and_of_many_small_ones(spark, monkeypatch):
    from decimal import Decimal

    from quarry.operators import refinement

    rounds = []
    made = refinement._in_order
    monkeypatch.setattr(refinement, "_in_order", lambda *a: rounds.append(1) or made(*a))
    rng = random.Random(4)
    # all of 150 bins wait for each other; 40 pairs of bins share a contig of their own; a chain of 60
    bins = {i: {rng.randint(0, 399) for _ in range(40)} for i in range(150)} | {1000 + i: {1000 + i // 2, 2000 + i} for i in range(80)} | {3000 + i: {3000 + i, 3001 + i} for i in range(60)}
    kinds = {"long": lambda: rng.choice([0, 1, 2, 5, 9]), "double": lambda: rng.choice([0.1, 0.2, 0.7, 1e-9]), "decimal(12,3)": lambda: Decimal(rng.randint(0, 5000)).scaleb(-3)}
    for kind, weigh in kinds.items():
        weight = {c: weigh() for cs in bins.values() for c in cs}
        exact = {c: Fraction(w) for c, w in weight.items()}
        left, want = dict(bins), set()
        while left and (best := min((-sum(exact[c] for c in cs), b) for b, cs in left.items()))[0] < 0:
            taken = left.pop(best[1])
            want |= {(c, best[1], -best[0]) for c in taken}
            left = {b: cs - taken for b, cs in left.items()}
        pairs = spark.createDataFrame([(b, c) for b, cs in bins.items() for c in cs], "bin long, contig long")
        for limit, most in ((10_000, 1),) if kind != "long" else ((3000, 8),):
            rounds.clear()
            got = sorted(rows(refinement.refined(pairs, spark.createDataFrame(list(weight.items()), f"contig long, weight {kind}"), limit=limit)))
            assert len(rounds) <= most  # of 150 and more that a round for each waiting bin takes
            assert [r[:2] for r in got] == [(c, b) for c, b, _ in sorted(want)]
            assert all(r[2] == (float(s) if kind == "double" else s) for r, (_, _, s) in zip(got, sorted(want)))
    few = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 3), (2, 4)], "bin long, contig long")
    got = refinement.refined(few, spark.createDataFrame([(c, 1) for c in (1, 2, 3, 4)], "contig long, weight long"), limit=2)
    assert sorted(rows(got)) == [(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 2, 1)]  # a bin beyond the limit by itself


def test_edges_by_groups_are_counted_as_pairs_are(spark, monkeypatch):
    from quarry.operators import clustering

    monkeypatch.setattr(clustering, "BLOCK_COLUMNS", 3)
    rng = random.Random(6)
    # hot groups, rare ones, exact copies, near copies of many groups, groups of one node, nodes without any
    held = {i: {g for g in range(6) if rng.random() < 0.5 / (g + 1)} | {rng.randint(10, 60) for _ in range(rng.randint(0, 2))} | {1000 + i} for i in range(120)}
    held |= {200 + i: {1, 2, 70} for i in range(9)} | {300 + i: set(range(80, 92)) - {80 + i % 12} | {1} for i in range(30)} | {400: set(), 401: {500}}
    edges = sum(1 for a in held for b in held if a != b and held[a] & held[b])
    alone = sum(1 for a in held if not any(a != b and held[a] & held[b] for b in held))
    nodes = spark.createDataFrame([(i,) for i in held], "id long")
    members = spark.createDataFrame([(i, g) for i, gs in held.items() for g in gs] + [(200, 1)], "id long, group long")
    for join, block in ((100, 2000), (3, 8)):
        assert rows(clustering.group_counts(nodes, members, join, block)) == [(len(held), edges, alone, alone)]
    assert rows(clustering.group_counts(nodes, members.limit(0))) == [(len(held), 0, len(held), len(held))]


def test_dereplication_by_score(spark):
    from quarry.operators import refinement

    genomes = spark.createDataFrame([("a", 50.0), ("b", 90.0), ("c", 90.0), ("d", None)], "id string, score double")
    near = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "d")], "src string, dst string")
    assert dict(rows(refinement.dereplicated(genomes, near, "score"))) == {"a": "b", "b": "b", "c": "b", "d": "d"}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from quarry.operators import clustering

    nodes = spark.range(3000).select("id", F.col("id").alias("place"))
    edges = spark.range(2999).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    written = []
    keep, clustering.materialise = clustering.materialise, lambda df, name="table": written.append(name) or keep(df, name)
    try:
        got = clustering.greedy_centroids(nodes, edges).collect()
    finally:
        clustering.materialise = keep
    assert {r["id"]: r["centroid"] for r in got} == {i: i - i % 2 for i in range(3000)} and len(written) < 5
    rng = random.Random(8)
    pairs = {(rng.randrange(60), rng.randrange(60)) for _ in range(150)}
    near = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in pairs], "src string, dst string")
    near = near.union(near.select("dst", "src"))
    some = spark.createDataFrame([(f"n{i}", (i * 37) % 60) for i in range(60)], "id string, place int")
    assert rows(clustering.greedy_centroids(some, near), "id") == rows(clustering.greedy_centroids(some, near, finish=0), "id")


def test_members_in_parts(spark):
    from quarry.operators import clustering

    got = clustering.member_parts(spark.range(25).select("id", F.when(F.col("id") < 23, 0).otherwise(9).alias("centroid")), 10)
    assert [(r["centroid"], r["part"], r["size"], r["members"][0]) for r in got.orderBy("centroid", "part").collect()] == [(0, 0, 10, 0), (0, 1, 10, 10), (0, 2, 3, 20), (9, 0, 2, 23)]


def test_hit_tables_and_other_exports(spark, tmp_path):
    from quarry import adapters, config
    from quarry.sources import sinks

    names = ["t", "ta", "q", "qa", "e", "s", "b", "e1", "s1", "b1", "exp", "reg", "clu", "ov", "env", "dom", "rep", "inc", "note"]
    hits = spark.createDataFrame([(f"t{i:03d}", None, "q", "A1", 1e-9 * i, 10.5, 0.1, 1e-8, 9.0, 0.0, 1.0, 1, 0, 0, 1, 1, 1, 1, "some words" if i % 2 else None) for i in range(200)], ", ".join(f"{n} {'double' if n in ('e', 's', 'b', 'e1', 's1', 'b1', 'exp') else 'int' if n in names[11:18] else 'string'}" for n in names)).repartition(4)
    sinks.write_hits(hits, str(tmp_path / "tbl"), names, ["t"])
    text = "".join((tmp_path / "tbl" / f).read_text() for f in sorted(os.listdir(tmp_path / "tbl")) if f.startswith("part"))
    lines = text.splitlines()
    assert lines[0].startswith("# target name accession query name") and [x.split()[0] for x in lines[1:]] == [f"t{i:03d}" for i in range(200)]
    back = sinks.read_hits(spark, str(tmp_path / "tbl"), names)
    assert rows(back.where("t = 't003'").select("ta", "s", "note")) == [(None, "10.5", "some words")] and back.count() == 200
    with pytest.raises(ValueError):
        sinks.write_hits(hits, str(tmp_path / "no"), names, ["t"], domains=True)
    sinks.write_columns(hits.select(F.col("t").alias("sequence_id"), F.lit(None).alias("length")), str(tmp_path / "truth.tsv"), sinks.TRUTH)
    got = tables.read(spark, str(tmp_path / "truth.tsv"), sep="\t")
    assert tuple(got.columns) == sinks.TRUTH and got.first()["source_genome"] == "NA" and got.first()["length"] == "NA"
    assert adapters.REGISTRY["assembly_search"].gives.names == list(sinks.DOWNLOADS)
    with pytest.raises(config.ConfigError):
        config.EngineConfig().input()
    assert config.EngineConfig(fasta="x.fa").input() == ("fasta", "x.fa")


def test_greedy_by_groups_equals_greedy_by_edges(spark):
    from quarry.operators import clustering

    for seed in range(3):
        rng = random.Random(seed)
        has = sorted({(rng.randrange(80), f"g{rng.randrange(60)}") for _ in range(180)} | {(i, "hot") for i in range(0, 80, 3 + 30 * seed)})
        of = {}
        for i, g in has:
            of.setdefault(g, set()).add(i)
        place = {i: (i * 37) % 80 for i in range(80)}
        want, heads = {}, []
        for i in sorted(place, key=place.get):
            near = [h for h in heads if any(i in x and h in x for x in of.values())]
            if not near:
                heads.append(i)
            want[i] = near[0] if near else i
        nodes = spark.createDataFrame(sorted(place.items()), "id long, place int")
        members = spark.createDataFrame([*has, has[0], (7, "alone")], "id long, group string")
        for finish in (0, 40, 10**6):
            assert dict(rows(clustering.greedy_by_groups(nodes, members, finish))) == want
    assert rows(clustering.greedy_by_groups(nodes, members.limit(0)), "id") == [(i, i) for i in range(80)]


def test_profiles_do_not_depend_on_shards(spark):
    from quarry.operators import profiles

    rng = random.Random(6)
    letters = "ACDE"
    seqs = [(i, "".join(rng.choices("ACDEXacde", k=rng.randint(0, 60)))) for i in range(40)] + [(99, None), (100, "ACDE" * 2000)]
    found = [(f"p{i}", [round(rng.uniform(-2, 3), 3) for _ in range(4 * n)], 1.1 * n) for i, n in enumerate([3, 5, 8, 8, 12, 200])] + [("none", [], 0.0)]
    want = set()
    for name, scores, threshold in found:
        rows_ = [scores[k : k + 4] for k in range(0, len(scores), 4)]
        for i, s in seqs:
            at = [(sum(r[letters.index(c.upper())] if c.upper() in letters else min(r) for r, c in zip(rows_, s[k:])), -k) for k in range(len(s) - len(rows_) + 1)] if s and rows_ else []
            if at and max(at)[0] >= threshold:
                want.add((name, i, -max(at)[1] + 1, -max(at)[1] + len(rows_)))
    df, table = spark.createDataFrame(seqs, "id long, seq string").repartition(3), spark.createDataFrame(found, "name string, scores array<double>, threshold double")
    for shard_bytes in (1 << 20, 300):
        got = profiles.search(df, table, letters, shard_bytes)
        assert {tuple(r) for r in got.select("name", "id", "start", "end").collect()} == want and got.count() == len(want) > 20
    shards = profiles.sharded(table, 300).groupBy("shard").agg(F.sum(F.size("scores") * 8).alias("b"), F.count("*").alias("n")).collect()
    assert len(shards) > 3 and all(r["b"] <= 300 + 6400 for r in shards)
    cut = profiles.with_evalues(got, 42, 0.5, 1.0)
    assert 0 < cut.count() < got.count() and cut.agg(F.max("evalue")).first()[0] <= 1
    assert profiles.search(df, table.limit(0), letters).count() == 0
