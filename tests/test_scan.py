"""Ordered computations with hot groups cut into pieces, against the plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import alignment, ordering, scan


def table(spark, n=400):
    rng = random.Random(7)
    rows = [(None if g == 2 else g, i, rng.randint(0, 3) if rng.random() < 0.9 else None, rng.randint(0, 50)) for i in range(n) for g in [rng.choice([0, 0, 0, 0, 1, 2, 3])]]
    rows += [(9, 10_000, 1, 1)]
    return spark.createDataFrame(rows, "g int, i int, v int, n int").repartition(5)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def pieces(spark, monkeypatch):
    """How many pieces a group was cut into at most."""
    most = []
    carried = scan.Ordered._carried

    def seen(self, outs):
        most.append(self.cut.groupBy(*self.group).agg(F.countDistinct("_piece").alias("n")).agg(F.max("n")).first()[0])
        return carried(self, outs)

    monkeypatch.setattr(scan.Ordered, "_carried", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these pieces are small
    yield most
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scans_do_not_depend_on_pieces(spark, pieces):
    df, order = table(spark), ["i"]
    for f in (
        lambda limit: ordering.with_runs(df, ["g"], order, "v", limit=limit),
        lambda limit: ordering.with_runs(df, ["g"], [F.desc("i")], "v", limit=limit),
        lambda limit: ordering.adjacent_distinct(df, ["g"], order, "v", limit=limit),
        lambda limit: ordering.adjacent_single(df, ["g"], order, "v", limit=limit),
        lambda limit: ordering.counter(df, ["g"], order, F.col("v") == 1, "c", limit=limit),
        lambda limit: ordering.renumbered(df, "g", order, F.col("v") == 1, 1000, "c", limit=limit),
        lambda limit: alignment.blocks(df, ["g"], order, "v", limit=limit),
    ):
        plain = rows(f(10**9))
        assert plain == rows(f(20)) and plain
    assert max(pieces) >= 3  # a group's rows were read by several tasks


def test_scan_kinds(spark, pieces):
    df = table(spark, 200)
    outs = dict(a=scan.Running("sum", "n"), b=scan.Running("sum", "n", before=True), c=scan.Running("max", "v"), d=scan.Running("max", "v", before=True), e=scan.Running("count"), f=scan.Running("count", before=True), x=scan.Running("lag", "v"), y=scan.Running("lead", "v"))
    got = [scan.Ordered(df, ["g"], ["i"], limit).with_columns(**outs).rows() for limit in (10**9, 0)]
    assert rows(got[0]) == rows(got[1]) and max(pieces) >= 3
    nothing = scan.Ordered(df.limit(0), ["g"], ["i"], 0).with_columns(**outs).rows()
    assert nothing.columns == got[0].columns and nothing.count() == 0


def test_pair_identity_of_one_hot_pair(spark, pieces):
    rng = random.Random(3)
    alns = [("q", "t", 95.0, 30.0, a := rng.randint(1, 900), a + rng.randint(0, 60), b := rng.randint(1, 900), b + 40, 0.0, 4000.0, 1000.0, i) for i in range(300)]
    alns += [("q", f"t{i}", 90.0, 10.0, 1, 10, 5, 14, 0.0, 100.0, 100.0, i) for i in range(5)]
    df = spark.createDataFrame(alns, "qname string, tname string, pid double, len double, qstart long, qend long, tstart long, tend long, evalue double, qlen double, tlen double, i long")
    plain = rows(alignment.pair_identity(df, ["i"]))
    assert plain == rows(alignment.pair_identity(df, ["i"], limit=20)) and len(plain) == 6 and max(pieces) >= 3
