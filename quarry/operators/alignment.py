"""Pairwise alignments: admission, early stop, identity and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.scan import HOT_ROWS, Ordered, Running, hot_groups

MAX_EVALUE = 1e-3
STOP_FACTOR = 1.10


def normalised(df: DataFrame, start: str, end: str) -> DataFrame:
    """start <= end, whichever strand they were given on."""
    return df.withColumns({start: F.least(start, end), end: F.greatest(start, end)})


def early_stop(df: DataFrame, pair: list[str], order: list[str | Column], length: str, limit: Column, max_evalue: float = MAX_EVALUE, evalue: str = "evalue", min_length: int = 0, hot: DataFrame | None | bool = True) -> DataFrame:
    """Admitted rows of each pair up to the first that finds the limit covered, or would go STOP_FACTOR beyond it.

    Rows that are not admitted neither count nor stop.
    """
    rows = df.where((F.col(length) >= min_length) & (F.col(evalue) <= max_evalue)).withColumn("_l", limit)
    rows = Ordered(rows, pair, order, hot=hot).with_columns(_p=Running("sum", length, before=True))
    prior = F.coalesce(F.col("_p"), F.lit(0))
    stops = (prior >= F.col("_l")) | (F.col(length) + prior >= STOP_FACTOR * F.col("_l"))
    return rows.with_columns(_s=Running("max", stops.cast("int"))).where("_s = 0").rows().drop("_p", "_l", "_s")


def weighted_identity(df: DataFrame, pair: list[str], length: str, identity: str, out: str = "ani") -> DataFrame:
    """Length-weighted mean identity of each pair."""
    return df.groupBy(*pair).agg(F.sum(length).alias("_l"), F.sum(F.col(length) * F.col(identity)).alias("_s"), F.count("*").alias("num_alns")).select(*pair, "num_alns", (F.col("_s") / F.col("_l")).alias(out))


def covered_length(df: DataFrame, key: list[str], start: str, end: str, ties: list[str | Column] = (), out: str = "covered", hot: DataFrame | None | bool = True) -> DataFrame:
    """Positions in the union of each key's closed intervals."""
    rows = Ordered(df, key, [start, end, *ties], hot=hot).with_columns(_r=Running("max", end, before=True)).rows()
    fresh = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce(F.col("_r") + 1, F.col(start))) + 1)
    return rows.groupBy(*key).agg(F.sum(fresh).alias(out))


def pair_identity(alns: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """qname, tname, num_alns, pid, qcov, tcov from alignments (qname, tname, pid, len, qstart, qend, tstart, tend, evalue, qlen, tlen).

    order: the columns that give the alignments' order within a pair.  Values are rounded to two places.
    """
    pair = ["qname", "tname"]
    rows = normalised(normalised(alns, "qstart", "qend"), "tstart", "tend").withColumn("_aln", F.col("qend") - F.col("qstart") + 1)
    hot = hot_groups(rows, pair, HOT_ROWS if limit is None else limit)
    kept = early_stop(rows, pair, order, "_aln", F.col("qlen"), hot=hot)
    ident = kept.groupBy(*pair).agg(F.count("*").alias("num_alns"), F.sum(F.col("len") * F.col("pid")).alias("_i"), F.sum("len").alias("_l"), F.first("qlen").alias("_q"), F.first("tlen").alias("_t"))
    covered = [covered_length(kept, pair, f"{x}start", f"{x}end", out=f"_{x}c", hot=hot) for x in "qt"]
    out = ident.join(covered[0], pair).join(covered[1], pair)
    return out.select(*pair, "num_alns", F.round(F.col("_i") / F.col("_l"), 2).alias("pid"), F.round(100.0 * F.col("_qc") / F.col("_q"), 2).alias("qcov"), F.round(100.0 * F.col("_tc") / F.col("_t"), 2).alias("tcov"))


def blocks(df: DataFrame, group: list[str], order: list[str | Column], value: str, limit: int | None = None) -> DataFrame:
    """Runs of equal adjacent values: their number, value and rows."""
    from quarry.operators.ordering import with_runs

    return with_runs(df, group, order, value, limit=limit).groupBy(*group, "run", value).agg(F.count("*").alias("rows"))


def admitted_edges(edges: DataFrame, nodes: DataFrame, min_ani: float = 95.0, min_qcov: float = 0.0, min_tcov: float = 85.0) -> DataFrame:
    """Edges (src, dst) between admitted nodes (id) that reach the thresholds; no loops."""
    ok = edges.where((F.col("src") != F.col("dst")) & (F.col("qcov") >= min_qcov) & (F.col("tcov") >= min_tcov) & (F.col("ani") >= min_ani))
    for end in ("src", "dst"):
        ok = ok.join(nodes.select(F.col("id").alias(end)), end, "left_semi")
    return ok.select("src", "dst").distinct()
