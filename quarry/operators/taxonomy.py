"""Lineages, ranks and the hierarchical majority vote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.storage import materialise

#: Ranks of a lineage, and those that are voted on.
RANKS = ("virus", "realm", "kingdom", "phylum", "class", "order", "family")
VOTE_RANKS = ("genus", "subfamily", "family", "order", "class")


def split_lineage(df: DataFrame, column: str, ranks: tuple[str, ...] = RANKS, sep: str = ";") -> DataFrame:
    """One column for each rank; missing ones are null."""
    parts = F.split(F.col(column), sep)
    return df.select("*", *[F.get(parts, F.lit(i)).alias(r) for i, r in enumerate(ranks)])


def last_rank(clade: Column, letters: str = "kpcofgst") -> Column:
    """Rank letter of the last segment of k__a|p__b; empty if it has none."""
    return F.regexp_extract(clade, rf"([{letters}])__[^|]*$", 1)


def of_rank(df: DataFrame, clade: str, rank: str) -> DataFrame:
    return df.where(last_rank(F.col(clade)) == rank)


def of_rank_by_text(df: DataFrame, clade: str, has: str, lacks: str | None) -> DataFrame:
    """Rows whose clade holds one marker and not the other, anywhere."""
    out = df.where(F.col(clade).contains(has))
    return out if lacks is None else out.where(~F.col(clade).contains(lacks))


def lineages(tree: DataFrame, ranks: tuple[str, ...] = VOTE_RANKS, most: int | None = None) -> DataFrame:
    """(taxid, name, one column for each rank): the taxon's own and its ancestors' names.

    tree: taxid, name, rank, parent.  By pointer doubling: a round takes over the names that the taxon has found to which
    its pointer leads, and that taxon's pointer, so lineages of any depth take as many rounds as their depth has binary
    digits.  A pointer that still leads on when all of the tree's taxa must have been passed is a cycle, and an error.
    ``most``: an error for lineages that go on after about so many levels.
    """
    found = [F.when(F.col("rank") == r, F.col("name")).alias(f"_f{i}") for i, r in enumerate(ranks)]
    rows = materialise(tree.select("taxid", F.when(F.col("parent") != F.col("taxid"), F.col("parent")).alias("_up"), *found), "lineages")
    names = [f"_f{i}" for i in range(len(ranks))]
    passed, taxa = 1, rows.count()
    while rows.where("_up is not null").limit(1).count():
        if passed >= taxa or most is not None and passed >= most:
            raise ValueError(f"lineages of more than {passed} levels, or a cycle")
        above = rows.select(F.col("taxid").alias("_t"), F.col("_up").alias("_u"), *[F.col(n).alias(f"{n}u") for n in names])
        step = rows.join(above, F.col("_up") == F.col("_t"), "left")
        rows = materialise(step.select("taxid", F.col("_u").alias("_up"), *[F.least(n, f"{n}u").alias(n) for n in names]), "lineages")
        passed *= 2
    return tree.select("taxid", "name", "rank").join(rows.select("taxid", *[F.col(n).alias(r) for n, r in zip(names, ranks)]), "taxid", "left")


def majority_vote(hits: DataFrame, contig: str, totals: DataFrame, factors: DataFrame, ranks: tuple[str, ...] = VOTE_RANKS[:-1], threshold: float = 0.6) -> DataFrame:
    """One row per contig: rank, taxon, votes, total, decision.

    hits: contig and a name for each of the ranks (null: none), a row per annotated protein.
    totals: contig, total_prot.  factors: taxon, factor, avg_cds, std_cds.  ``with_lineage`` adds the ranks above.

    Ranks are tried from the first on.  A taxon with at least threshold * factor of a rank's votes wins if it is among the
    factors and the contig has at most avg_cds + 2 * std_cds proteins; most votes first, then the least name.  The first
    rank with a winner decides.  decision 'deficit': no rank decided, and at this last voted rank no taxon reached its
    share; taxon is then the number of votes that the closest one lacks.
    """
    long = hits.select(contig, F.posexplode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("taxon")) for r in ranks])).alias("level", "x"))
    long = long.select(contig, "level", F.col("x.rank").alias("rank"), F.col("x.taxon").alias("taxon")).where("taxon is not null")
    counts = long.groupBy(contig, "level", "rank", "taxon").agg(F.count("*").alias("votes"))
    sums = counts.groupBy(contig, "level").agg(F.sum("votes").alias("total"))
    rows = counts.join(sums, [contig, "level"]).join(factors, "taxon", "left").join(totals, contig)
    share = threshold * F.coalesce(F.col("factor"), F.lit(1.0))
    over = F.col("votes") / F.col("total") >= share
    fits = F.col("factor").isNotNull() & (F.col("total_prot") <= F.col("avg_cds") + 2 * F.col("std_cds"))
    rows = rows.withColumn("over", over).withColumn("wins", over & fits).withColumn("lacks", F.ceil(share * F.col("total")) - F.col("votes"))
    each = rows.groupBy(contig, "level", "rank", "total").agg(
        F.min(F.when(F.col("wins"), F.struct((-F.col("votes")).alias("v"), F.col("taxon").alias("t")))).alias("w"),
        F.max("over").alias("any"),
        F.min(F.when(~F.col("over"), F.struct(F.col("lacks").alias("l"), F.col("taxon").alias("t"), F.col("votes").alias("v")))).alias("u"),
    )
    decided = F.when(F.col("w").isNotNull(), "taxon").when(~F.col("any"), "deficit").otherwise("none")
    each = each.withColumn("decision", decided)
    order = Window.partitionBy(contig).orderBy(F.when(F.col("decision") == "taxon", 0).otherwise(1), F.when(F.col("decision") == "taxon", F.col("level")).otherwise(-F.col("level")))
    best = each.withColumn("_r", F.row_number().over(order)).where("_r = 1")
    return best.select(
        contig,
        "rank",
        F.when(F.col("decision") == "taxon", F.col("w.t")).when(F.col("decision") == "deficit", F.col("u.l").cast("string")).alias("taxon"),
        F.when(F.col("decision") == "taxon", -F.col("w.v")).when(F.col("decision") == "deficit", F.col("u.v")).alias("votes"),
        "total",
        "decision",
    )


def with_lineage(votes: DataFrame, upward: DataFrame, ranks: tuple[str, ...] = VOTE_RANKS) -> DataFrame:
    """Winners with the names of their rank and of the ranks above; lower ranks are empty."""
    table = upward.select(F.col("name").alias("_name"), F.col("rank").alias("_rank"), *[F.col(r).alias(f"_{r}") for r in ranks])
    out = votes.join(table, (F.col("taxon") == F.col("_name")) & (F.col("rank") == F.col("_rank")) & (F.col("decision") == "taxon"), "left")
    level = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col("rank"))
    return out.select(*votes.columns, *[F.when(level <= i + 1, F.col(f"_{r}")).alias(r) for i, r in enumerate(ranks)])
