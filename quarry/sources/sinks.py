"""Text exports; Parquet is what tables are kept in."""

from __future__ import annotations

import csv
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.tables import by_name


def write_table(df: DataFrame, path: str, sep: str | None = None, header: bool = True, single: bool = False) -> None:
    """Delimited text; the separator follows the name.  single: one part file, for tables that fit one task."""
    out = df.coalesce(1) if single else df
    out.write.option("header", header).option("sep", sep or by_name(path, "\t")).option("emptyValue", "").csv(path)


def write_ids(df: DataFrame, key: str, path: str) -> None:
    df.select(F.col(key).cast("string")).write.text(path)


def cluster_lines(clusters: DataFrame) -> DataFrame:
    """centroid<tab>member,member from (centroid, members)."""
    return clusters.select(F.concat_ws("\t", F.col("centroid").cast("string"), "members").alias("value"))


def write_by(df: DataFrame, column: str, path: str) -> None:
    """A folder for each value of a column."""
    df.write.partitionBy(column).parquet(path)


def write_json_if_changed(df: DataFrame, path: str, order: list[str]) -> bool:
    """JSON lines, left alone where they say the same already; returns whether it wrote."""
    spark = df.sparkSession
    try:
        have = spark.read.text(path)
        new = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
        if not new.exceptAll(have).limit(1).count() and not have.exceptAll(new).limit(1).count():
            return False
    except Exception as e:  # nothing there yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    df.orderBy(*order).write.mode("overwrite").json(path)
    return True


def union_of_logs(spark, folder: str) -> DataFrame:
    """Rows of all tab-separated logs of a folder, with the file's name."""
    return spark.read.option("header", True).option("sep", "\t").csv(folder).withColumn("source_file", F.col("_metadata.file_name"))


def write_sorted(df: DataFrame, path: str, key: list[str], sep: str | None = None) -> None:
    """A delimited table whose rows are sorted by key over all files."""
    write_table(df.orderBy(*key), path, sep)


def print_table(df: DataFrame, sep: str = ",", to=None) -> None:
    """Delimited text with a header on a stream (standard output), one partition after the other; quotes only where needed."""
    out = csv.writer(to or sys.stdout, delimiter=sep, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    out.writerow(df.columns)
    for row in df.toLocalIterator():
        out.writerow(["" if v is None else v for v in row])


#: Columns of the tables of hits by sequence and by domain, and those that make them three header lines.
TARGETS = ("target name", "accession", "query name", "accession", "E-value", "score", "bias", "E-value", "score", "bias", "exp", "reg", "clu", "ov", "env", "dom", "rep", "inc", "description of target")
DOMAINS = ("target name", "accession", "tlen", "query name", "accession", "qlen", "E-value", "score", "bias", "#", "of", "c-Evalue", "i-Evalue", "score", "bias", "from", "to", "from", "to", "from", "to", "acc", "description of target")


def hit_lines(hits: DataFrame, columns: list[str], order: list[str], titles: tuple[str, ...] | None = None) -> DataFrame:
    """One text column: a header line that starts with #, then the hits, blank-separated, nulls as -, sorted.

    titles: what the header says in place of the columns' names.  Parts of a table that is written from this are in order.
    """
    if titles is not None and len(titles) != len(columns):
        raise ValueError(f"{len(columns)} columns under {len(titles)} titles")
    first = hits.sparkSession.createDataFrame([("# " + " ".join(titles or columns),)], "value string").withColumn("_o", F.lit(0))
    cells = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    rows = hits.select(cells.alias("value"), F.lit(1).alias("_o"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)])
    both = first.unionByName(rows, allowMissingColumns=True)
    return both.orderBy("_o", *[f"_k{i}" for i in range(len(order))]).select("value")


def write_hits(hits: DataFrame, path: str, columns: list[str], order: list[str], domains: bool = False) -> None:
    """The table of hits by sequence, or by domain; columns: the hits' columns in the order of its titles."""
    hit_lines(hits, columns, order, DOMAINS if domains else TARGETS).write.text(path)


def read_hits(spark, path: str, names: list[str]) -> DataFrame:
    """Cells of such a table, comment lines left out, - as null; the last name takes the rest of the line."""
    cells = F.split(F.trim("value"), r"\s+", len(names))
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(*[F.nullif(F.get(cells, F.lit(i)), F.lit("-")).alias(n) for i, n in enumerate(names)])


#: Columns of the known clusters of synthetic contigs, and of what was downloaded.
TRUTH = ("sequence_id", "true_cluster", "source_category", "source_genome", "length", "strain_mutated", "mutation_rate", "duplication_copy", "is_synthetic")
DOWNLOADS = ("species", "category", "assembly_accession", "ftp_url", "local_file", "status", "summary_json")


def write_columns(df: DataFrame, path: str, columns: tuple[str, ...]) -> None:
    """Tab-separated text with exactly these columns; ones that df lacks are NA."""
    have = set(df.columns)
    write_table(df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) if c in have else F.lit("NA").alias(c) for c in columns]), path, "\t")
