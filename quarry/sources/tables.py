"""Delimited, JSON and XML inputs as typed DataFrames."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNIFFED_CHARS = 2048
SEPARATORS = ",\t;|"
_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in columns.items()])


#: Tabular alignments without a header: twelve standard columns, then both lengths.
ALIGNMENTS = schema(qname=_S, tname=_S, pid=_D, len=_D, mismatch=_L, gapopen=_L, qstart=_L, qend=_L, tstart=_L, tend=_L, evalue=_D, bitscore=_D, qlen=_D, tlen=_D)
SCORES = schema(seq_name=_S, length=_L, topology=_S, coordinates=_S, n_genes=_L, genetic_code=_L, virus_score=_D, fdr=_D, n_hallmarks=_L, marker_enrichment=_D, taxonomy=_S)
QUALITY = schema(contig_id=_S, contig_length=_L, provirus=_S, proviral_length=_L, gene_count=_L, viral_genes=_L, host_genes=_L, checkv_quality=_S, miuvig_quality=_S, completeness=_D, completeness_method=_S, contamination=_D, kmer_freq=_D, warnings=_S)
HITS = schema(query=_S, marker=_S, abs_evalue_exp=_D, taxon=_S)
FACTORS = schema(taxon=_S, avg_cds=_D, std_cds=_D, factor=_D)
TAXA = schema(taxid=_L, name=_S, rank=_S, parent=_L)
BINS = schema(contig=_S, bin=_S)
SAMPLES = schema(sample_id=_S, accession=_S, assembly=_S, R1=_S, R2=_S)
_SIDE = schema(total_reads=_L, total_bases=_L, gc_content=_D)
READ_QC = schema(summary=schema(before_filtering=_SIDE, after_filtering=_SIDE))


def sniff(spark: SparkSession, path: str) -> str:
    """The separator of a table: by its first characters, else by its name, else a tab."""
    head = spark.read.text(path, wholetext=False).limit(20).collect()
    text = "\n".join(r["value"] for r in head)[:SNIFFED_CHARS]
    try:
        return csv.Sniffer().sniff(text, SEPARATORS).delimiter
    except csv.Error:
        return by_name(path, "\t")


def by_name(path: str, default: str | None = None) -> str:
    if path.lower().endswith((".csv", ".csv.gz")):
        return ","
    if path.lower().endswith((".tsv", ".txt", ".tab", ".tsv.gz")):
        return "\t"
    if default is None:
        raise ValueError(f"{path}: neither csv nor tsv")
    return default


def read(spark: SparkSession, path: str, columns: T.StructType | None = None, sep: str | None = None, header: bool = True) -> DataFrame:
    """A table; without a schema all cells are strings.  Empty cells are null."""
    r = spark.read.option("header", header).option("sep", sep or by_name(path, "\t")).option("nullValue", "").option("mode", "FAILFAST" if columns else "PERMISSIVE")
    return r.schema(columns).csv(path) if columns is not None else r.csv(path)


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignments with ord and coordinates in ascending order."""
    rows = read(spark, path, ALIGNMENTS, "\t", header=False).withColumn("ord", F.monotonically_increasing_id())
    return rows.withColumns({"qstart": F.least("qstart", "qend"), "qend": F.greatest("qstart", "qend"), "tstart": F.least("tstart", "tend"), "tend": F.greatest("tstart", "tend")})


def read_named(spark: SparkSession, paths: dict[str, str], columns: T.StructType | None = None, sep: str | None = None, name: str = "sample_id") -> DataFrame:
    """Tables of several samples, under each other, with the sample's name; a path is a file or a folder.

    One scan for each separator, or without a schema for each header line, whatever the number of samples: rows find
    their sample by the file that they are from.
    """
    scans = {}
    for sample, path in paths.items():
        scans.setdefault(sep or by_name(path, "\t"), {})[sample] = path
    parts = []
    for s, some in scans.items():
        if columns is not None:
            parts.append(_of_samples(spark, some, lambda files, s=s: read(spark, files, columns, s), name))
            continue
        start = F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
        first = spark.read.text(list(some.values())).select(F.col("_metadata.file_path").alias("f"), start.alias("o"), "value").groupBy("f").agg(F.min_by("value", "o").alias("head"))
        files: dict[str, list[str]] = {}
        for r in first.collect():  # a header line for each file
            files.setdefault(r["head"], []).append(unquote(r["f"]))
        parts += [_of_samples(spark, some, lambda _, f=f, s=s: read(spark, f, None, s), name) for f in files.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _of_samples(spark: SparkSession, paths: dict[str, str], scan, name: str) -> DataFrame:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def whole(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).makeQualified(p).toString()

    sheet = F.broadcast(spark.createDataFrame([(whole(p), s) for s, p in paths.items()], "_at string, _sample string"))  # a row for each sample
    rows = scan(list(paths.values()))
    columns = rows.columns
    file = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:///", "file:/"), F.lit("+"), F.lit("%2B")))
    rows = rows.select("*", file.alias("_file")).withColumn("_folder", F.regexp_replace("_file", "/[^/]*$", ""))
    found = rows.join(sheet, (F.col("_file") == F.col("_at")) | (F.col("_folder") == F.col("_at")))
    return found.select(*columns, F.col("_sample").alias(name))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet: csv with # comments, all cells strings."""
    return spark.read.option("header", True).option("comment", "#").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).schema(SAMPLES).option("enforceSchema", False).csv(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.rtrim("value").alias("id")).where("id <> ''")


def read_qc_reports(spark: SparkSession, path: str) -> DataFrame:
    """Counts before and after filtering from nested JSON reports, a row per file."""
    df = spark.read.schema(READ_QC).option("multiLine", True).json(path)
    sides = [("before_filtering", "before"), ("after_filtering", "after")]
    fields = ("total_reads", "total_bases", "gc_content")
    return df.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("sample"), *[F.col(f"summary.{s}.{f}").alias(f"{f}_{s}") for f in fields for s, _ in sides])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """(accession, gigabytes) of XML run records: sizes of a run's files, each rounded to two places."""
    layout = T.StructType([T.StructField("_accession", _S), T.StructField("SRAFiles", T.StructType([T.StructField("SRAFile", T.ArrayType(schema(_size=_L)))]))])
    df = spark.read.format("xml").option("rowTag", "RUN").schema(layout).load(path)
    return df.select(F.col("_accession").alias("accession"), F.explode_outer("SRAFiles.SRAFile").alias("f")).select("accession", F.round(F.col("f._size") / 1024**3, 2).alias("gigabytes"))


def completed_samples(df: DataFrame, folder: str) -> DataFrame:
    """Defaults: sample_id from accession, assembly from sample_id, read files from the sample's name."""
    from quarry.functions.strings import blank_to_null

    out = df.withColumns({c: blank_to_null(F.col(c)) for c in SAMPLES.names})
    out = out.withColumn("sample_id", F.coalesce("sample_id", "accession")).withColumn("assembly", F.coalesce("assembly", "sample_id"))
    file = lambda i: F.concat(F.lit(folder.rstrip("/") + "/"), F.col("sample_id"), F.lit(f"_{i}.fastq.gz"))
    return out.withColumn("R1", F.coalesce("R1", file(1))).withColumn("R2", F.coalesce("R2", file(2)))


def sample_problems(df: DataFrame) -> DataFrame:
    """(sample_id, problem): no id at all, or an id that occurs more than once."""
    none = df.where("sample_id is null").select("sample_id", F.lit("no sample id or accession").alias("problem"))
    twice = df.where("sample_id is not null").groupBy("sample_id").agg(F.count("*").alias("n")).where("n > 1").select("sample_id", F.lit("occurs more than once").alias("problem"))
    return none.unionByName(twice)


def co_assemblies(df: DataFrame) -> DataFrame:
    """A row per assembly with its samples' ids and read files, in the order of sample_id."""
    rows = F.array_sort(F.collect_list(F.struct("sample_id", "accession", "R1", "R2")))
    return df.groupBy("assembly").agg(rows.alias("x")).select("assembly", *[F.col(f"x.{c}").alias(c) for c in ("sample_id", "accession", "R1", "R2")])


def expanded(assemblies: DataFrame) -> DataFrame:
    """A row per sample again, with its assembly, from what co_assemblies gathered."""
    columns = ("sample_id", "accession", "R1", "R2")
    return assemblies.select("assembly", F.explode(F.arrays_zip(*columns)).alias("s")).select("assembly", *[F.col(f"s.{c}").alias(c) for c in columns])


def repeated_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, each once, with how often; nulls are equal."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("times")).where("times > 1")


def total_gigabytes(runs: DataFrame) -> DataFrame:
    """One row: the sum of the sizes as they are given, rounded for each file."""
    return runs.agg(F.round(F.sum("gigabytes"), 2).alias("gigabytes"))


def read_factors(spark: SparkSession, path: str) -> DataFrame:
    """(taxon, avg_cds, std_cds, factor): the first, fourth last, third last and last field of each line, whatever is between.

    The first line is a header.  Fields may be quoted; numbers have any form of a float, and others are an error.
    Lines of fewer than five fields are left out.
    """
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.slice(F.split("value", "\r?\n"), F.lit(2), F.lit(2**31 - 1))).alias("value"))
    f = F.transform(F.split("value", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda x: F.replace(F.regexp_replace(F.trim(x), '^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))
    rows = lines.select(f.alias("f")).where(F.size("f") >= 5)
    field = lambda i: F.element_at("f", i)

    def number(i: int) -> Column:
        value = field(i).try_cast("double")
        return F.when(value.isNull(), F.raise_error(F.concat(F.lit("no number: "), field(i)))).otherwise(value)

    return rows.select(field(1).alias("taxon"), number(-4).alias("avg_cds"), number(-3).alias("std_cds"), number(-1).alias("factor"))


def with_file(df: DataFrame, column: Column | None = None) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_name") if column is None else column)


def read_optional(spark: SparkSession, path: str | None, key: str, columns: T.StructType | None = None, sep: str | None = None) -> DataFrame | None:
    """A table, or None where there is no file, no row or no key column."""
    if not path:
        return None
    try:
        df = read(spark, path, columns, sep)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return df if key in df.columns and df.limit(1).count() else None


def empty(spark: SparkSession, columns: T.StructType) -> DataFrame:
    """A table of no rows, for tools that were given nothing."""
    return spark.createDataFrame([], columns)
