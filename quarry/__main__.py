"""Command line: python -m quarry <command> ...; tables are read by extension and written as Parquet."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.config import EngineConfig
from quarry.operators import synth
from quarry.plans import pipelines
from quarry.sources import fasta, sinks, tables


def load(spark: SparkSession, path: str, columns=None) -> DataFrame:
    df = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else tables.read(spark, path, columns)
    return df if "ord" in df.columns else df.withColumn("ord", F.monotonically_increasing_id())


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("quarry", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str, **more):
        c = sub.add_parser(name)
        for x in paths:
            c.add_argument(f"--{x}", required=True)
        for x, (kind, default) in more.items():
            c.add_argument(f"--{x.replace('_', '-')}", type=kind, default=default)
        c.add_argument("--out", required=True)
        return c

    d = EngineConfig()
    command("assembly-stats", "fastadir")
    command("gc", "fasta")
    command("identify", "scores", "quality", sample=(str, "sample"), min_length=(int, d.min_length), min_score=(float, d.min_score))
    command("cluster", "fasta", "alignments", cluster_ani=(float, d.cluster_ani), cluster_qcov=(float, d.cluster_qcov), cluster_tcov=(float, d.cluster_tcov), cluster_layers=(int, d.cluster_layers))
    command("host", "fasta", "host", "lifestyle", "proteins")
    command("samples", "samplelist", datadir=(str, "."))
    command("read-qc", "reports")
    command("mock", contigs=(int, 1000), seed=(int, 42))
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    out = args.out.rstrip("/")
    known = {k: v for k, v in vars(args).items() if k in EngineConfig.__dataclass_fields__ and k != "fasta"}
    cfg = EngineConfig.from_map(known)
    if args.command == "assembly-stats":
        stats, sizes = pipelines.assembly_report(fasta.scan_dir(spark, args.fastadir))
        stats.write.mode("overwrite").parquet(f"{out}/stats")
        sizes.write.mode("overwrite").parquet(f"{out}/sizes")
    elif args.command == "gc":
        from quarry.functions.sequences import gc_percent

        fasta.scan(spark, args.fasta).select(F.col("id").alias("seq_id"), "length", gc_percent(F.col("seq")).alias("gc_percent")).write.mode("overwrite").parquet(out)
    elif args.command == "identify":
        scores = pipelines.combined_scores({args.sample: load(spark, args.scores, tables.SCORES).drop("ord")}, cfg)
        for name, df in zip(("all", "virus", "provirus"), pipelines.identify(scores, load(spark, args.quality, tables.QUALITY), cfg)):
            df.write.mode("overwrite").parquet(f"{out}/{name}")
    elif args.command == "cluster":
        found = pipelines.cluster(fasta.last_of_id(fasta.scan(spark, args.fasta)).drop("seq"), tables.read_alignments(spark, args.alignments), cfg)
        found.write.mode("overwrite").parquet(f"{out}/members")
        from quarry.operators.clustering import clusters

        sinks.cluster_lines(clusters(found)).write.mode("overwrite").text(f"{out}/clusters")
    elif args.command == "host":
        frames = [load(spark, getattr(args, k)).drop("ord") for k in ("host", "lifestyle", "proteins")]
        pipelines.host_table(fasta.scan(spark, args.fasta), *frames).write.mode("overwrite").parquet(out)
    elif args.command == "samples":
        df = tables.completed_samples(tables.read_samples(spark, args.samplelist), args.datadir)
        if problems := tables.sample_problems(df).take(20):
            sys.exit("\n".join(f"{r['sample_id']}: {r['problem']}" for r in problems))
        df.write.mode("overwrite").parquet(f"{out}/samples")
        tables.co_assemblies(df).write.mode("overwrite").parquet(f"{out}/assemblies")
    elif args.command == "read-qc":
        tables.read_qc_reports(spark, args.reports).write.mode("overwrite").parquet(out)
    elif args.command == "mock":
        contigs = synth.mock_contigs(spark, args.contigs, args.seed)
        contigs.drop("seq").write.mode("overwrite").parquet(f"{out}/truth")
        sinks.write_columns(contigs.withColumn("source_genome", F.col("true_cluster")), f"{out}/ground_truth.tsv", sinks.TRUTH)
        fasta.records(contigs.withColumnRenamed("sequence_id", "id")).write.mode("overwrite").text(f"{out}/fasta")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName("quarry").getOrCreate(), args)


if __name__ == "__main__":
    main()
