"""Whole analyses composed from the operators; tables in, tables out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import EngineConfig
from quarry.functions import sequences, strings
from quarry.operators import alignment, clustering, columns, consensus, joins, lengths, ordering, profile, sets, taxonomy

#: Cells that stand for nothing in host and taxonomy tables.
NOTHING = ["Na", "Unclassified"]
#: Columns of the abundance methods in a depth table's names.
METHODS = ("mean", "tpm", "rpkm", "count", "covered_fraction")


def assembly_report(seqs: DataFrame, assembly: str = "assembly") -> tuple[DataFrame, DataFrame]:
    """(statistics, size distribution) per assembly of sequences (assembly, ord, length)."""
    return lengths.length_stats(seqs, assembly, "length", "ord"), lengths.size_distribution(seqs, assembly, "length")


def filtered_scores(scores: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Classifier rows that are long and sure enough, with prefixed columns and the contig's own id."""
    rows = consensus.score_length_filter(scores, "length", "virus_score", cfg.min_length, cfg.min_score)
    rows = columns.prefixed(rows, "genomad_")
    return rows.withColumn("genomad_seq_name", strings.strip_region(F.col("genomad_seq_name"))).withColumn("sequence_id", F.col("genomad_seq_name"))


def combined_scores(per_sample: dict[str, DataFrame], cfg: EngineConfig) -> DataFrame:
    """Filtered scores of all samples; keys carry the sample's name."""
    rows = [filtered_scores(df, cfg).withColumn("sample_id", F.lit(s)) for s, df in per_sample.items()]
    return columns.suffixed_key(sets.loose_union(rows), "genomad_seq_name", "sample_id")


def identify(scores: DataFrame, quality: DataFrame, cfg: EngineConfig, order: str = "ord") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all that pass, viruses, proviruses) from combined scores and the quality summary (with ord)."""
    q = columns.prefixed_unless(quality, "checkv_", keep=["contig_id", order])
    both = q.join(scores.withColumnRenamed("genomad_seq_name", "contig_id"), "contig_id", "left")
    by_quality, by_score = F.col("checkv_provirus") == "Yes", F.col("genomad_topology") == "Provirus"
    one = lambda c: F.when(c, 1).otherwise(0)
    both = both.withColumns({
        "hit-score": consensus.hit_score(F.col("genomad_virus_score"), cfg.min_score), "provirus-hit-score": one(by_quality) + one(by_score),
        "type": consensus.vote_label(by_score, by_quality, "Virus", "Provirus (geNomad+CheckV)", "Provirus (geNomad)", "Provirus (CheckV)")})
    names = {"label": "type", "contamination": "checkv_contamination", "warnings": "checkv_warnings", "quality": "checkv_checkv_quality" if "checkv_checkv_quality" in both.columns else "checkv_quality", "hallmarks": "genomad_n_hallmarks", "score": "genomad_virus_score", "enrichment": "genomad_marker_enrichment"}
    passed = consensus.consensus(both, "contig_id", [order], names)
    plain, other = consensus.by_label(passed, "type")
    return passed, plain, other


def representatives(viruses: DataFrame, proviruses: DataFrame) -> DataFrame:
    """One sequence per id, the first kept, with its length and GC share; fragments have their contig's id."""
    seqs = sets.loose_union([viruses.withColumn("_b", F.lit(0)), proviruses.withColumn("id", strings.strip_fragment(F.col("id"))).withColumn("_b", F.lit(1))])
    first = ordering.keep_first(seqs, ["id"], ["_b", "ord"]).drop("_b")
    return first.withColumn("length", F.length("seq").cast("long")).withColumn("gc_percent", sequences.gc_percent(F.col("seq")))


def cluster(seqs: DataFrame, alignments: DataFrame, cfg: EngineConfig, exclude: DataFrame | None = None, keep: DataFrame | None = None) -> DataFrame:
    """(id, centroid) from sequences (id, ord, length) and alignments (with ord): pair identity, edges, centroids."""
    nodes = joins.admitted(seqs, 1, exclude, keep)
    pairs = alignment.pair_identity(alignments, ["ord"]).select(F.col("qname").alias("src"), F.col("tname").alias("dst"), F.col("pid").alias("ani"), "qcov", "tcov")
    edges = alignment.admitted_edges(pairs, nodes, cfg.cluster_ani, cfg.cluster_qcov, cfg.cluster_tcov)
    placed = clustering.ranked(nodes, [F.desc("length"), "ord"])
    return clustering.greedy_centroids(placed, edges) if cfg.cluster_layers == 1 else clustering.tournament(placed, edges, cfg.cluster_layers)


def _spine_merge(spine: DataFrame, tables: dict[str, DataFrame], key: str = "Accession") -> DataFrame:
    frames = [columns.prefixed(t, f"{p}_", keep=[key]).withColumnRenamed(key, "id") for p, t in tables.items()]
    out = columns.without(joins.outer_reduce([spine.select("id").distinct(), *frames], "id"), "subfamily")
    return strings.null_values(out, NOTHING)


def host_table(spine: DataFrame, host: DataFrame, lifestyle: DataFrame, proteins: DataFrame) -> DataFrame:
    """Three predictions side by side, for all ids of the spine and of the tables."""
    return _spine_merge(spine, {"cherry": host, "phatyp": lifestyle, "phavip": proteins})


def lineage_table(classified: DataFrame) -> DataFrame:
    """Key, score and the seven ranks of classified sequences."""
    named = classified.withColumn("genomad_taxonomy", F.when(F.col("genomad_taxonomy") == "Unclassified", "Unassigned").otherwise(F.col("genomad_taxonomy")))
    return taxonomy.split_lineage(named.select("contig_id", "genomad_virus_score", "genomad_taxonomy"), "genomad_taxonomy").drop("genomad_taxonomy")


def taxonomy_table(spine: DataFrame, network: DataFrame, lineages: DataFrame) -> DataFrame:
    return _spine_merge(spine, {"phagcn": network, "genomad": lineages.withColumnRenamed("contig_id", "Accession")})


def tool_comparison(tools: dict[str, tuple[DataFrame | None, str]]) -> DataFrame | None:
    """Results of several tools (name: table with ord, its id column) side by side; missing tables are left out."""
    frames = []
    for name, (df, key) in tools.items():
        if df is None:
            continue
        first = ordering.keep_first(df.withColumn("contig_id", strings.clean_id(F.col(key))).drop(*([key] if key != "contig_id" else [])), ["contig_id"], ["ord"]).drop("ord")
        frames.append(columns.prefixed(first, f"{name}_", keep=["contig_id"]))
    return joins.outer_reduce(frames, "contig_id") if frames else None


def abundance_by_method(per_sample: list[DataFrame], methods=METHODS, key: str = "Contig") -> dict[str, DataFrame]:
    """One table per method from wide tables of samples, joined on the contig; columns are named by sample."""
    wide = reduce(lambda a, b: a.join(b, key, "full"), per_sample)
    out = {}
    for m in methods:
        part = columns.containing(wide, f" {m}" if any(c.lower().endswith(f" {m}") for c in wide.columns) else m, [key])
        names = [strings.sample_of_column(c) for c in part.columns[1:]]
        if None in names:
            raise ValueError(f"no sample in {part.columns[1:][names.index(None)]!r}")
        out[m] = part.toDF("vOTU_id", *names)
    return out


def profile_tables(profiles: DataFrame, groups: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stratified, community) tables of a functional profile: per million, regrouped and named."""
    scaled = profile.per_million(profiles, "sample", "value").select("feature", "sample", F.col("cpm").alias("value"))
    grouped = profile.renamed(profile.regrouped(scaled, groups, "feature", "sample", "value"), names, "group")
    return profile.stratified(grouped, "group")


def renamed_bins(bins: DataFrame, assembly: str, name: str = "bin") -> DataFrame:
    """Bins of an assembly numbered in natural order, those that hold unbinned contigs left out."""
    kept = bins.where(~F.col(name).contains("unbinned")).select(name).distinct()
    natural = [F.regexp_replace(name, r"\d+", ""), F.coalesce(F.regexp_extract(name, r"(\d+)\D*$", 1).try_cast("long"), F.lit(-1)), F.col(name)]
    return ordering.ordinal(kept, natural).select(F.format_string(f"{assembly}_%d", "ord").alias("ids"), F.col(name).alias("DASTool_id"))
