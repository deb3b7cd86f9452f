"""Typed boundaries to external tools: what goes in, what comes out, and how a tool may be run on partitions."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.sources import tables


class ContractError(ValueError):
    """A table lacks columns that a tool's contract names."""


@dataclass(frozen=True)
class Adapter:
    """A tool: the columns that it needs, and the schema of what it gives."""

    name: str
    needs: tuple[str, ...]
    gives: T.StructType
    sep: str = "\t"
    header: bool = True
    settings: dict = field(default_factory=dict)

    def check(self, df: DataFrame) -> DataFrame:
        if missing := [c for c in self.needs if c not in df.columns]:
            raise ContractError(f"{self.name}: missing {missing}")
        return df.select(*self.needs)

    def ingest(self, spark: SparkSession, path: str) -> DataFrame:
        """Output that the tool has written before."""
        return tables.read(spark, path, self.gives, self.sep, self.header)

    def run(self, df: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], partitions: int | None = None) -> DataFrame:
        """call on batches of the partitions; its columns must be those of the contract."""
        names = self.gives.names

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield call(b)[names]

        rows = self.check(df)
        return (rows.repartition(partitions) if partitions else rows).mapInPandas(each, self.gives)


def command(arguments: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A caller that pipes rows as tab-separated text through a program and reads its tab-separated answer with a header."""

    def call(rows: pd.DataFrame) -> pd.DataFrame:
        from io import StringIO

        done = subprocess.run(arguments, input=rows.to_csv(sep="\t", index=False), capture_output=True, text=True, check=True)
        return pd.read_csv(StringIO(done.stdout), sep="\t")

    return call


_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()
_SEQ = ("id", "seq")
REGISTRY: dict[str, Adapter] = {
    a.name: a
    for a in (
        Adapter("read_qc", ("sample_id", "R1", "R2"), tables.READ_QC),
        Adapter("host_removal", ("sample_id", "R1", "R2"), tables.schema(sample_id=_S, R1=_S, R2=_S)),
        Adapter("assembler", ("assembly", "R1", "R2"), tables.schema(assembly=_S, id=_S, seq=_S)),
        Adapter("virus_classifier", _SEQ, tables.SCORES),
        Adapter("quality_check", _SEQ, tables.QUALITY),
        Adapter("gene_caller", _SEQ, tables.schema(protein_id=_S, contig_id=_S, start=_L, end=_L, strand=_L, attrs=_S)),
        Adapter("profile_search", ("protein_id", "seq"), tables.HITS),
        Adapter("all_vs_all", _SEQ, tables.ALIGNMENTS, header=False),
        Adapter("incremental_clustering", _SEQ, tables.schema(id=_S, centroid=_S)),
        Adapter("network_taxonomy", _SEQ, tables.schema(Accession=_S, lineage=_S)),
        Adapter("host_prediction", _SEQ, tables.schema(Accession=_S, Length=_L, Host=_S, CHERRYScore=_D, Method=_S)),
        Adapter("lifestyle", _SEQ, tables.schema(Accession=_S, TYPE=_S, PhaTYPScore=_D, Length=_L)),
        Adapter("protein_annotation", _SEQ, tables.schema(Accession=_S, Protein_num=_L, Annotated_num=_L, Annotation_rate=_D)),
        Adapter("read_mapping", ("sample_id", "R1", "R2"), tables.schema(contig=_S, sample=_S, reads=_L, length=_L)),
        Adapter("depths", ("contig", "sample"), tables.schema(contigName=_S, sample=_S, depth=_D)),
        Adapter("binner", _SEQ, tables.BINS, header=False),
        Adapter("taxonomic_profile", ("sample_id", "R1"), tables.schema(clade_name=_S, sample=_S, value=_D)),
        Adapter("functional_profile", ("sample_id", "R1"), tables.schema(feature=_S, sample=_S, value=_D)),
        Adapter("bin_refinement", ("contig", "bin"), tables.BINS, header=False),
        Adapter("bin_quality", _SEQ, tables.schema(Name=_S, Completeness=_D, Contamination=_D)),
        Adapter("dereplication", ("id", "path"), tables.schema(centroid=_S, member=_S), header=False),
        Adapter("bin_taxonomy", ("id", "path"), tables.schema(user_genome=_S, classification=_S)),
        Adapter("coordinate_sort", ("contig", "start", "end"), tables.schema(contig=_S, start=_L, end=_L)),
        Adapter("host_genus", _SEQ, tables.schema(Virus=_S, host_genus=_S, confidence=_D), sep=","),
        Adapter("assembly_search", ("species", "category"), tables.schema(species=_S, category=_S, assembly_accession=_S, ftp_url=_S, local_file=_S, status=_S, summary_json=_S)),
        Adapter("annotation", ("protein_id", "seq"), tables.schema(query=_S, term=_S, score=_D)),
    )
}
