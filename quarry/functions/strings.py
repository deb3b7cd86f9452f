"""String expressions on sequence and sample identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_region(c: Column) -> Column:
    """k1|provirus_1_20 -> k1."""
    return F.regexp_replace(c, r"\|provir.+$", "")


def strip_fragment(c: Column) -> Column:
    """c_1 1-20/30 -> c."""
    return F.regexp_replace(c, r"(.+)_\d\s.+$", "$1")


def clean_id(c: Column) -> Column:
    """What stands before the first space, and before a double bar."""
    return F.split_part(F.split_part(c, F.lit(" "), F.lit(1)), F.lit("||"), F.lit(1))


def drop_description(c: Column) -> Column:
    return F.regexp_replace(c, r"\s.*", "")


def contig_of_gene(c: Column) -> Column:
    """c7_12 -> c7."""
    return F.regexp_replace(c, r"_\d+$", "")


def header_fields(c: Column) -> Column:
    """Fields of a gene header 'id # start # end # strand # more', without the last."""
    parts = F.split(c, " # ")
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def renumber_id(c: Column, contig: Column) -> Column:
    """The contig number inside ID=<contig>_<gene>, replaced."""
    return F.concat(F.regexp_extract(c, r"^(.*ID=)(\d+)_(\d+)(.*)$", 1), contig.cast("string"), F.lit("_"), F.regexp_extract(c, r"^(.*ID=)(\d+)_(\d+)(.*)$", 3), F.regexp_extract(c, r"^(.*ID=)(\d+)_(\d+)(.*)$", 4))


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def null_values(df: DataFrame, values: list[str], columns: list[str] | None = None) -> DataFrame:
    """Cells that equal one of values become null."""
    names = columns or [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: F.when(~F.col(n).isin(values), F.col(n)) for n in names})


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def path_part(path: Column, from_end: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def sample_of_column(name: str) -> str | None:
    """ref/S1_R1_x method -> S1."""
    import re

    found = re.search(r"/(.+)_R[12]_", name)
    return found[1] if found else None


def scrubbed(value: Column) -> Column:
    """Tabs and line ends as single blanks, so that the value fits a cell of a delimited text."""
    return F.regexp_replace(value, r"[\t\r\n]+", " ")


def run_stamp(at: Column | None = None) -> Column:
    """yyyymmdd_hhmmss of a time, now if none is given."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyyMMdd_HHmmss")


def elapsed(seconds: Column) -> Column:
    """Whole seconds as 1h 2m 3s."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%dh %dm %ds", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
