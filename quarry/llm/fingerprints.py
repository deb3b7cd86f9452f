"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each of a text's distinct word shingles is hashed once; the top bits of the hash
name one of ``BINS`` bins and each bin keeps its least hash.  An empty bin borrows
from a full one by optimal densification: it probes bins in an order that only
its own number decides, so two documents borrow alike.  Of every bin the low
``BITS`` bits are stored, packed as hex.  Likeness is the share of equal bins,
less the share that agree by chance in so few bits.

Words are what white space separates, in lower case; shingles have ``WIDTH``
words (a shorter text is one shingle).  Texts without words, null included, have
the fingerprint of an empty set: they are like each other and unlike others.
Every row is a document of its own, also where rows share a doc_id (numbers; rows
without one come last); an empty table gives an empty result.  Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common

BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
WIDTH = 5
PROBES = 24
#: About how many documents the neighbour search deals to one window, while there are up to so many windows.
NEIGHBOURS = 256
MOST_RANGES = 1 << 17
_LOW = (1 << (64 - BIN_BITS)) - 1


def _hashes(text: Column) -> Column:
    """Hash of each word shingle."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")
    return common.let(
        tokens,
        lambda t: F.transform(F.slice(t, F.lit(1), F.greatest(F.size(t) - (WIDTH - 1), F.least(F.size(t), F.lit(1)))), lambda _, i: F.xxhash64(F.slice(t, i + 1, WIDTH))),
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _bins(hashes: Column) -> Column:
    """The least hash of each bin, null where it is empty.

    A sentinel, the largest hash of each bin, makes every bin occur among the sorted hashes; its least entry starts it.
    """
    sentinels = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("bigint"), 64 - BIN_BITS).bitwiseOR(F.lit(_LOW)))
    number = lambda h: F.shiftright(h, 64 - BIN_BITS)
    firsts = common.let(
        F.sort_array(F.concat(hashes, sentinels)),
        lambda a: F.filter(a, lambda h, i: (i == 0) | (number(h) != number(F.get(a, i - 1)))),
    )
    return F.transform(firsts, lambda h: F.when(h.bitwiseAND(F.lit(_LOW)) != F.lit(_LOW), h))


def _probe(bin_number: Column, attempt: int) -> Column:
    return F.xxhash64(bin_number, F.lit(attempt)).bitwiseAND(F.lit(BINS - 1)).cast("int")


def _densified(bins: Column) -> Column:
    """Low bits of each bin's value, or of the first full bin on its probing order.

    After PROBES misses the least of (hash of both numbers) over the full bins decides, an order of its own for each bin.
    """

    def fill(full: Column) -> Column:
        def borrow(value: Column, i: Column) -> Column:
            last = F.array_min(F.filter(F.transform(full, lambda v, j: F.when(v.isNotNull(), F.struct(F.xxhash64(i, j, F.lit("last")).alias("o"), v.alias("v")))), lambda s: s.isNotNull()))
            return F.coalesce(value, *[F.get(full, _probe(i, k)) for k in range(PROBES)], last.v)

        return F.transform(full, lambda v, i: F.coalesce(borrow(v, i), F.lit(-1).cast("bigint")).bitwiseAND(F.lit((1 << BITS) - 1)).cast("smallint"))

    return common.let(bins, fill)


def fingerprint(text: Column) -> Column:
    """BINS numbers of BITS bits, preceded by 1 for texts with words and 0 for those without."""
    return common.let(_hashes(text), lambda h: F.when(F.size(h) == 0, F.array_repeat(F.lit(0).cast("smallint"), BINS + 1)).otherwise(F.concat(F.array(F.lit(1).cast("smallint")), _densified(_bins(h)))))


def packed(numbers: Column) -> Column:
    """Two hex digits for each bin; texts without words have the empty string."""
    digits = F.array_join(F.transform(F.slice(numbers, 2, BINS), lambda v: F.lpad(F.lower(F.hex(v)), 2, "0")), "")
    return F.when(F.get(numbers, F.lit(0)) == 0, "").otherwise(digits)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets, corrected for chance agreement of BITS bits."""
    same = F.aggregate(F.zip_with(F.slice(a, 2, BINS), F.slice(b, 2, BINS), lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 2.0**-BITS
    estimate = F.greatest((same / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))
    return F.when((F.get(a, F.lit(0)) == 0) | (F.get(b, F.lit(0)) == 0), (F.get(a, F.lit(0)) == F.get(b, F.lit(0))).cast("double")).otherwise(estimate)


def _constants(values, kind: str) -> Column:
    """An array that is one constant of the plan, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many bounds are up to value (null: -1): first among every ``step``-th of them, then inside one step."""
    if not bounds:
        return F.when(value.isNull(), F.lit(-1)).otherwise(F.lit(0))
    step = math.isqrt(len(bounds)) + 1
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    skipped = (F.greatest(upto(_constants(bounds[::step], "bigint")), F.lit(1)) - 1) * step
    return F.when(value.isNull(), F.lit(-1)).otherwise(common.let(skipped, lambda s: s + upto(F.slice(_constants(bounds, "bigint"), s + 1, F.lit(step)))).cast("int"))


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id", derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """docs with next_<column> of the row that follows in descending key order; the first follows the last.

    derive adds columns to rows of docs; it is applied once to all rows, and to the first row of each range.

    Rows are dealt to ranges of the key; windows look inside a range, and one row of each range is joined to the
    range before.  Rows of equal keys follow each other in the order of their text's hash.  Ranges are cut at quantiles
    of the keys, so gaps between keys don't matter, and their number grows with the rows.
    """
    n = docs.count()
    ranges = max(1, min(MOST_RANGES, n // NEIGHBOURS))
    shares = _constants((i / ranges for i in range(1, ranges)), "double")
    bounds = docs.agg(F.percentile_approx(F.col(key).cast("long"), shares, F.lit(max(10_000, 4 * ranges)))).first()[0] if ranges > 1 else []
    number = _range_of(F.col(key).cast("long"), sorted(set(bounds or [])))
    tie = F.xxhash64(columns[0])
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("_h").desc())
    tops = docs.select(number.alias("_h"), F.col(key).alias("_k")).groupBy("_h").agg(F.max("_k").alias("_k"))  # one row for each range
    tops = tops.select("_h", *[F.coalesce(F.lead(c).over(order), F.first(c).over(order.rowsBetween(Window.unboundedPreceding, 0))).alias(f"_next{c}") for c in ("_h", "_k")])
    own = F.struct(*[F.col(c) for c in columns])
    heads = docs.join(F.broadcast(tops), (number == F.col("_next_h")) & F.col(key).eqNullSafe(F.col("_next_k")))
    heads = heads.withColumn("_i", F.row_number().over(Window.partitionBy("_h").orderBy(tie))).where("_i = 1")
    heads = derive(heads).select("_h", own.alias("_head"))
    w = Window.partitionBy("_r").orderBy(F.col(key).desc(), tie)
    rows = derive(docs)
    names = rows.columns
    rows = rows.withColumn("_r", number).withColumn("_next", F.lead(own).over(w))
    both = rows.join(heads, (F.col("_r") == F.col("_h")) & F.col("_next").isNull(), "left").withColumn("_n", F.coalesce("_next", "_head"))
    return both.select(*names, *[F.col("_n")[c].alias(f"next_{c}") for c in columns])


def edited_text(text: Column, following: Column) -> Column:
    """text with its last floor(n/2) characters replaced by as many of the following text's first ones."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of the text and of its edited text, and likenesses to that and to the next document."""
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, ["text", "fp"], derive=lambda df: df.withColumn("fp", fingerprint(F.col("text"))))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp", edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    rows = rows.withColumn("efp", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("fp")).alias("fingerprint"),
        packed(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(common.documents(spark, sf_dir))
