"""Ordered computations over groups of which one may hold most rows: running sums and maxima, neighbours, row numbers.

Groups of up to ``HOT_ROWS`` rows take a plain window.  Larger ones are cut into pieces by ranges of their order; each
piece is a window of its own, and what earlier pieces of the group hold is carried into it: a row for each piece, so a
group of any size is spread over as many tasks as its rows need.  Results don't depend on which way a group goes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.storage import materialise

HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Running:
    """sum, max, count: over the rows up to this one, or with ``before`` up to the one before it (null if none).

    lag, lead: the neighbour's value as a struct (x), null without a neighbour.
    """

    kind: str
    column: Column | str = ""
    before: bool = False


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def hot_groups(df: DataFrame, group: list[str], limit: int) -> DataFrame | None:
    """Groups of more than ``limit`` rows, under names of their own; None if there is none."""
    found = df.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).drop("_n")
    rows = found.collect()  # at most the table's rows / limit
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


class Ordered:
    """A table whose rows have a total order within each group; ``with_columns`` adds what the order decides."""

    def __init__(self, df: DataFrame, group: list[str], order: list[str | Column], limit: int | None = None, hot: DataFrame | None | bool = True):
        """hot: what hot_groups found for this table or one that holds its rows, if that is known."""
        self.group, self.order = group, [_column(c) for c in order]
        if hot is True:
            hot = hot_groups(df, group, HOT_ROWS if limit is None else limit)
        self.plain, self.cut = df, None
        if hot is not None:
            keys = [f"_g{i}" for i in range(len(group))]
            self.plain = df.join(F.broadcast(hot), _same(group, keys), "left_anti")
            ranged = df.join(F.broadcast(hot), _same(group, keys), "left_semi").repartitionByRange(*[F.col(g) for g in group], *self.order)
            self.cut = materialise(ranged.withColumn("_piece", F.spark_partition_id()), "pieces")

    def with_columns(self, **outs: Running) -> Ordered:
        result = Ordered.__new__(Ordered)
        result.group, result.order = self.group, self.order
        w = Window.partitionBy(*self.group).orderBy(*self.order)
        result.plain = self.plain.withColumns({name: self._local(r, w) for name, r in outs.items()})
        result.cut = None if self.cut is None else self._carried(outs)
        return result

    @staticmethod
    def _local(r: Running, w) -> Column:
        if r.kind in ("lag", "lead"):
            return getattr(F, r.kind)(F.struct(_column(r.column).alias("x"))).over(w)
        value = F.count("*") if r.kind == "count" else getattr(F, r.kind)(_column(r.column))
        return value.over(w.rowsBetween(Window.unboundedPreceding, -1 if r.before else 0))

    def _carried(self, outs: dict[str, Running]) -> DataFrame:
        w = Window.partitionBy(*self.group, "_piece").orderBy(*self.order)
        made = {f"_l_{name}": self._local(r, w) for name, r in outs.items()}
        made |= {f"_v_{name}": _column(r.column) for name, r in outs.items() if r.kind != "count"}
        rows = materialise(self.cut.withColumns(made | {"_at": F.row_number().over(w)}), "pieces")
        keys = [f"_g{i}" for i in range(len(self.group))]
        held = []
        for name, r in outs.items():
            v = F.col(f"_v_{name}") if r.kind != "count" else None
            if r.kind == "lag":  # what the next piece finds before it
                held.append(F.max_by(F.struct(v.alias("x")), "_at").alias(f"_h_{name}"))
            elif r.kind == "lead":
                held.append(F.min_by(F.struct(v.alias("x")), "_at").alias(f"_h_{name}"))
            else:
                held.append((F.count("*") if r.kind == "count" else getattr(F, r.kind)(v)).alias(f"_h_{name}"))
        pieces = rows.groupBy(*[F.col(g).alias(k) for g, k in zip(self.group, keys)], F.col("_piece").alias("_of_piece")).agg(F.count("*").alias("_rows"), *held)
        by = Window.partitionBy(*keys).orderBy("_of_piece")  # a row for each piece of a group
        earlier = by.rowsBetween(Window.unboundedPreceding, -1)
        carries = []
        for name, r in outs.items():
            c = F.col(f"_h_{name}")
            carry = F.lag(c).over(by) if r.kind == "lag" else F.lead(c).over(by) if r.kind == "lead" else (F.max(c) if r.kind == "max" else F.sum(c)).over(earlier)
            carries.append(carry.alias(f"_c_{name}"))
        pieces = pieces.select(*keys, "_of_piece", "_rows", *carries)
        rows = rows.join(F.broadcast(pieces), _same([*self.group, "_piece"], [*keys, "_of_piece"]))  # pieces: at most as many as partitions and hot groups
        final = {}
        for name, r in outs.items():
            local, carry = F.col(f"_l_{name}"), F.col(f"_c_{name}")
            if r.kind == "lag":
                final[name] = F.when(F.col("_at") == 1, carry).otherwise(local)
            elif r.kind == "lead":
                final[name] = F.when(F.col("_at") == F.col("_rows"), carry).otherwise(local)
            elif r.kind == "max":
                final[name] = F.greatest(local, carry)
            else:
                final[name] = F.when(local.isNull(), carry).otherwise(local + F.coalesce(carry, F.lit(0)))
            if r.kind == "count" and r.before:
                final[name] = local + F.coalesce(carry, F.lit(0))
        kept = [c for c in self.cut.columns if c not in outs]
        return rows.select(*kept, *[v.alias(k) for k, v in final.items()])

    def rows(self) -> DataFrame:
        return self.plain if self.cut is None else self.plain.unionByName(self.cut.drop("_piece"))

    def where(self, condition: Column | str) -> Ordered:
        """Rows that stay; the order of the others is as before."""
        result = Ordered.__new__(Ordered)
        result.group, result.order = self.group, self.order
        result.plain, result.cut = self.plain.where(condition), None if self.cut is None else self.cut.where(condition)
        return result
