"""Prefix scans of long series in two levels: windows over cells of the axis, and a small table that carries what lies before a cell.

A video's rows are cut into cells of its axis. Each cell is one window's group, so that one long video spreads over tasks; a table of one row for each (video, cell)
is scanned in turn and joined back. Both levels use the same key, so that the rows are shuffled once. Rows whose axis is null form the first cell.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

FIRST = -(1 << 62)


@dataclass(frozen=True)
class Scan:
    """What a row learns from the rows before it (or, not forward, after it): the sum, max or min of a value, or the nearest one that is not null.

    own: whether the row itself counts.
    """

    kind: str
    value: Column
    forward: bool = True
    own: bool = False


def cell_of(axis: Column, width: float) -> Column:
    return F.coalesce(F.floor(axis / width).cast("long"), F.lit(FIRST))


def scans(rows: DataFrame, keys: list[str], order: list[str], width: float, **out: Scan) -> DataFrame:
    """Adds a column for each scan over the rows of the keys in the given order; cells are `width` long on the first column of the order.

    Sums over nothing are 0, all else over nothing is null. Rows that tie in the whole order are taken one after another in an order of Spark's choice.
    """
    celled = rows.withColumn("__cell", cell_of(F.col(order[0]), width))
    celled = celled.withColumns({f"__v_{n}": s.value for n, s in out.items()})
    cell_keys = [f"__k{i}" for i in range(len(keys))]
    # what lies after is scanned in falling order: a frame that ends with the partition is computed anew for each row
    inner = {forward: W.partitionBy(*keys, "__cell").orderBy(*[F.col(c) if forward else F.col(c).desc() for c in order]) for forward in (True, False)}
    outer = {forward: W.partitionBy(*cell_keys).orderBy(F.col("__c") if forward else F.col("__c").desc()).rowsBetween(W.unboundedPreceding, -1) for forward in (True, False)}
    place = F.struct(*order)
    within, totals, carried = {}, [], []
    for n, s in out.items():
        v = F.col(f"__v_{n}")
        near = {"sum": F.sum, "max": F.max, "min": F.min}.get(s.kind, lambda c: F.last(c, ignorenulls=True))
        total = near(v) if s.kind != "nearest" else (F.max_by if s.forward else F.min_by)(v, F.when(v.isNotNull(), place))
        within[f"__w_{n}"] = near(v).over(inner[s.forward].rowsBetween(W.unboundedPreceding, 0 if s.own else -1))
        totals.append(total.alias(f"__t_{n}"))
        carried.append(near(F.col(f"__t_{n}")).over(outer[s.forward]).alias(f"__c_{n}"))
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    cells = celled.groupBy(*named, F.col("__cell").alias("__c")).agg(*totals).select(*cell_keys, "__c", *carried)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], F.col("__cell") == F.col("__c"))
    both = celled.withColumns(within).join(cells, on)
    join = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "min": F.least, "nearest": F.coalesce}
    return both.select(*rows.columns, *[join[s.kind](F.col(f"__w_{n}"), F.col(f"__c_{n}")).alias(n) for n, s in out.items()])


def numbered(rows: DataFrame, keys: list[str], order: list[str], width: float, out: str = "n") -> DataFrame:
    """Adds the number of each row among those of its keys, from 1."""
    return scans(rows, keys, order, width, **{out: Scan("sum", F.lit(1).cast("long"), own=True)})


def runs(rows: DataFrame, keys: list[str], n: str, inside: Column, width: int) -> DataFrame:
    """Adds vs and ve to rows numbered without gaps by n: the first number of the run of rows inside that a row lies in, and the one after its last; null outside."""
    outside = F.when(~F.coalesce(inside, F.lit(False)), F.col(n))
    number = F.col(n)
    sides = {"__before": Scan("max", outside), "__after": Scan("min", outside, forward=False), "__first": Scan("min", number, own=True), "__last": Scan("max", number, forward=False, own=True)}
    found = scans(rows, keys, [n], width, **sides)
    within = F.coalesce(inside, F.lit(False))
    first, end = F.coalesce(F.col("__before") + 1, F.col("__first")), F.coalesce(F.col("__after"), F.col("__last") + 1)
    return found.withColumns({"vs": F.when(within, first), "ve": F.when(within, end)}).drop(*sides)


def with_halo(rows: DataFrame, keys: list[str], axis: Column, width: float, before: float, after: float) -> tuple[DataFrame, list[str]]:
    """Rows with the cells in which they are seen: their own (__own) and those that look `before` back or `after` ahead as far as them (both at most a cell)."""
    own = cell_of(axis, width)
    seen = F.array_distinct(F.filter(F.array(own, cell_of(axis - after, width), cell_of(axis + before, width)), lambda c: c.isNotNull()))
    spread = rows.withColumn("__home", own).withColumn("__cell", F.explode(seen)).withColumn("__own", F.col("__home") == F.col("__cell")).drop("__home")
    return spread, [*keys, "__cell"]
