"""Intervals on a time axis per video: construction, membership, bands, as-of lookups and positions.

Times are BIGINT microseconds or DOUBLE seconds alike. Every join has the video as its key; where a single video
may hold very many rows, `width` adds cells of time to the key, so that its rows spread over tasks: intervals lie in the nodes of a binary hierarchy of
cells (twice as many at most as the logarithm of their cells), and a point probes its node on each level that is in use. Orders of a video are scanned in two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from framewright.operators.scans import Scan, numbered, scans


def boundaries_to_intervals(points: DataFrame, key: str, t: str, *ties: str, width: float | None = None) -> DataFrame:
    """Consecutive points as [start, end); the last point of a key starts none."""
    if width is not None:
        after = scans(points, [key], [t, *ties], width, __end=Scan("nearest", F.col(t), forward=False))
        return after.withColumn("start", F.col(t)).withColumn("end", F.col("__end")).where(F.col("end").isNotNull()).drop("__end")
    order = W.partitionBy(key).orderBy(t, *ties)
    return points.withColumn("start", F.col(t)).withColumn("end", F.lead(t).over(order)).where(F.col("end").isNotNull())


def with_sentinels(cuts: DataFrame, durations: DataFrame, key: str, t: str, zero: Column) -> DataFrame:
    """[0] + cuts + [duration] for each video; durations: key, duration."""
    ends = durations.select(key, F.explode(F.array(zero, F.col("duration"))).alias(t))
    return cuts.select(key, t).unionByName(ends).distinct()


def number_intervals(intervals: DataFrame, key: str, least: Column | None = None, width: float | None = None) -> DataFrame:
    """Dense ids from 1 in order of start; intervals below the least length are dropped, not merged."""
    kept = intervals if least is None else intervals.where(F.col("end") - F.col("start") >= least)
    if width is not None:
        return numbered(kept, [key], ["start", "end"], width, "id")
    return kept.withColumn("id", F.row_number().over(W.partitionBy(key).orderBy("start", "end")).cast("long"))


def cell_nodes(low: Column, high: Column, width: float) -> Column:
    """The nodes (level, cell) of a binary hierarchy that make up the cells, `width` long, of the closed interval [low, high]: at most two a level. Node c of level k is the cells c * 2**k up to the next."""
    first, end = F.floor(low / width).cast("long"), F.floor(high / width).cast("long") + 1

    def of(k: Column) -> Column:
        left, right = -F.call_function("shiftright", -first, k), F.call_function("shiftright", end, k)
        node = lambda c, odd: F.when((left < right) & (F.pmod(odd, F.lit(2)) == 1), F.struct(k.alias("level"), c.alias("cell")))
        return F.array(node(left, left), node(right - 1, right))

    levels = F.sequence(F.lit(0), F.length(F.bin(end - first)))
    return F.when(end > first, F.array_compact(F.flatten(F.transform(levels, of))))


def spread_nodes(points: DataFrame, t: Column, intervals: DataFrame, low: Column, high: Column, width: float | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points and closed intervals with the node that they share as further keys of their join; a point meets an interval in one node at most. Without a width a single node.

    The levels in use, at most 64 numbers, are looked up at once.
    """
    if width is None:
        return points.withColumn("__cell", F.lit(0)), intervals.withColumn("__cell", F.lit(0)), ["__cell"]
    spread = intervals.withColumn("__node", F.explode(cell_nodes(low, high, width)))
    spread = spread.withColumns({"__level": F.col("__node.level"), "__cell": F.col("__node.cell")}).drop("__node")
    used = sorted(r[0] for r in spread.select("__level").distinct().collect())
    own = F.floor(t / width).cast("long")
    probes = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(own, k).alias("cell")) for k in used]).cast("array<struct<level:int,cell:bigint>>")
    probed = points.withColumn("__node", F.explode(probes)).withColumns({"__level": F.col("__node.level"), "__cell": F.col("__node.cell")}).drop("__node")
    return probed, spread, ["__level", "__cell"]


def point_in_interval(points: DataFrame, intervals: DataFrame, key: str, t: str, width: int | None = None, first: list[str] | None = None) -> DataFrame:
    """points with the interval that holds t in [start, end); `first` names the point's identity where intervals may overlap: the earliest wins."""
    live = intervals.where(F.col("end") > F.col("start"))
    p, i, node = spread_nodes(points, F.col(t), live, F.col("start"), F.col("end"), width)
    found = p.join(i, [key, *node]).where((F.col(t) >= F.col("start")) & (F.col(t) < F.col("end"))).drop(*node)
    if first is None:
        return found
    nth = F.row_number().over(W.partitionBy(key, *first).orderBy("start", "end"))
    return found.withColumn("__nth", nth).where(F.col("__nth") == 1).drop("__nth")


def band(a: DataFrame, b: DataFrame, key: str, t: str, tolerance: float, inside: bool, width: int | None = None) -> DataFrame:
    """Rows of a with (inside) or without a row of b closer than the tolerance, strictly."""
    near = b.select(F.col(key).alias("__k"), F.col(t).alias("__t"))
    on = (F.col(key) == F.col("__k")) & (F.abs(F.col(t) - F.col("__t")) < tolerance)
    if width is not None:
        size = max(width, int(tolerance))
        a = a.withColumn("__bucket", F.floor(F.col(t) / size))
        near = near.withColumn("__b", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.floor(F.col("__t") / size) + d)))
        on = on & (F.col("__bucket") == F.col("__b"))
    return a.join(near, on, "left_semi" if inside else "left_anti").drop("__bucket")


def _cells(low: Column, high: Column, width: float) -> Column:
    """The cells of an axis, `width` long, that the closed interval [low, high] touches; none for an empty one. For intervals of a bounded number of cells."""
    first, last = F.floor(low / width), F.floor(high / width)
    return F.when(last >= first, F.sequence(first, last))


def spread_cells(points: DataFrame, t: Column, intervals: DataFrame, low: Column, high: Column, width: float | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points and closed intervals with the cell that they share as a further key of their join; without a width a single cell."""
    if width is None:
        return points.withColumn("__cell", F.lit(0)), intervals.withColumn("__cell", F.lit(0)), ["__cell"]
    return points.withColumn("__cell", F.floor(t / width)), intervals.withColumn("__cell", F.explode(_cells(low, high, width))), ["__cell"]


def zone_flags(points: DataFrame, zones: DataFrame, key: str, t: str, width: float, out: str = "in_zone") -> DataFrame:
    """Adds whether t lies in some closed zone [zs, ze] of the key: the furthest end of the zones that have started is not before it. A zone is one row however long it is."""
    p = points.withColumns({"__at": F.col(t), "__side": F.lit(1)})
    z = zones.where(F.col("zs").isNotNull() & F.col("ze").isNotNull() & F.col(key).isNotNull()).select(key, F.col("zs").alias("__at"), F.lit(0).alias("__side"), F.col("ze").alias("__ze"))
    seen = scans(p.unionByName(z, allowMissingColumns=True), [key], ["__at", "__side"], width, __top=Scan("max", F.col("__ze"))).where("__side = 1")
    return seen.select(*points.columns, F.coalesce(F.col("__top") >= F.col(t), F.lit(False)).alias(out))


def in_zone(points: DataFrame, zones: DataFrame, key: str, t: str, inside: bool = True, width: float | None = None) -> DataFrame:
    """Rows whose t lies in some closed zone [zs, ze] of the key, or in none."""
    if width is not None:
        return zone_flags(points, zones, key, t, width, "__in").where(F.col("__in") == inside).drop("__in")
    z = zones.select(F.col(key).alias("__k"), "zs", "ze")
    return points.join(z, (F.col(key) == F.col("__k")) & (F.col(t) >= F.col("zs")) & (F.col(t) <= F.col("ze")), "left_semi" if inside else "left_anti")


def as_of(probes: DataFrame, segments: DataFrame, key: str, t: str, probe_id: str, width: int | None = None) -> DataFrame:
    """probes with the first segment (key, start, end, text) that ends after t, where it has started by then; else null text.

    A sorted merge: probes and segment ends share one window per video, in which each probe looks at the last segment
    of a descending order. Probes at a segment's very end no longer see it. With a width the windows
    hold one cell of time; a probe with no segment left in its cell takes the first one of the later cells.
    """
    left = probes.select(F.col(key), F.col(probe_id), F.col(t).alias("__at"), F.lit(None).cast("struct<start:bigint,end:bigint,text:string>").alias("__s"), F.lit(1).alias("__side"))
    right = segments.select(F.col(key), F.lit(None).cast(probes.schema[probe_id].dataType).alias(probe_id), F.col("end").alias("__at"), F.struct("start", "end", "text").alias("__s"), F.lit(0).alias("__side"))
    both = left.unionByName(right).withColumn("__cell", F.lit(0).cast("long") if width is None else F.floor(F.col("__at") / width))
    before = W.partitionBy(key, "__cell").orderBy(*[F.col(c).desc() for c in ("__at", "__side", "__s.start", "__s.text")]).rowsBetween(W.unboundedPreceding, -1)
    seen = both.withColumn("__next", F.last("__s", ignorenulls=True).over(before)).where(F.col("__side") == 1)
    if width is not None:
        first = both.groupBy(key, "__cell").agg(F.min(F.when(F.col("__side") == 0, F.struct("__at", "__s.start", "__s.text", "__s")))["__s"].alias("__first"))
        later = W.partitionBy(key).orderBy(F.col("__cell").desc()).rowsBetween(W.unboundedPreceding, -1)
        carried = first.select(F.col(key).alias("__k"), F.col("__cell").alias("__c"), F.last("__first", ignorenulls=True).over(later).alias("__later"))
        seen = seen.join(carried, (F.col(key) == F.col("__k")) & (F.col("__cell") == F.col("__c"))).withColumn("__next", F.coalesce("__next", "__later"))
    hit = F.col("__next.start") <= F.col("__at")
    return seen.select(key, probe_id, F.col("__at").alias(t), F.when(hit, F.col("__next.text")).alias("text"))


def position_of_time(times: DataFrame, layout: DataFrame, key: str, t: str, probe_id: str, width: float | None = None) -> DataFrame:
    """Linear position of t in layout (key, start, end, y_start, y_end, total, last_end), first closed interval first; beyond the end the total, in gaps 0."""
    bounds = layout.groupBy(key).agg(F.max("last_end").alias("__end"), F.max("total").alias("__total"))
    p, i, cell = spread_nodes(times, F.col(t), layout.drop("total", "last_end"), F.col("start"), F.col("end"), width)
    inside = p.join(i, [key, *cell]).where((F.col(t) >= F.col("start")) & (F.col(t) <= F.col("end")))
    y = F.col("y_start") + F.try_divide((F.col(t) - F.col("start")) * (F.col("y_end") - F.col("y_start")), F.col("end") - F.col("start"))
    best = inside.groupBy(key, probe_id).agg(F.min_by(y, F.struct("start", "end")).alias("__y"))
    return times.join(bounds, key).join(best, [key, probe_id], "left").select(key, probe_id, t, F.when(F.col(t) >= F.col("__end"), F.col("__total")).otherwise(F.coalesce("__y", F.lit(0.0))).alias("y"))


def time_of_position(places: DataFrame, layout: DataFrame, key: str, y: str, probe_id: str, width: float | None = None) -> DataFrame:
    """The inverse: below 0 the time 0, past the layout its end. width is a length of the layout."""
    bounds = layout.groupBy(key).agg(F.max("last_end").alias("__end"))
    p, i, cell = spread_nodes(places, F.col(y), layout.drop("total", "last_end"), F.col("y_start"), F.col("y_end"), width)
    inside = p.join(i, [key, *cell]).where((F.col(y) >= F.col("y_start")) & (F.col(y) <= F.col("y_end")))
    t = F.col("start") + F.try_divide((F.col(y) - F.col("y_start")) * (F.col("end") - F.col("start")), F.col("y_end") - F.col("y_start"))
    best = inside.groupBy(key, probe_id).agg(F.min_by(t, F.struct("y_start", "y_end")).alias("__t"))
    return places.join(bounds, key).join(best, [key, probe_id], "left").select(key, probe_id, y, F.when(F.col(y) < 0, F.lit(0.0)).otherwise(F.coalesce("__t", F.col("__end").cast("double"))).alias("t"))


def near_points(a: DataFrame, b: DataFrame, key: str, t: str, other: str, reach: int) -> DataFrame:
    """Rows of a with each row of b of their key at most `reach` away; cells of the axis spread a long video's rows."""
    width = max(1, 8 * reach)
    p, i, cell = spread_cells(b, F.col(other), a, F.col(t) - reach, F.col(t) + reach, width)
    return i.join(p, [key, *cell]).where(F.abs(F.col(other) - F.col(t)) <= reach).drop(*cell)


def replace_long(scenes: DataFrame, parts: DataFrame, key: str, longest) -> DataFrame:
    """Scenes (key, start, end) with those longer than `longest` replaced by their parts (key, of_start, start, end), where there is more than one."""
    several = parts.groupBy(key, "of_start").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select(F.col(key).alias("__k"), F.col("of_start").alias("__of"))
    long = F.col("end") - F.col("start") > longest
    cut = scenes.where(long).join(several, (F.col(key) == F.col("__k")) & (F.col("start") == F.col("__of"))).select("__k", "__of")
    gone = (F.col(key) == F.col("__k")) & (F.col("start") == F.col("__of"))
    inside = parts.join(cut, (F.col(key) == F.col("__k")) & (F.col("of_start") == F.col("__of")), "left_semi").select(key, "start", "end")
    return scenes.select(key, "start", "end").join(cut, gone, "left_anti").unionByName(inside)
