"""Similarity series of frames and the transition detector on them: windows over each video's ordered frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from framewright.functions.arrays import cosine, pearson
from framewright.operators.intervals import near_points, spread_cells
from framewright.operators.scans import numbered, runs, with_halo

CELL_ROWS = 4096


def lag_similarity(frames: DataFrame, keys: list[str], frame: str, hist: str, lag: int, kind: str, flat: float | None = None) -> DataFrame:
    """keys, frame, sim between a frame's histogram and the one `lag` frames before; the first `lag` frames have none."""
    wide = frames.select(*keys, frame, F.col(hist).cast("array<double>").alias("__h"))
    before = F.lag("__h", lag).over(W.partitionBy(*keys).orderBy(frame) if keys else W.orderBy(frame))
    pairs = wide.withColumn("__p", before).where(F.col("__p").isNotNull())
    sim = cosine(F.col("__h"), F.col("__p")) if kind == "cosine" else pearson(F.col("__h"), F.col("__p"), flat)
    return pairs.select(*keys, frame, sim.alias("sim"))


def _rows(keys: list[str], order: list[str], low: int, high: int) -> object:
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(low, high)


def _around(series: DataFrame, keys: list[str], order: list[str], left: int, right: int, width: int | None, added) -> DataFrame:
    """Adds columns that look at `left` rows before and `right` after, given by added(keys). With a width the first column of the order numbers the rows without gaps, and the windows hold one cell of so many rows."""
    if width is None:
        return series.withColumns(added(keys))
    near, cell = with_halo(series, keys, F.col(order[0]), width, left, right)
    return near.withColumns(added(cell)).where("__own").drop("__own", "__cell")


def local_valley(series: DataFrame, keys: list[str], order: list[str], value: str, below: float, left: int = 9, right: int = 8, least: int = 3, width: int | None = None) -> DataFrame:
    """Adds is_valley: below the threshold and no higher than the rows on both sides, of which there are enough; ties all count."""
    low = lambda w: F.coalesce(F.col(value) <= F.min(value).over(w), F.lit(False)) & (F.count(value).over(w) >= least)
    added = lambda of: {"is_valley": (F.col(value) < below) & low(_rows(of, order, -left, -1)) & low(_rows(of, order, 1, right))}
    return _around(series, keys, order, left, right, width, added)


def shoulders(series: DataFrame, keys: list[str], order: list[str], value: str, above: float, left: int = 15, right: int = 14, width: int | None = None) -> DataFrame:
    """Adds has_shoulders: some row on each side lies above the threshold."""
    top = lambda of, low, high: F.coalesce(F.max(value).over(_rows(of, order, low, high)) > above, F.lit(False))
    return _around(series, keys, order, left, right, width, lambda of: {"has_shoulders": top(of, -left, -1) & top(of, 1, right)})


def low_runs(series: DataFrame, keys: list[str], order: list[str], value: str, below: float, width: float = CELL_ROWS) -> DataFrame:
    """Adds run_length: the length of the contiguous run of rows below the threshold that a low row lies in, else 0. Cells are `width` long on the first column of the order."""
    named = numbered(series, keys, order, width, "__n")
    found = runs(named, keys, "__n", F.col(value) < below, CELL_ROWS)
    return found.select(*series.columns, F.coalesce(F.col("ve") - F.col("vs"), F.lit(0)).cast("long").alias("run_length"))


def run_bounds(series: DataFrame, keys: list[str], n: str, value: str, below: float) -> DataFrame:
    """Adds vs and ve: the first row number of a low row's run and the one after its last; rows are numbered without gaps."""
    return runs(series, keys, n, F.col(value) < below, CELL_ROWS)


def neighbourhood(candidates: DataFrame, frames: DataFrame, key: str, n: str, reach: int) -> DataFrame:
    """Each candidate (key, cand, vs, ve) with the frames within reach of its valley, tagged pre, in or post."""
    f, c, cell = spread_cells(frames.withColumnRenamed(n, "f_n"), F.col("f_n"), candidates, F.col("vs") - reach, F.col("ve") + reach - 1, 8 * reach)
    where = (F.col("f_n") >= F.col("vs") - reach) & (F.col("f_n") < F.col("ve") + reach)
    part = F.when(F.col("f_n") < F.col("vs"), "pre").when(F.col("f_n") < F.col("ve"), "in").otherwise("post")
    return c.join(f, [key, *cell]).where(where).withColumn("part", part).drop(*cell)


def transition_stats(near: DataFrame, key: str, cand: str, channels: list[str]) -> DataFrame:
    """Per candidate: rows, population deviation (largest over channels) and means of the parts before, in and after its valley."""
    of = lambda part, c: F.when(F.col("part") == part, F.col(c))
    out = [F.count_if(F.col("part") == p).alias(f"n_{p}") for p in ("pre", "in", "post")]
    for p in ("pre", "post"):
        devs = [F.coalesce(F.stddev_pop(of(p, c)), F.lit(0.0)) for c in channels]
        out.append((F.greatest(*devs) if len(devs) > 1 else devs[0]).alias(f"dev_{p}"))
        out += [F.avg(of(p, c)).alias(f"{p}_{c}") for c in channels]
    return near.groupBy(key, cand).agg(*out)


def monotone_share(near: DataFrame, key: str, cand: str, n: str, channel: str, direction: Column, slack: float = 1.0) -> DataFrame:
    """The share of steps inside the valley that follow the direction (to within slack); divided by rows, not by steps."""
    step = (F.col(channel) - F.lag(channel).over(W.partitionBy(key, cand).orderBy(n))) * direction
    inside = near.where(F.col("part") == "in").withColumn("__step", step)
    return inside.groupBy(key, cand).agg((F.count_if(F.col("__step") >= -slack) / F.count(F.lit(1))).alias("share"))


def refine_argmin(candidates: DataFrame, series: DataFrame, key: str, cand: str, at: str, n: str, value: str, reach: int, below: float = 1.0) -> DataFrame:
    """The place of the first least value within reach of a candidate's place, where it is below the bound; else its own place."""
    s = series.select(key, F.col(n).alias("__n"), F.col(value).alias("__v")).where(F.col("__v") < below)
    near = near_points(candidates, s, key, at, "__n", reach)
    best = near.groupBy(key, cand).agg(F.min(F.struct("__v", "__n")).alias("__best"))
    return candidates.join(best, [key, cand], "left").select(key, cand, at, F.coalesce("__best.__n", at).alias("refined"))


def histogram_shares(values: DataFrame, keys: list[str], cell: Column) -> DataFrame:
    """keys, bin, n, share: how often each bin occurs among the values of a key, and its share of them. Bins without values have no row."""
    counts = values.groupBy(*keys, cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*keys)))
