"""Layout rows behind the timeline report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from framewright.operators.scans import Scan, scans

PIXELS, LEAST_HEIGHT, TICK, TILE = 396.0, 280.0, 10, 60_000


def offsets(shots: DataFrame, key: str, duration: Column, pixels: float = PIXELS, least: float = LEAST_HEIGHT, width: int = 4096) -> DataFrame:
    """Adds h, y_start, y_end and total: heights proportional to the duration with a floor, stacked in order of id, `width` ids to a cell."""
    tall = shots.withColumn("h", F.greatest(duration * pixels, F.lit(least)))
    stacked = scans(tall, [key], ["id"], width, y_start=Scan("sum", F.col("h")))
    total = tall.groupBy(F.col(key).alias("__k")).agg(F.sum("h").alias("total"))
    return stacked.withColumns({"y_start": F.col("y_start").cast("double"), "y_end": F.col("y_start") + F.col("h")}).join(total, F.col(key).eqNullSafe(F.col("__k"))).drop("__k")


def ticks(durations: DataFrame, key: str, every: int = TICK) -> DataFrame:
    return durations.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.floor("duration").cast("long"), F.lit(every).cast("long"))).alias("tick"))


def tiles(heights: DataFrame, key: str, size: int = TILE) -> DataFrame:
    """key, tile, tile_height: the last tile holds what is left."""
    n = F.ceil(F.col("total") / size).cast("int")
    cells = heights.where(F.col("total") > 0).select(key, "total", F.explode(F.sequence(F.lit(0), n - 1)).alias("tile"))
    return cells.select(key, "tile", F.least(F.lit(float(size)), F.col("total") - F.col("tile") * size).alias("tile_height"))


def duration_class(duration: Column, short: float = 1.5, long: float = 8.0) -> Column:
    return F.when(duration < short, "short").when(duration > long, "long").otherwise("")


def marker_class(duration: Column) -> Column:
    return F.struct(F.when(duration > 2, "major").otherwise("minor").alias("marker"), (duration >= 1.5).alias("labelled"))


def duration_stats(shots: DataFrame, key: str, duration: str, end: str, short: float, long: float) -> DataFrame:
    """Per video: shots, short and long ones, mean duration (0 without shots) and the end of the last shot by id."""
    return shots.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_shots"), F.count_if(F.col(duration) < short).alias("n_short"), F.count_if(F.col(duration) > long).alias("n_long"),
        F.coalesce(F.avg(duration), F.lit(0.0)).alias("mean_duration"), F.max_by(end, "id").alias("total_duration"),
    )


def neighbours(shots: DataFrame, key: str) -> DataFrame:
    order = W.partitionBy(key).orderBy("id")
    return shots.withColumn("prev_id", F.lag("id").over(order)).withColumn("next_id", F.lead("id").over(order))


def bars(buckets: DataFrame, step: Column, y: str, y_next: str, width: float) -> DataFrame:
    """Adds bar_h and bar_w: a bucket's height between its own and the next place (1 where they agree), its width by percentage."""
    height = F.col(y_next) - F.col(y)
    return buckets.withColumn("bar_h", F.greatest(F.lit(0.5), F.when(height == 0, 1.0).otherwise(height))).withColumn("bar_w", F.col("pct") / 100 * width * 0.45)


def bar_tiles(bars: DataFrame, key: str, y: str, total: str, size: int = TILE, near: float = 1.0) -> DataFrame:
    """Bars cut at the tiles that a page of height `total` is drawn in: a row for each tile that a bar's top lies in, or up to `near` above.

    Adds tile, y_in (the top inside the tile; negative above it) and drawn (the height that the tile, of whole pixels, shows). A bar lies in two tiles at
    most, and one of a page without height in none.
    """
    n = F.ceil(F.col(total) / size)
    first, last = F.greatest(F.lit(0), F.ceil(F.col(y) / size) - 1), F.least(n - 1, F.floor((F.col(y) + near) / size))
    placed = bars.withColumn("tile", F.explode(F.when(last >= first, F.sequence(first, last)))).withColumn("tile", F.col("tile").cast("int"))
    height = F.least(F.lit(float(size)), F.col(total) - F.col("tile") * size)
    placed = placed.withColumn("y_in", F.col(y) - F.col("tile") * size).where(F.col("y_in") <= height)
    return placed.withColumn("drawn", F.greatest(F.lit(0.0), F.least(F.floor(height).cast("double"), F.col("y_in") + F.col("bar_h")) - F.greatest(F.lit(0.0), F.col("y_in"))))
