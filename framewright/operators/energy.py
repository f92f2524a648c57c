"""Audio energy per shot and per bucket of samples, from long tables of samples (video, stem, t, amplitude)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from framewright.operators.intervals import point_in_interval

FLOOR = 1e-10
STEMS = ("vocals", "drums", "bass", "other")


def rms(x: Column) -> Column:
    return F.sqrt(F.avg(x * x) + F.lit(FLOOR))


def interval_rms(shots: DataFrame, samples: DataFrame, key: str, t: str, stems: tuple[str, ...] = STEMS, width: int | None = None) -> DataFrame:
    """key, id, stem, energy for every shot (key, id, start, end) and stem; shots without samples have 0."""
    found = point_in_interval(samples, shots.select(key, "id", "start", "end"), key, t, width).groupBy(key, "id", "stem").agg(rms(F.col("amplitude")).alias("energy"))
    dense = shots.select(key, "id", F.explode(F.array(*[F.lit(s) for s in stems])).alias("stem"))
    return dense.join(found, [key, "id", "stem"], "left").withColumn("energy", F.coalesce("energy", F.lit(0.0)))


def stem_ratios(energies: DataFrame, key: str) -> DataFrame:
    """Adds ratio: a stem's share of its shot's energy."""
    return energies.withColumn("ratio", F.col("energy") / (F.sum("energy").over(W.partitionBy(key, "id")) + F.lit(FLOOR)))


def wide_ratios(ratios: DataFrame, key: str) -> DataFrame:
    """One row per shot with a column per stem; a missing stem counts as 0."""
    of = lambda s: F.coalesce(F.max(F.when(F.col("stem") == s, F.col("ratio"))), F.lit(0.0)).alias(s)
    return ratios.groupBy(key, "id").agg(*[of(s) for s in STEMS])


def dominant_type(vocals: Column, drums: Column, bass: Column, other: Column, speech: float = 0.5, music: float = 0.5, effects: float = 0.4) -> Column:
    """The first type whose share exceeds its bound, on shares that are not rounded."""
    return F.when(vocals > speech, "dialogue").when(drums + bass > music, "bgm").when(other > effects, "sfx").otherwise("mixed")


def type_distribution(typed: DataFrame, name: str = "dominant_type") -> DataFrame:
    """Counts by type, their percentage of all, to one digit, and their rank: the most frequent first, ties by name. A table of a row a type."""
    counts = typed.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.orderBy(F.col("n").desc(), F.col(name))).cast("long")
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))), 1)).withColumn("place", place).orderBy("place")


def bucket_rms(samples: DataFrame, keys: list[str], number: str, size: int, amplitude: str = "amplitude") -> DataFrame:
    """RMS of each whole bucket of `size` samples numbered from 0; a last, partial bucket is dropped."""
    bucket = F.floor(F.col(number) / size).alias("bucket")
    whole = samples.groupBy(*keys, bucket).agg(rms(F.col(amplitude)).alias("energy"), F.count(F.lit(1)).alias("__n"))
    return whole.where(F.col("__n") == size).drop("__n")


def bucket_percent(buckets: DataFrame, stem: list[str]) -> DataFrame:
    """Adds pct: energy as a whole percentage of the stem's largest, halves to even."""
    top = F.max("energy").over(W.partitionBy(*stem))
    return buckets.withColumn("pct", F.bround(100 * F.col("energy") / F.when(top <= 0, 1.0).otherwise(top), 0).cast("int"))


def global_norm(buckets: DataFrame) -> DataFrame:
    """Adds level: energy over the largest of all stems and buckets, at most 1. Reads buckets once for the largest."""
    top = buckets.agg(F.max("energy")).first()[0]
    return buckets.withColumn("level", F.least(F.lit(1.0), F.try_divide(F.col("energy"), F.lit(top).cast("double"))))


def silent_waveform(durations: DataFrame, stems: tuple[str, ...], step_ms: int = 350) -> DataFrame:
    """Zero buckets for videos (key, duration in seconds) whose stems are missing: at least one each."""
    n = F.greatest(F.lit(1), F.floor(F.col("duration") * 1000 / step_ms)).cast("int")
    return durations.select("*", F.explode(F.array(*[F.lit(s) for s in stems])).alias("stem")).select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("bucket")).withColumn("pct", F.lit(0))


def bucket_slice(buckets: DataFrame, shots: DataFrame, key: str, per_second: Column, start: str = "start", end: str = "end") -> DataFrame:
    """The buckets floor(start * rate) .. floor(end * rate) - 1 of each shot, with bar height max(2, 100 * level)."""
    range_ = shots.select(key, "id", F.floor(F.col(start) * per_second).alias("__a"), F.floor(F.col(end) * per_second).alias("__b"))
    cells = range_.where(F.col("__b") > F.col("__a")).select(key, "id", F.explode(F.sequence(F.col("__a"), F.col("__b") - 1)).alias("bucket"))
    return cells.join(buckets, [key, "bucket"]).withColumn("bar", F.greatest(F.lit(2.0), 100 * F.col("level")))


def spectral_centroid(samples: DataFrame, keys: list[str], number: str, rate: int | str, first: int = 8192, least: int = 256) -> DataFrame:
    """Centroid of the spectrum of each group's first samples, padded to `first`; 0 for short or silent groups. rate: samples a second, or the column that holds it.

    The heads are cut and collected to arrays before Python sees them, a batch of groups at a time.
    """

    @F.pandas_udf("double")
    def centroid(heads: pd.Series, rates: pd.Series) -> pd.Series:
        out, places = np.zeros(len(heads)), {r: np.fft.rfftfreq(first, 1 / r) for r in set(rates)}
        for k, (x, r) in enumerate(zip(heads, rates, strict=True)):
            size = np.abs(np.fft.rfft(np.asarray(x, np.float64), n=first)) if len(x) >= least else np.zeros(1)
            out[k] = round(float((places[r] * size).sum() / size.sum()), 1) if size.sum() >= FLOOR else 0.0
        return pd.Series(out)

    per_second = F.col(rate) if isinstance(rate, str) else F.lit(rate)
    head = samples.select(*keys, per_second.alias("__rate"), F.struct(F.col(number).alias("number"), F.col("amplitude").cast("double").alias("x")).alias("s")).where(F.col("s.number") < first)
    heads = head.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["x"]).alias("head"), F.max("__rate").alias("__rate"))
    return heads.select(*keys, centroid("head", "__rate").alias("centroid"))
