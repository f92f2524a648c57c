"""Shot detection from tables: detector cuts and frame similarities in, numbered shots out.

Times are integer microseconds. Decoding frames and the adaptive detector are plug-ins; see sources/media.py.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators import folds, intervals, series
from framewright.storage import kept as stored

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
CELL_ROWS = 4096


@dataclass(frozen=True)
class Settings:
    leading: int = SECOND // 10
    coarse: float = 0.90
    fine: float = 0.88
    near: int = 3 * SECOND // 10
    gap: int = 3 * SECOND // 10
    gap_inside: int = SECOND // 2
    gap_outside: int = SECOND
    burst: int = 2 * SECOND
    before: int = SECOND // 5
    after: int = SECOND // 2
    long_shot: int = 3 * SECOND
    least_shot: int = 3 * SECOND // 10
    valley: float = 0.78
    shoulder: float = 0.93
    low: float = 0.90
    lag: int = 15
    fps: float = 30.0
    apart: int = 8 * SECOND // 10


def histogram_cuts(coarse: DataFrame, fine: DataFrame, psd: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Places where the coarse frames (video_id, frame_no, t, hist) change; those that no detector cut is near move to the
    least similarity of the fine series (video_id, n, t, sim) around them."""
    sim = series.lag_similarity(coarse, ["video_id"], "frame_no", "hist", 1, "cosine").where(F.col("sim") < s.coarse)
    raw = sim.join(coarse.select("video_id", "frame_no", "t"), ["video_id", "frame_no"]).select("video_id", F.col("frame_no").alias("seq"), "t")
    close = intervals.band(raw, psd, "video_id", "t", s.near, True, MINUTE)
    loose = intervals.band(raw, psd, "video_id", "t", s.near, False, MINUTE)
    f = fine.select("video_id", F.col("t").alias("ft"), "sim").where(F.col("sim") < 1.0)
    around = intervals.near_points(loose, f, "video_id", "t", "ft", s.near)
    best = around.groupBy("video_id", "seq").agg(F.min(F.struct("sim", "ft"))["ft"].alias("best"))
    moved = loose.join(best, ["video_id", "seq"], "left").select("video_id", "seq", F.coalesce("best", "t").alias("t"))
    return close.unionByName(moved)


def merge_cuts(psd: DataFrame, hist: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """The merged cuts (video_id, t) and the burst zones (video_id, zs, ze)."""
    hist = stored(hist, "detect-hist")
    zones = stored(folds.burst_zones(hist, "video_id", "t", "seq", s.burst, 3, s.before, s.after), "detect-zones")
    both = psd.select("video_id", "t", F.lit(True).alias("is_psd")).unionByName(hist.select("video_id", "t", F.lit(False).alias("is_psd")))
    one = both.groupBy("video_id", "t").agg(F.max("is_psd").alias("is_psd"))
    kept = stored(folds.gap_dedupe(stored(one, "detect-cuts"), "video_id", "t", "is_psd", s.gap), "detect-apart")
    flagged = stored(intervals.zone_flags(kept, zones, "video_id", "t", HOUR), "detect-flagged")
    return folds.zone_min_gap(flagged, "video_id", "t", "in_zone", s.gap_inside, s.gap_outside).select("video_id", "t"), zones


def long_shot_cuts(cuts: DataFrame, zones: DataFrame, durations: DataFrame, fine: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Changes of the fine series inside long shots that do not start in a burst."""
    bounds = intervals.with_sentinels(cuts, durations, "video_id", "t", F.lit(0).cast("long"))
    spans = intervals.boundaries_to_intervals(bounds, "video_id", "t", width=HOUR).where(F.col("end") - F.col("start") >= s.long_shot)
    calm = intervals.in_zone(spans, zones, "video_id", "start", False, HOUR).select("video_id", "start", "end")
    calm = stored(calm, "detect-calm")
    return intervals.point_in_interval(fine.where(F.col("sim") < s.fine), calm, "video_id", "t", MINUTE).where(F.col("t") > F.col("start")).select("video_id", "t")


def dissolve_cuts(slow: DataFrame, frames: DataFrame, cuts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Middles of gradual transitions: valleys of the lag series (video_id, n, t, sim) between steady, shifted and monotone colours (frames: video_id, n, b, g, r)."""
    v = series.local_valley(slow, ["video_id"], ["n"], "sim", s.valley, width=CELL_ROWS)
    v = series.shoulders(v, ["video_id"], ["n"], "sim", s.shoulder, width=CELL_ROWS)
    v = series.run_bounds(series.low_runs(v, ["video_id"], ["n"], "sim", s.low), ["video_id"], "n", "sim", s.low)
    v = stored(v, "detect-runs")
    found = v.where("is_valley AND has_shoulders").where(F.col("run_length") / s.fps < 1.0)
    rounded = cuts.select("video_id", (F.round(F.col("t") / (SECOND // 10)) * (SECOND // 10)).cast("long").alias("t"))
    free = intervals.band(found.select("video_id", F.col("n").alias("cand"), "t", "vs", "ve"), rounded, "video_id", "t", s.apart, False, MINUTE)
    near = series.neighbourhood(free, frames.select("video_id", "n", "b", "g", "r"), "video_id", "n", s.lag)
    stats = series.transition_stats(near, "video_id", "cand", ["b", "g", "r"])
    steady = stats.where("n_pre >= 5 AND n_post >= 5 AND n_in >= 3 AND dev_pre < 8 AND dev_post < 8")
    kept = None
    for c in ("b", "g", "r"):
        shift = F.col(f"post_{c}") - F.col(f"pre_{c}")
        moved = near.join(steady.select("video_id", "cand", shift.alias("shift")), ["video_id", "cand"])
        share = series.monotone_share(moved, "video_id", "cand", "f_n", c, F.signum("shift"))
        judged = steady.select("video_id", "cand", (F.abs(shift) >= 3).alias("shifts")).join(share, ["video_id", "cand"])
        row = judged.select("video_id", "cand", F.col("shifts"), (~F.col("shifts") | (F.col("share") >= 0.7)).alias("fine"))
        kept = row if kept is None else kept.unionByName(row)
    good = kept.groupBy("video_id", "cand").agg(F.bool_or("shifts").alias("any"), F.bool_and("fine").alias("all")).where("any AND all")
    return free.join(good, ["video_id", "cand"], "left_semi").select("video_id", "t")


def detect_shots(psd: DataFrame, coarse: DataFrame, fine: DataFrame, slow: DataFrame, frames: DataFrame, durations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """All passes: video_id, id, start, end, duration (microseconds)."""
    psd = psd.where(F.col("t") > s.leading)
    merged, zones = merge_cuts(psd, histogram_cuts(coarse, fine, psd, s), s)
    merged = stored(merged, "detect-merged")
    third = merged.unionByName(long_shot_cuts(merged, zones, durations, fine, s)).distinct()
    third = stored(third, "detect-third")
    final = stored(third.unionByName(dissolve_cuts(slow, frames, third, s)).distinct(), "detect-final")
    bounds = intervals.with_sentinels(final, durations, "video_id", "t", F.lit(0).cast("long"))
    shots = intervals.number_intervals(intervals.boundaries_to_intervals(bounds, "video_id", "t", width=HOUR).select("video_id", "start", "end"), "video_id", F.lit(s.least_shot), HOUR)
    return shots.withColumn("duration", F.col("end") - F.col("start"))


def detector_shots(psd: DataFrame, durations: DataFrame) -> DataFrame:
    """Detection in one stage: the detector's own cuts (video_id, t) from the start of a video to its end, none dropped."""
    bounds = intervals.with_sentinels(psd.select("video_id", "t"), durations, "video_id", "t", F.lit(0).cast("long"))
    shots = intervals.number_intervals(intervals.boundaries_to_intervals(bounds.distinct(), "video_id", "t", width=HOUR).select("video_id", "start", "end"), "video_id", width=HOUR)
    return shots.withColumn("duration", F.col("end") - F.col("start"))


def refined_scenes(scenes: DataFrame, parts: DataFrame, longest: int = 8 * SECOND, least: int = 12 * SECOND // 10) -> DataFrame:
    """Detection in two stages: long scenes (video_id, start, end) give way to their parts (video_id, of_start, start, end), then fragments are merged."""
    held = intervals.replace_long(scenes, parts, "video_id", longest)
    bounds = held.select("video_id", F.explode(F.array("start", "end")).alias("t"))
    merged = folds.merge_fragments(bounds, "video_id", "t", least)
    return merged.withColumn("duration", F.col("end") - F.col("start"))
