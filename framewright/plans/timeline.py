"""The shot-aligned timeline: the engine's main query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators.documents import ordered_text
from framewright.operators.intervals import point_in_interval


def timeline_rows(shots: DataFrame, segments: DataFrame, profile: DataFrame, frames: DataFrame, key: str = "video_id", t: str = "t", width: int | None = None) -> DataFrame:
    """shots (key, id, start, end) with frames, type and the dialogue of the segments (key, t, event_id, text) that start in them."""
    spoken = point_in_interval(segments, shots.select(key, "id", "start", "end"), key, t, width, None)
    words = ordered_text(spoken, [key, "id"], [t, "event_id"], F.col("text"), " ", "dialogue")
    rows = shots.join(frames.select(key, "id", "first_frame", "last_frame"), [key, "id"], "left").join(profile.select(key, "id", "dominant_type"), [key, "id"], "left").join(words, [key, "id"], "left")
    none = F.lit("")
    return rows.select(
        key, "id", "start", "end", (F.col("end") - F.col("start")).alias("dur"), F.coalesce("first_frame", none).alias("ff"), F.coalesce("last_frame", none).alias("lf"),
        F.coalesce("dominant_type", F.lit("mixed")).alias("type"), F.coalesce("dialogue", none).alias("dialogue"),
    )
