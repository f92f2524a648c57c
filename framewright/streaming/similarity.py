"""Similarity of each frame of a stream to the one `lag` frames before, with the last `lag` histograms of a video as its state, until the video is idle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def correlations(now: list[np.ndarray], was: list[np.ndarray], flat: float | None) -> list[float | None]:
    """Pearson correlation of each pair; `flat` stands where one of them does not vary."""
    if not now:
        return []
    a, b = np.stack(now).astype(float), np.stack(was).astype(float)
    a, b = a - a.mean(axis=1, keepdims=True), b - b.mean(axis=1, keepdims=True)
    norm = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    return [float(s / n) if n else flat for s, n in zip((a * b).sum(axis=1), norm, strict=True)]


def lag_stream(stream: DataFrame, key: str, frame: str, hist: str, lag: int = 15, flat: float | None = None, idle: float = 86_400) -> DataFrame:
    """key, frame, sim of a stream of frames; the first `lag` frames of a video have none, as in `series.lag_similarity`.

    Frames of a video arrive in order from batch to batch; inside a batch they are sorted. A task holds one video's rows of one
    batch, which the source bounds (`maxFilesPerTrigger`), and its state never holds more than `lag` histograms. A null histogram
    counts as a frame: it has a null similarity, and so has none the frame `lag` after it. The state of a video without new frames
    for `idle` seconds is given up; frames that come after all start anew.
    """
    rows = stream.select(F.col(key).alias("k"), F.col(frame).cast("long").alias("frame"), F.col(hist).cast("array<double>").alias("hist"), F.current_timestamp().alias("at"))
    rows = rows.withWatermark("at", "1 second")  # the time of arrival is the clock, so that a stream that is drained ends

    def follow(of: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new = pd.concat(list(chunks)).sort_values("frame")
        held = [None if h is None else np.asarray(h) for h in (state.get[0] if state.exists else [])]
        first = len(held)
        held += [None if h is None else np.asarray(h) for h in new["hist"]]
        pairs = [(i, held[i], held[i - lag]) for i in range(max(first, lag), len(held)) if held[i - lag] is not None]
        whole = [p for p in pairs if p[1] is not None]
        sims = dict(zip([i for i, _, _ in whole], correlations([n for _, n, _ in whole], [w for _, _, w in whole], flat), strict=True))
        state.update(([None if h is None else h.tolist() for h in held[-lag:]],))
        state.setTimeoutTimestamp(int((new["at"].max().timestamp() + idle) * 1000))
        at = [i for i, _, _ in pairs]
        frames = new["frame"].to_numpy()
        yield pd.DataFrame({"k": [of[0]] * len(at), "frame": [frames[i - first] for i in at], "sim": pd.array([sims.get(i) for i in at], dtype="Float64")})

    out = f"k {rows.schema['k'].dataType.simpleString()}, frame long, sim double"
    followed = rows.groupBy("k").applyInPandasWithState(follow, out, "tail array<array<double>>", "append", GroupStateTimeout.EventTimeTimeout)
    return followed.select(F.col("k").alias(key), F.col("frame").alias(frame), "sim")
