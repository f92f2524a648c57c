"""Rules of cuts and captions on streams, decided by event-time timers as soon as the watermark says that nothing before can still come.

Both keep per video only what is still open: cuts whose span has not passed, probes that wait and segments that they may need. Rows older than the watermark are dropped.
Rows without a video are left out. They need the RocksDB state store (`state_store` in buckets.py sets it for a session).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class BurstZones(StatefulProcessor):
    """Cuts (k, t) of one video in; zones (k, zs, ze, n) out, as `folds.burst_zones` gives them for cuts in order of t."""

    def __init__(self, span: int, least: int, before: int, after: int):
        self.span, self.least, self.before, self.after = span, least, before, after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("cuts", "t long")
        self.passed = handle.getValueState("passed", "t long, n long")  # how many cuts at the time of the last one are behind

    def _settled(self, key: tuple, cuts: list[int], watermark: int) -> Iterator[pd.DataFrame]:
        at, behind = self.passed.get() if self.passed.exists() else (None, 0)
        cuts.sort()
        i, found = 0, []
        while i < len(cuts) and watermark >= cuts[i] + self.span - 1:
            near = [t for t in cuts[i:] if t < cuts[i] + self.span]  # all of them are known
            n = len(near) + (behind if at == cuts[i] else 0) + sum(t == cuts[i] for t in cuts[:i])
            if n >= self.least:
                found.append((*key, cuts[i] - self.before, near[-1] + self.after, n))
            i += n if n >= self.least else 1
        gone, left = cuts[:i], cuts[i:]
        if gone:
            self.passed.update((gone[-1], gone.count(gone[-1]) + (behind if at == gone[-1] else 0)))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if left:
            self.open.put([(t,) for t in left])
            self.handle.registerTimer(-(-(left[0] + self.span) // 1000))
        else:
            self.open.clear()
            self.passed.clear()  # all that comes is later than the watermark, and so than the cuts that passed
        if found:
            yield pd.DataFrame(found, columns=["k", "zs", "ze", "n"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cuts = [t for (t,) in self.open.get()] if self.open.exists() else []
        for batch in rows:
            cuts += batch["t"].tolist()
        yield from self._settled(key, cuts, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        cuts = [t for (t,) in self.open.get()] if self.open.exists() else []
        yield from self._settled(key, cuts, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


class CaptionLookup(StatefulProcessor):
    """Segments (start, end, text) and probes (id, t) of one video in; each probe with its text out, as `intervals.as_of` gives it.

    A probe's segment is the first that ends after it. It is settled when the watermark has passed the end of the first one known, or t + longest: what comes later has then started after t.
    """

    def __init__(self, longest: int, columns: list[str]):
        self.longest, self.columns = longest, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.segments = handle.getListState("segments", "end long, start long, text string")
        self.probes = handle.getListState("probes", "t long, id string")

    @staticmethod
    def _order(s: tuple) -> tuple:
        return s[0], s[1], s[2] is not None, s[2] or ""

    def _settled(self, key: tuple, new_segments: list[tuple], new_probes: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        segments = sorted([*(self.segments.get() if self.segments.exists() else []), *new_segments], key=self._order)
        probes = [*(self.probes.get() if self.probes.exists() else []), *new_probes]
        found, waiting, due = [], [], []
        for t, probe in probes:
            first = next((s for s in segments if s[0] > t), None)
            known = first is not None and first[0] <= watermark
            if known or watermark >= t + self.longest:
                found.append((*key, probe, t, first[2] if known and first[1] <= t else None))
            else:
                waiting.append((t, probe))
                due.append(min(t + self.longest, first[0] if first else t + self.longest))
        needed = min([watermark, *[t for t, _ in waiting]])
        held = [tuple(s) for s in segments if s[0] > needed]
        for state, rows in ((self.segments, held), (self.probes, waiting)):
            state.put(rows) if rows else state.clear()
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if due:
            self.handle.registerTimer(-(-min(due) // 1000))
        elif held:
            self.handle.registerTimer(-(-held[-1][0] // 1000))  # only to let go of them
        if found:
            yield pd.DataFrame(found, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        segments, probes = [], []
        for batch in rows:
            for is_segment, t, start, text, probe in batch[["is_segment", "t", "start", "text", "id"]].itertuples(index=False):
                if is_segment:
                    segments.append((int(t), int(start), None if pd.isna(text) else text))
                else:
                    probes.append((int(t), probe))
        yield from self._settled(key, segments, probes, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(key, [], [], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def _clock(t: str):
    return F.timestamp_micros(F.col(t))


def burst_stream(cuts: DataFrame, key: str, t: str, span: int, least: int = 3, before: int = 0, after: int = 0, late: str = "1 hour") -> DataFrame:
    """key, zs, ze, n of a stream of cuts; t is in microseconds, and cuts come at most `late` after later ones."""
    rows = cuts.select(F.col(key).alias("k"), F.col(t).cast("long").alias("t"), _clock(t).alias("at")).where("k IS NOT NULL").withWatermark("at", late)
    out = f"k {rows.schema['k'].dataType.simpleString()}, zs long, ze long, n long"
    found = rows.groupBy("k").transformWithStateInPandas(BurstZones(span, least, before, after), out, "append", "eventtime")
    return found.select(F.col("k").alias(key), "zs", "ze", "n")


def caption_stream(probes: DataFrame, segments: DataFrame, key: str, t: str, probe_id: str, longest: int, late: str = "1 hour") -> DataFrame:
    """Each probe (key, t, probe_id) of a stream with the text of a stream of segments (key, start, end, text) that are at most `longest` microseconds long; a segment's time is its end."""
    kind = probes.schema[probe_id].dataType.simpleString()  # ids travel as strings, as pandas has no null in whole numbers
    none = lambda k: F.lit(None).cast(k)
    left = probes.select(F.col(key).alias("k"), F.lit(False).alias("is_segment"), F.col(t).cast("long").alias("t"), F.col(t).cast("long").alias("start"), none("string").alias("text"), F.col(probe_id).cast("string").alias("id"), _clock(t).alias("at"))
    right = segments.select(F.col(key).alias("k"), F.lit(True).alias("is_segment"), F.col("end").cast("long").alias("t"), F.coalesce("start", "end").cast("long").alias("start"), "text", none("string").alias("id"), _clock("end").alias("at"))
    rows = left.unionByName(right).where("k IS NOT NULL").withWatermark("at", late)
    out = f"k {rows.schema['k'].dataType.simpleString()}, id string, t long, text string"
    found = rows.groupBy("k").transformWithStateInPandas(CaptionLookup(longest, ["k", "id", "t", "text"]), out, "append", "eventtime")
    return found.select(F.col("k").alias(key), F.col("id").cast(kind).alias(probe_id), F.col("t").alias(t), "text")
