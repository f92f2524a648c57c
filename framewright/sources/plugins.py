"""Plug-ins for detectors and speech as table functions of SQL.

A plug-in is a class of the caller's that sees a video's rows one after another; what is registered is a Python table function that takes a TABLE argument and says itself
how Spark shall partition and sort it. `SELECT * FROM cuts_of(TABLE(frames))` gives rows (video_id, t), `SELECT * FROM parts_of(TABLE(long_frames))` parts of long shots,
`SELECT * FROM speech_of(TABLE(blocks))` segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any, Protocol

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import LongType, StringType, StructType


class Plugin(Protocol):
    """Made anew for each video (or long shot): `take` sees its rows in order and `close` its end; both may give results."""

    def take(self, row: Row) -> Iterable[Any]: ...

    def close(self) -> Iterable[Any]: ...


def _table(argument: AnalyzeArgument, needs: list[str]) -> StructType:
    if not argument.isTable:
        raise ValueError("the argument must be a TABLE")
    lacking = [c for c in needs if c not in argument.dataType.fieldNames()]
    if lacking:
        raise ValueError(f"the table lacks {lacking}")
    return argument.dataType


def detector(make: Callable[[], Plugin], t: str = "t") -> Any:
    """A table function from frames (video_id, t and others) to cuts (video_id, t); a plug-in's results are times."""

    class Cuts:
        def __init__(self) -> None:
            self.video, self.plugin = None, None

        @staticmethod
        def analyze(frames: AnalyzeArgument) -> AnalyzeResult:
            kind = _table(frames, ["video_id", t])
            out = StructType().add("video_id", kind["video_id"].dataType).add("t", kind[t].dataType)
            return AnalyzeResult(out, partitionBy=[PartitioningColumn("video_id")], orderBy=[OrderingColumn(t)])

        def eval(self, row: Row) -> Iterable[tuple]:
            if self.plugin is None:
                self.video, self.plugin = row["video_id"], make()
            for at in self.plugin.take(row):
                yield self.video, at

        def terminate(self) -> Iterable[tuple]:
            if self.plugin is not None:
                for at in self.plugin.close():
                    yield self.video, at

    return udtf(Cuts)


def ranged_detector(make: Callable[[], Plugin], t: str = "t") -> Any:
    """A table function from the frames of long scenes (video_id, start, end, t and others) to their parts (video_id, of_start, start, end).

    Cuts inside (start, end) count; a scene without any gives no parts, so that it stays whole in `refined_scenes`.
    """

    class Parts:
        def __init__(self) -> None:
            self.scene, self.plugin, self.cuts = None, None, []

        @staticmethod
        def analyze(frames: AnalyzeArgument) -> AnalyzeResult:
            kind = _table(frames, ["video_id", "start", "end", t])
            out = StructType().add("video_id", kind["video_id"].dataType)
            for name in ("of_start", "start", "end"):
                out = out.add(name, kind["start"].dataType)
            return AnalyzeResult(out, partitionBy=[PartitioningColumn(c) for c in ("video_id", "start", "end")], orderBy=[OrderingColumn(t)])

        def eval(self, row: Row) -> Iterable[tuple]:
            if self.plugin is None:
                self.scene, self.plugin = (row["video_id"], row["start"], row["end"]), make()
            self.cuts += self.plugin.take(row)
            return iter(())

        def terminate(self) -> Iterable[tuple]:
            if self.plugin is None:
                return
            video, start, end = self.scene
            inside = sorted({c for c in [*self.cuts, *self.plugin.close()] if start < c < end})
            edges = [start, *inside, end]
            if inside:
                for a, b in zip(edges, edges[1:], strict=False):
                    yield video, start, a, b

    return udtf(Parts)


def speech(make: Callable[[], Plugin], order: str = "block_no") -> Any:
    """A table function from blocks of sound (video_id, an order and others) to segments (video_id, start, end, text): a plug-in's results are (start, end, text) in microseconds. Blank texts are left out."""

    class Segments:
        def __init__(self) -> None:
            self.video, self.plugin = None, None

        @staticmethod
        def analyze(blocks: AnalyzeArgument) -> AnalyzeResult:
            kind = _table(blocks, ["video_id", order])
            out = StructType().add("video_id", kind["video_id"].dataType).add("start", LongType()).add("end", LongType()).add("text", StringType())
            return AnalyzeResult(out, partitionBy=[PartitioningColumn("video_id")], orderBy=[OrderingColumn(order)])

        def _said(self, found: Iterable[tuple]) -> Iterable[tuple]:
            for start, end, text in found:
                if text.strip():
                    yield self.video, start, end, text.strip()

        def eval(self, row: Row) -> Iterable[tuple]:
            if self.plugin is None:
                self.video, self.plugin = row["video_id"], make()
            yield from self._said(self.plugin.take(row))

        def terminate(self) -> Iterable[tuple]:
            if self.plugin is not None:
                yield from self._said(self.plugin.close())

    return udtf(Segments)


def register_plugins(spark: SparkSession, **functions: Any) -> None:
    """Make table functions known to SQL under the given names."""
    for name, function in functions.items():
        spark.udtf.register(name, function)
