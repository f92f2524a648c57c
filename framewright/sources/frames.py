"""Frames of uncompressed video (YUV4MPEG2 files) as a table whose filters become seeks.

All frames of such a file have one size, so that a frame number is a place in the file. Filters on frame_no, t and video_id that Spark pushes down choose files and ranges of
frames before any task starts; ranges are dealt to tasks in parts of about PART_BYTES. Decoding compressed video to such files is left to a plug-in or tool outside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, floor, inf

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from framewright.sources.media import FRAME, histogram, open_input

FORMAT = "framewright_y4m"
PART_BYTES = 1 << 25
MARK = b"FRAME\n"
#: What the header calls the subsampling of colour, and the bytes of a frame for each pixel.
LAYOUTS = {"420": (2, 2), "422": (2, 1), "444": (1, 1)}


@dataclass(frozen=True)
class Clip:
    """What a file's header says: where frames start, their size and rate, how many there are."""

    path: str
    video_id: str
    start: int
    width: int
    height: int
    down: tuple[int, int]
    rate: float
    frames: int

    @property
    def size(self) -> int:
        """Bytes of one frame without its mark."""
        return self.width * self.height + 2 * (-(-self.width // self.down[0])) * (-(-self.height // self.down[1]))


@dataclass
class FrameRange(InputPartition):
    clip: Clip | None
    first: int
    end: int


def read_header(path: str) -> Clip:
    """A file whose frames carry parameters of their own, or whose samples have more than 8 bits, is refused: its frames cannot be sought."""
    with open_input(path) as f:
        head = f.read(4096)
        f.seek(0, 2)
        total = f.tell()
    line, found, rest = head.partition(b"\n")
    words = line.decode("ascii", "replace").split(" ")
    if words[0] != "YUV4MPEG2" or not found:
        raise ValueError(f"{path} is no YUV4MPEG2 file")
    said = {w[0]: w[1:] for w in words[1:] if w}
    colour = said.get("C", "420")
    layout = next((v for k, v in LAYOUTS.items() if colour.startswith(k) and "p1" not in colour.removeprefix("420paldv")), None)
    if layout is None or (rest and not rest.startswith(MARK)):
        raise ValueError(f"{path} has frames that cannot be sought ({colour})")
    up, _, down = said.get("F", "25:1").partition(":")
    clip = Clip(path, path.rpartition("/")[2].removesuffix(".y4m"), len(line) + 1, int(said["W"]), int(said["H"]), layout, int(up) / max(1, int(down or 1)), 0)
    return Clip(**{**clip.__dict__, "frames": (total - clip.start) // (clip.size + len(MARK))})


def rgb_of(raw: bytes, clip: Clip) -> np.ndarray:
    """Full-range RGB of one frame's planes (studio levels, BT.601)."""
    w, h = clip.width, clip.height
    cw, ch = -(-w // clip.down[0]), -(-h // clip.down[1])
    y = np.frombuffer(raw, np.uint8, w * h).reshape(h, w).astype(np.float32) - 16
    planes = [np.frombuffer(raw, np.uint8, cw * ch, w * h + k * cw * ch).reshape(ch, cw).astype(np.float32) - 128 for k in (0, 1)]
    u, v = (p.repeat(clip.down[1], 0)[:h].repeat(clip.down[0], 1)[:, :w] for p in planes)
    out = np.stack([1.164 * y + 1.596 * v, 1.164 * y - 0.392 * u - 0.813 * v, 1.164 * y + 2.017 * u], -1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


class FrameReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.part_bytes = options["path"], int(options.get("partBytes", PART_BYTES))
        self.low, self.high = -inf, inf  # frame numbers, both included
        self.t_low, self.t_high = -inf, inf
        self.videos: set | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes note of bounds; gives all filters back, so that Spark still checks each row."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "video_id" and isinstance(f, (EqualTo, In)):
                named = set(f.value) if isinstance(f, In) else {f.value}
                self.videos = named if self.videos is None else self.videos & named
            elif name in ("frame_no", "t") and isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low = {EqualTo: lambda: f.value, In: lambda: min(f.value), GreaterThan: lambda: f.value, GreaterThanOrEqual: lambda: f.value}.get(type(f), lambda: -inf)()  # noqa: B023
                high = {EqualTo: lambda: f.value, In: lambda: max(f.value), LessThan: lambda: f.value, LessThanOrEqual: lambda: f.value}.get(type(f), lambda: inf)()  # noqa: B023
                if name == "frame_no":
                    self.low, self.high = max(self.low, low), min(self.high, high)
                else:
                    self.t_low, self.t_high = max(self.t_low, low), min(self.t_high, high)
            yield f

    def clips(self) -> list[Clip]:
        system, inner = fs.FileSystem.from_uri(self.path) if ":/" in self.path else (fs.LocalFileSystem(), self.path)
        info = system.get_file_info(inner)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
        prefix = self.path.removesuffix(inner)
        names = sorted(prefix + i.path for i in found if i.type == fs.FileType.File and i.path.endswith(".y4m"))
        wanted = [n for n in names if self.videos is None or n.rpartition("/")[2].removesuffix(".y4m") in self.videos]
        return [read_header(n) for n in wanted]

    def partitions(self) -> list[FrameRange]:
        out = []
        for clip in self.clips():
            first = max(0, self.low, floor(self.t_low * clip.rate) - 1 if self.t_low > -inf else 0)
            end = min(clip.frames, self.high + 1, ceil(self.t_high * clip.rate) + 2 if self.t_high < inf else clip.frames)
            first, end = ceil(first), floor(end)
            step = max(1, self.part_bytes // (clip.size + len(MARK)))
            out += [FrameRange(clip, at, min(end, at + step)) for at in range(first, end, step)]
        return out or [FrameRange(None, 0, 0)]  # Spark wants one

    def read(self, partition: FrameRange) -> Iterator[tuple]:
        clip = partition.clip
        if clip is None:
            return
        with open_input(clip.path) as f:
            f.seek(clip.start + partition.first * (clip.size + len(MARK)))
            for n in range(partition.first, partition.end):
                raw = f.read(clip.size + len(MARK))
                if len(raw) < clip.size + len(MARK) or not raw.startswith(MARK):
                    raise ValueError(f"{clip.path} has no whole frame {n}")
                rgb = rgb_of(raw[len(MARK) :], clip)
                r, g, b = (float(x) for x in rgb.reshape(-1, 3).mean(axis=0))
                yield clip.video_id, n, n / clip.rate, histogram(rgb).tolist(), b, g, r


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FRAME

    def reader(self, schema) -> FrameReader:
        return FrameReader(dict(self.options))


def read_video(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Frame features of the YUV4MPEG2 files at a path; filters on video_id, frame_no and t read only their ranges."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameSource)
    return spark.read.format(FORMAT).option("partBytes", str(part_bytes)).load(path)
