"""The binary edge: PCM sound and image frames as tables. Decoders of compressed media are plug-ins that yield the same tables."""

from __future__ import annotations

import wave
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.text import frame_rate

BLOCK = 8192
PART_BYTES = 1 << 25
PCM = "path string, rate int, block_no long, samples array<float>"
FRAME = "video_id string, frame_no long, t double, hist array<float>, b double, g double, r double"


def open_input(path: str) -> BinaryIO:
    """A file at a path or URI of any file system that pyarrow knows, read from where the reader seeks to."""
    system, inner = fs.FileSystem.from_uri(quote(path, safe="/:@")) if ":/" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def pcm_blocks(raw: BinaryIO, part: int = 0, parts: int = 1) -> Iterator[tuple[int, int, np.ndarray]]:
    """rate, block number and mono samples in [-1, 1) of one of `parts` runs of blocks of a 16-bit WAV file; two channels are averaged, more are left interleaved."""
    with wave.open(raw) as w:
        rate, channels, blocks = w.getframerate(), w.getnchannels(), -(-w.getnframes() // BLOCK)
        first, end = blocks * part // parts, blocks * (part + 1) // parts
        w.setpos(first * BLOCK)
        for n in range(first, end):
            x = np.frombuffer(w.readframes(BLOCK), "<i2").astype(np.float32) / 32768
            yield rate, n, x.reshape(-1, 2).mean(axis=1) if channels == 2 else x


def read_wav(spark: SparkSession, path: str, opener: Callable[[str], BinaryIO] = open_input, part_bytes: int = PART_BYTES) -> DataFrame:
    """Blocks of samples of the WAV files below a path. Parts of about part_bytes of a file spread over tasks, each of which seeks to its own blocks."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part, parts in zip(batch["path"], batch["part"], batch["parts"], strict=True):
                with opener(name) as raw:
                    for rate, n, x in pcm_blocks(raw, part, parts):
                        yield pd.DataFrame({"path": [name], "rate": [rate], "block_no": [n], "samples": [x]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path)
    parts = files.select("path", F.greatest(F.lit(1), F.ceil(F.col("length") / part_bytes)).cast("int").alias("parts"))
    spread = parts.select("path", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts").repartition("path", "part")
    return spread.mapInPandas(decode, PCM)


def samples_of(blocks: DataFrame) -> DataFrame:
    """path, number, t (seconds), amplitude and rate of every sample."""
    rows = blocks.select("path", "rate", "block_no", F.posexplode("samples").alias("pos", "amplitude"))
    number = F.col("block_no") * BLOCK + F.col("pos")
    return rows.select("path", number.alias("number"), (number / F.col("rate")).alias("t"), "amplitude", "rate")


def histogram(pixels: np.ndarray, bins: int = 8) -> np.ndarray:
    """The normalised colour histogram of an RGB image, red slowest."""
    cell = np.clip(pixels.reshape(-1, 3).astype(np.int64) // (256 // bins), 0, bins - 1)
    counts = np.bincount((cell[:, 0] * bins + cell[:, 1]) * bins + cell[:, 2], minlength=bins**3).astype(np.float32)
    return counts / max(counts.sum(), 1)


def read_frames(spark: SparkSession, path: str, video_id: str, decode: Callable[[bytes], np.ndarray], fps: float = 5.0, pattern: str = "f*.*") -> DataFrame:
    """Frame features of an image folder; decode is the plug-in from bytes to an RGB array, frame numbers come from the names."""

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, raw in zip(batch["path"], batch["content"], strict=True):
                rgb = decode(raw)
                n = int("".join(c for c in name.rpartition("/")[2].partition(".")[0] if c.isdigit()))
                r, g, b = (float(v) for v in rgb.reshape(-1, 3).mean(axis=0))
                rows.append((video_id, n, n / fps, histogram(rgb), b, g, r))
            yield pd.DataFrame(rows, columns=["video_id", "frame_no", "t", "hist", "b", "g", "r"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return files.mapInPandas(features, FRAME)


def media_table(spark: SparkSession, path: str, probe: Callable[[str], tuple[str, float | None, str]], pattern: str = "*.mp4") -> DataFrame:
    """path, codec, duration and fps of media files; probe is the plug-in from a path to (codec, seconds or None, `num/den`).

    Unknown durations count as 0 and unknown rates as 30, so that later steps can tell and still run.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(p, *probe(p)) for p in batch["path"]], columns=["path", "codec", "duration", "rate"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")
    seen = files.mapInPandas(look, "path string, codec string, duration double, rate string")
    return seen.select("path", F.lower("codec").alias("codec"), F.coalesce("duration", F.lit(0.0)).alias("duration"), frame_rate(F.col("rate")).alias("fps"))


def needs_transcode(codec: Column) -> Column:
    return F.coalesce(F.lower(codec) == "av1", F.lit(False))


def choose_waveform(stored: DataFrame | None, computed: DataFrame | None, silent: DataFrame) -> DataFrame:
    """A stored waveform comes first, then one computed from stems, then silence."""
    return stored if stored is not None else computed if computed is not None else silent
