"""Media columns: payloads kept as lossless images in archives, read back through a custom Spark data source.

`store_media` turns each payload into an 8-bit grayscale PNG of 64 samples a row and appends it as a
member to a tar archive in the shared folder; a task closes an archive at about ARCHIVE_BYTES and
writes an index of members (offset, size, check sum) beside it, which gets its name by a move once it is whole. The data source
`member_archive` plans byte ranges over the indexed archives of a folder, streams the members whose header lies
in its range as Arrow batches, and retries a member by its own offset over a new connection when a read fails,
comes back short or does not match its check sum, so that one bad read does not repeat the others. An archive
without an index is what a lost executor leaves; it is not read. Archives carry the task attempt's own
name; those that no finished task reported are left out after reading.

Defined cases: a null text is an empty payload (64 zero bytes); a null doc_id is kept; rows that
repeat a doc_id are members of their own; an empty table gives an empty table; only doc_id and text
are read, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import time
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from framewright.llm.common import materialize, scratch_path, table

ROW = 64
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
PNG_MAGIC = b"\x89PNG\r\n\x1a\n"  # fixed value of the format
MEMBER = "archive string, offset long, name string, media binary"


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % ROW if raw else ROW)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(rows), ROW + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return PNG_MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> np.ndarray:
    """The samples of an image that to_png wrote, checked chunk by chunk."""
    if media[:8] != PNG_MAGIC:
        raise ValueError("not a PNG")
    at, body, shape = 8, [], None
    while at < len(media):
        n = struct.unpack_from(">I", media, at)[0]
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack_from(">I", media, at + 8 + n)[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            shape = struct.unpack(">II", data[:8])
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(shape[1], shape[0] + 1)
    return lines[:, 1:].ravel()


def features(samples: np.ndarray) -> str:
    """Mean, deviation, entropy and roughness of the samples."""
    counts = np.bincount(samples, minlength=256)
    share = counts[counts > 0] / len(samples)
    levels = np.arange(256)
    mean = int((counts * levels).sum()) / len(samples)
    deviation = (int((counts * levels * levels).sum()) / len(samples) - mean * mean) ** 0.5
    steps = int(np.abs(np.diff(samples.astype(np.int16))).sum()) / max(1, len(samples) - 1)
    return f"mean={mean:.4f};dev={deviation:.4f};entropy={-(share * np.log2(share)).sum():.4f};step={steps:.4f}"


class _Archive:
    """One tar file and its index, written when closed."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.fs, self.path, self.out, self.at, self.index = fs, path, fs.open_output_stream(path), 0, []

    def add(self, name: str, media: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(media)
        block = info.tobuf(tarfile.USTAR_FORMAT) + media + bytes(-len(media) % 512)
        self.out.write(block)
        self.index.append((self.at, len(media), zlib.crc32(media)))
        self.at += len(block)

    def close(self) -> tuple[str, int]:
        self.out.write(bytes(1024))
        self.out.close()
        with self.fs.open_output_stream(self.path + ".part") as f:
            f.write(np.asarray(self.index, "<i8").tobytes())
        self.fs.move(self.path + ".part", self.path + ".idx")
        return self.path.rpartition("/")[2], len(self.index)


def store_media(docs: DataFrame, folder: str) -> DataFrame:
    """Write the payloads of docs below folder (a URI or path that all executors share); one row per finished archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        done, archive = [], None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode()
                archive = archive or _Archive(fs, f"{root}/{uuid.uuid4().hex}.tar")
                archive.add(f"{'' if doc_id is None else doc_id}_{len(raw)}.png", to_png(padded(raw)))
                if archive.at >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        names, members = zip(*done, strict=True) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(members, pa.int64())], names=["done", "members"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(write, "done string, members long")


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, range_bytes: int, tries: int):
        self.folder, self.range_bytes, self.tries = folder, range_bytes, tries

    def partitions(self) -> list[ByteRange]:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        found = {f.path: f.size for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))}
        ranges = [
            ByteRange(path, at, min(at + self.range_bytes, found[path]))
            for path in sorted(found) if path.endswith(".tar") and path + ".idx" in found
            for at in range(0, found[path], self.range_bytes)
        ]
        return ranges or [ByteRange("", 0, 0)]

    def connect(self, path: str) -> pa.NativeFile:
        return pafs.FileSystem.from_uri(self.folder)[0].open_input_file(path)

    def member(self, held: list[pa.NativeFile], path: str, offset: int, size: int, crc: int) -> tuple[str, bytes]:
        """One member by its offset from the open file in held, tried anew on its own, with a new file, when a read fails or comes back damaged."""
        for left in range(self.tries - 1, -1, -1):
            try:
                if not held:
                    held.append(self.connect(path))
                block = held[0].read_at(512 + size, offset)
                info = tarfile.TarInfo.frombuf(block[:512], "utf-8", "strict")
                if info.size != size or len(block) != 512 + size or zlib.crc32(block[512:]) != crc:
                    raise OSError(f"short, foreign or damaged member at {offset} of {path}")
                return info.name, block[512:]
            except (OSError, tarfile.HeaderError):
                while held:
                    held.pop().close()
                if not left:
                    raise
                time.sleep(0.1 * (self.tries - left))
        raise AssertionError

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        with self.connect(part.path + ".idx") as f:
            index = np.frombuffer(f.read(), "<i8").reshape(-1, 3)
        low, high = np.searchsorted(index[:, 0], [part.start, part.end])
        archive, rows, held, open_files = part.path.rpartition("/")[2], [], 0, []
        for offset, size, crc in index[low:high].tolist():
            name, media = self.member(open_files, part.path, offset, size, crc)
            rows.append((archive, offset, name, media))
            held += size
            if held >= BATCH_BYTES:
                yield self.batch(rows)
                rows, held = [], 0
        if rows:
            yield self.batch(rows)
        for f in open_files:
            f.close()

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["archive", "offset", "name", "media"])


class ArchiveSource(DataSource):
    """spark.read.format("member_archive").load(folder); options rangeBytes, tries."""

    @classmethod
    def name(cls) -> str:
        return "member_archive"

    def schema(self) -> str:
        return MEMBER

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)), int(self.options.get("tries", 3)))


def read_media(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("member_archive").load(folder)


def describe_media(members: DataFrame) -> DataFrame:
    """Decode members and compute what op10 reports of each, beside archive and offset."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["archive", "offset", "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for archive, offset, name, media in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_id, _, n = name.removesuffix(".png").partition("_")
                samples = from_png(media)
                payload = samples.tobytes()
                rows.append((archive, offset, int(doc_id) if doc_id else None, int(n), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(media), hashlib.sha256(media).hexdigest(), features(samples)))
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "archive string, offset long, doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return members.mapInArrow(decode, schema)


def media_column(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_path(spark, "media")
    finished = materialize(store_media(docs, folder), "media-archives")
    seen = describe_media(read_media(spark, folder))
    return seen.join(finished, seen["archive"] == finished["done"], "left_semi")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_column(table(spark, sf_dir, "documents")).drop("archive", "offset")
