"""Packing token sequences by minimum bin slack.

A document's ids are cut into whole windows and one rest; the rests are packed without further cuts.
Which lengths meet in a window is planned on the histogram of lengths, which has at most `capacity`
rows however many documents there are. For each window the plan starts from the longest length left
and finds, by a subset-sum bitset over the remaining counts, the multiset that fills the window with
the least padding; the counts are backtracked through the layers of the bitset and the multiset is
repeated as often as they allow. What is left at last, less than one window, is split by the same search at powers
of two, where sequences are not padded. Each such step uses up at least one length's usable count, so the
plan stays small and is broadcast (at most capacity times sqrt(2 * capacity) rows). Pieces are then
numbered within their length and look up their window and offset in the plan.

Defined cases: a null or empty text has the end id alone; rows that repeat a doc_id are packed each, equal rows among them in blocks;
an empty table gives an empty table; extra columns are ignored, only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import dense_number, materialize, table

CAPACITY = 2048
END_ID = 1
CHUNK_ROWS = 200
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class PieceIds(dict):
    """The ids of one pre-token as little-endian bytes, from the tokenizer's model."""

    def __init__(self, model, most: int):
        self.model, self.most, self.letters = model, most, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = np.asarray([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()
        if len(self) < self.most:
            self[piece] = ids
        return ids


class WordIds(dict):
    """The ids of a white-space-free chunk of lower-cased Latin text, encoded once.

    The tokenizer drops white space and never joins across it, so that a text's ids are those of its
    chunks one after another. Texts with other characters go to the tokenizer whole. A full
    table takes no more entries: words seen early are the frequent ones.
    """

    #: The tokenizer's own pre-tokens (fixed value).
    pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    #: Beyond these, composition or lower case may differ; Python splits at control separators, and < may start a special token.
    odd = re.compile(r"[^\x00-\u024f]")
    special = ("<", "\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.parts = PieceIds(self.tokenizer.model, most)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = b"".join(map(self.parts.__getitem__, self.pieces.findall(chunk)))
        if len(self) < self.most:
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if any(c in text for c in self.special) or not text.isascii() and self.odd.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.lower().split()))


_held: dict[str, WordIds] = {}


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens (and ids, little-endian binary)."""
    end, width = np.asarray([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _held.setdefault(tokenizer_path, WordIds(tokenizer_path))
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = words.ids(text or "") + end
                for at in range(0, len(ids), width):
                    piece = ids[at : at + width]
                    out.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, *((piece,) if keep_ids else ())))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in range(5 + keep_ids)]
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.binary()) for c in columns[5:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE + (", ids binary" if keep_ids else ""))


def best_fill(left: dict[int, int], longest: int, capacity: int) -> dict[int, int]:
    """The multiset with `longest` that fills a window closest to capacity; of a remainder below capacity, the one closest to a power of two from below."""
    layers, reach, whole = [], 1 << longest, (1 << (capacity + 1)) - 1
    for length in sorted(left, reverse=True):
        count = min(left[length] - (length == longest), (capacity - longest) // length)
        part = 1
        while count > 0:
            take = min(part, count)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & whole
            count, part = count - take, part * 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    if total & (total - 1) and sum(n * c for n, c in left.items()) < capacity:
        total = max((1 << b for b in range(capacity.bit_length()) if reach >> (1 << b) & 1), default=total)
    picked = {longest: 1}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            total -= length * take
            picked[length] = picked.get(length, 0) + take
    return picked


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, pieces a window, first window, offset) for the pieces of each length, numbered from 0."""
    left, used, window, plan = {n: c for n, c in counts.items() if c}, dict.fromkeys(counts, 0), 0, []
    while left:
        picked = best_fill(left, max(left), capacity)
        times, offset = min(left[n] // m for n, m in picked.items()), 0
        for length in sorted(picked, reverse=True):
            m = picked[length]
            plan.append((length, used[length], used[length] + m * times, m, window, offset))
            used[length] += m * times
            left[length] -= m * times
            offset += length * m
            if not left[length]:
                del left[length]
        window += times
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns of pieces_of, each at most capacity long). Reads pieces twice."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(plan_windows(counts, capacity), "p_length long, low long, high long, per long, window long, at long")
    most = max(counts.values(), default=0)
    chunks = max(1, -(-most // max(CHUNK_ROWS, isqrt(most))))  # so that neither a chunk nor the table of a length's chunks outgrows a task
    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    numbered = dense_number(pieces, ["length"], order, "number", ["doc_id", "start", "ids_crc32", "doc_tokens"], chunks)
    nth = F.col("number") - F.col("low")
    meets = (F.col("length") == F.col("p_length")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    return numbered.join(F.broadcast(plan), meets).select(
        *pieces.columns, (F.col("window") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"), (F.col("at") + F.pmod(nth, F.col("per")) * F.col("length")).cast("long").alias("offset")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    return pack(materialize(pieces_of(docs, tokenizer_path, capacity, end_id, keep_ids), "pack-pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
