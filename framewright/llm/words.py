"""Words of a batch of texts as numbers, by numpy and Arrow over the bytes of the whole batch at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

GAP, WORD, BREAK = 0, 1, 2
CHUNK_BYTES = 16 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_kinds(gap: bytes, breaks: bytes = b"") -> np.ndarray:
    """The kind of each byte: GAP between words, BREAK between pieces of words, else WORD."""
    kinds = np.full(256, WORD, np.uint8)
    kinds[list(gap)] = GAP
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass
class Words:
    """tokens: the words; piece: words of one piece have one number; row: the text of each word; start, end: byte places in its text.

    per_row: words of each text; data: the lower-cased bytes of all texts (and eight zeros), offsets: where each begins there.
    """

    tokens: pa.Array
    piece: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    per_row: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.row)

    def coded(self, at: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
        """The distinct words (of the given places), and each one's number among them."""
        coded = (self.tokens if at is None else self.tokens.take(pa.array(at))).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        base = self.offsets[self.row]
        return hash_ranges(self.data, base + self.start, base + self.end)


def split_words(texts: pa.Array, kinds: np.ndarray) -> Words:
    """Lower-cases A-Z and splits; a null text has no words. No word or piece crosses texts."""
    held = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(held)
    offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = held.buffers()[2] if n else None
    size = int(offsets[-1] - offsets[0]) if raw is not None else 0
    data = np.zeros(size + 8, np.uint8)
    if size:
        np.take(LOWER, np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]], out=data[:size])
    offsets = offsets - offsets[0]
    kind = kinds[data[:size]]
    edge = np.ones(size + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets] = True
    places = np.flatnonzero(edge)
    kind = kind[places[:-1]] if size else kind
    tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(kind), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)])
    is_word = kind == WORD
    start, end = places[:-1][is_word], places[1:][is_word]
    per_row = np.diff(np.searchsorted(start, offsets))
    row = np.repeat(np.arange(n), per_row)
    piece = np.cumsum(kind == BREAK, dtype=np.int64)[is_word] + row
    return Words(tokens.filter(pa.array(is_word)), piece, row, start - offsets[row], end - offsets[row], per_row, data, offsets)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes, by steps of eight; at least eight bytes follow the last range."""
    if not len(start):
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    size = end - start
    out = size.astype(np.uint64)
    live = slice(None)
    for done in range(0, int(size.max()), 8):
        left = np.minimum(size[live] - done, 8).astype(np.uint64)
        value = eight[start[live] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        out[live] = mixed(out[live], value)
        live = np.flatnonzero(size > done + 8)
    return out


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows as batches of about `size` bytes of the column: small ones joined, large ones cut between rows."""
    held, total = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
        ends = total + np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            end = min(int(np.searchsorted(ends, size)) + 1, batch.num_rows)
            end = max(end, begin + 1)
            held.append(batch.slice(begin, end - begin))
            total = int(ends[end - 1])
            if total >= size:
                yield joined(held)
                held, ends, total = [], ends - total, 0
            begin = end
        total = int(ends[-1]) if batch.num_rows and held else total
    if held:
        yield joined(held)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    return table.to_batches()[0] if table.num_rows else batches[0]


def name_hashes(names: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in names), np.uint64, len(names))


def mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One step of a 64-bit hash over a sequence of hashes."""
    x = (state ^ value) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))
