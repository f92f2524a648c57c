"""Benchmark decontamination: an FM-index for each shard of documents, searched for every window of the test items.

A window is 10 consecutive words of an item, or a whole shorter item. A task gathers documents into a shard and keeps of them only runs of words that could hold
a window: words that the items know, each next to one that follows it in some item too. The runs become an
FM-index over word numbers: backward search through wavelet-tree ranks finds the rows of each window, sampled suffix positions give their places, and the places
merge into removal spans. Whole texts are read; a shard is closed by the words it keeps or the rows it holds.

Items are dealt to blocks of about BLOCK_WORDS words (a long item in pieces that overlap by a window); one block is broadcast at a time, and a further pass over
the documents adds what it finds to the spans, so that memory does not grow with the test set.

Defined cases: a null or empty text has no words and is clean; an item without words has no window; items of one item_id are one item; an item without id counts as ''; rows that
repeat a doc_id are documents each; empty tables give an empty table or clean documents; extra columns pass through `find_passages`, whose own columns win.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import materialize, table
from framewright.llm.fmindex import FMIndex
from framewright.llm.words import Words, byte_kinds, chunks, split_words

WINDOW = 10
BLOCK_WORDS = 1 << 20
PIECE_WORDS = 1 << 14
SHARD_WORDS, SHARD_ROWS = 1 << 21, 100_000
KINDS = byte_kinds(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
PATTERN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SPAN = ["word", "word_end", "start", "end"]
FOUND = {"n_words": "long", "n_hit": "long", "hit_spans": f"array<struct<{','.join(f'{c}:long' for c in SPAN)}>>", "hit_items": "array<string>"}


@dataclass
class Block:
    """Test windows of one block. names: its words, sorted; pairs: word pairs that follow each other; windows: rows of word numbers from 1, padded with 0 at the left; owners: the items of each."""

    names: pa.Array
    pairs: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    owners: list[list[str]]


def item_blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, int]:
    """item_id, words, block: pieces of items of at most PIECE_WORDS + window words, and how many blocks there are."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.regexp_extract_all(lower, F.lit(PATTERN), 0).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1), F.lit(PIECE_WORDS))
    pieces = words.select("item_id", "w", F.explode(starts).alias("at"))
    pieces = materialize(pieces.select("item_id", F.expr(f"slice(w, at, {PIECE_WORDS + window - 1})").alias("words"), "at"), "decontaminate-items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words)) if total else 0
    return pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "at"), F.lit(max(1, blocks)))), blocks


def load_block(pieces: DataFrame, block: int, window: int = WINDOW) -> Block:
    """The windows of one block, of a bounded number of words."""
    held = pieces.where(F.col("block") == block).select("item_id", "words").orderBy("item_id").toArrow()
    lists, ids = held.column("words").combine_chunks(), held.column("item_id").to_pylist()
    words = lists.flatten().cast(pa.large_binary()).dictionary_encode()
    order = pc.array_sort_indices(words.dictionary)
    names = words.dictionary.take(order)
    number = np.empty(len(names), np.int64)
    number[order.to_numpy()] = np.arange(1, len(names) + 1)
    coded = number[words.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    seen: dict[bytes, int] = {}
    owners: list[list[str]] = []
    pairs = [np.zeros(0, np.int64)]
    for item, end, size in zip(ids, ends.tolist(), np.diff(ends, prepend=0).tolist(), strict=True):
        own = coded[end - size : end]
        pairs.append(own[:-1] * (len(names) + 1) + own[1:])
        for at in range(max(1, size - window + 1)):
            k = seen.setdefault(own[at : at + window].tobytes(), len(owners))
            if k == len(owners):
                owners.append([])
            if not owners[k] or owners[k][-1] != item:
                owners[k].append(item)
    windows, lengths = np.zeros((len(seen), window), np.int64), np.zeros(len(seen), np.int64)
    for raw, k in seen.items():
        own = np.frombuffer(raw, np.int64)
        windows[k, window - len(own) :], lengths[k] = own, len(own)
    return Block(names, np.unique(np.concatenate(pairs)), windows, lengths, owners)


def _runs(words: Words, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of the words of kept runs, whether a run ends at each, and their numbers in the block."""
    names, ids = words.coded()
    number = pc.index_in(names, value_set=block.names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ids = number[ids] if len(ids) else ids
    n = len(ids)
    linked = np.zeros(n, bool)  # to the word after
    both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0) & (words.row[:-1] == words.row[1:])) if n else np.zeros(0, np.int64)
    key = ids[both] * (len(block.names) + 1) + ids[both + 1]
    at = np.minimum(np.searchsorted(block.pairs, key), max(0, len(block.pairs) - 1))
    linked[both] = block.pairs[at] == key if len(block.pairs) else False
    first = np.ones(n, bool)
    first[1:] = ~linked[:-1]
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, n))
    keep = (ids[start] > 0) & (size >= block.lengths.min())
    start, size = start[keep], size[keep]
    total = np.cumsum(size)
    place = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - size, size) + np.repeat(start, size)
    ends = np.zeros(len(place), bool)
    ends[total - 1] = True
    return place, ends, ids[place]


class _Shard:
    """Documents gathered until their index is built: kept words with their row and places, and the columns of the rows that are handed on."""

    def __init__(self, block: Block, names: list[str]):
        self.block, self.names, self.parts, self.rows, self.n_rows, self.n_words = block, names, [], [], 0, 0

    def add(self, batch: pa.RecordBatch) -> None:
        words = split_words(batch.column("text"), KINDS)
        place, ends, symbols = _runs(words, self.block)
        row = words.row[place]
        letters = np.zeros(len(words.data) + 1, np.int64)  # code points before each byte
        np.cumsum((words.data & 0xC0) != 0x80, out=letters[1:])
        base = words.offsets[row]
        chars = [letters[base + x[place]] - letters[base] for x in (words.start, words.end)]
        before = np.cumsum(words.per_row) - words.per_row
        self.parts.append((symbols, ends, row + self.n_rows, place - before[row], *chars))
        self.rows.append((batch.select([n for n in self.names if n in batch.schema.names]), words.per_row))
        self.n_rows += batch.num_rows
        self.n_words += len(symbols)

    def found(self) -> Iterator[pa.RecordBatch]:
        """The rows with what this block's windows mark, added to what is there from blocks before."""
        symbols, ends, row, nth, start, end = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        hit, owners = self._search(symbols, ends, row)
        owned: dict[int, set[str]] = {}
        for r, w in owners:
            owned.setdefault(r, set()).update(self.block.owners[w])
        row, nth, start, end = row[hit], nth[hit], start[hit], end[hit]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (nth[1:] != nth[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row))[: len(first)] - 1
        values = [nth[first], nth[last] + 1, start[first], end[last]]
        at = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=self.n_rows))])
        done = 0
        for batch, n_words in self.rows:
            cut = at[done : done + batch.num_rows + 1]
            spans = pa.StructArray.from_arrays([pa.array(x[cut[0] : cut[-1]].astype(np.int64)) for x in values], SPAN)
            spans = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), spans)
            items = pa.array([sorted(owned.get(r, ())) for r in range(done, done + batch.num_rows)], pa.list_(pa.string()))
            done += batch.num_rows
            if "hit_spans" in batch.schema.names:
                spans = pa.array([_union(a, b) for a, b in zip(batch.column("hit_spans").to_pylist(), spans.to_pylist(), strict=True)], spans.type)
                items = pa.array([sorted({*a, *b}) for a, b in zip(batch.column("hit_items").to_pylist(), items.to_pylist(), strict=True)], items.type)
            hits = [sum(s["word_end"] - s["word"] for s in x) for x in spans.to_pylist()]
            told = {"n_words": pa.array(n_words.astype(np.int64)), "n_hit": pa.array(hits, pa.int64()), "hit_spans": spans, "hit_items": items}
            yield pa.record_batch([told[n] if n in told else batch.column(n) for n in self.names], self.names)

    def _search(self, symbols: np.ndarray, ends: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Which kept words lie in an occurrence of a window, and which rows hold which windows."""
        if not len(symbols):
            return np.zeros(0, bool), []
        place = np.arange(len(symbols)) + np.cumsum(ends) - ends  # in the text with sentinels
        text, rows = np.zeros(len(symbols) + int(ends.sum()), np.int64), np.zeros(len(symbols) + int(ends.sum()), np.int64)
        text[place], rows[place] = symbols, row
        index = FMIndex(text, len(self.block.names))
        low, high = index.ranges(self.block.windows, self.block.lengths)
        change, pairs = np.zeros(len(text) + 1, np.int64), [np.zeros(0, np.int64)]
        for window, at in index.locate(low, high):
            change += np.bincount(at, minlength=len(change)) - np.bincount(at + self.block.lengths[window], minlength=len(change))
            pairs.append(np.unique(rows[at] * len(low) + window))
        pairs = np.unique(np.concatenate(pairs))
        return (np.cumsum(change[:-1]) > 0)[place], list(zip((pairs // len(low)).tolist(), (pairs % len(low)).tolist(), strict=True))


def _union(old: list[dict], new: list[dict]) -> list[dict]:
    """The union of two lists of spans; those whose words overlap or follow each other become one."""
    out: list[dict] = []
    for s in sorted(old + new, key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["word_end"]:
            out[-1] |= {c: max(out[-1][c], s[c]) for c in ("word_end", "end")}
        else:
            out.append(dict(s))
    return out


def _marks(block, names: list[str], most_words: int, most_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(block.value, names)
        for batch in chunks(batches, "text"):
            shard.add(batch)
            if shard.n_words >= most_words or shard.n_rows >= most_rows:
                yield from shard.found()
                shard = _Shard(block.value, names)
        if shard.rows:
            yield from shard.found()

    return run


def find_passages(docs: DataFrame, items: DataFrame, columns: list[str] | None = None, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs (or the named columns of it) with n_words, n_hit, hit_spans and hit_items.

    hit_spans: maximal runs of hit words in order, as numbers of words [word, word_end) and as characters [start, end) of the text. hit_items: sorted ids of items
    with a window in the document.
    """
    kept = [c for c in (docs.columns if columns is None else columns) if c not in FOUND]
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    pieces, blocks = item_blocks(items, window, block_words)
    if not blocks:
        lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        words = F.coalesce(F.regexp_count(lower, F.lit(PATTERN)), F.lit(0)).cast("long")
        return docs.select(*kept, words.alias("n_words"), F.lit(0).cast("long").alias("n_hit"), *[F.array().cast(FOUND[c]).alias(c) for c in ("hit_spans", "hit_items")])
    out = docs.select(*dict.fromkeys([*kept, "text"]))
    for k in range(blocks):
        names = [*(kept if k == blocks - 1 else out.columns), *FOUND]
        names = list(dict.fromkeys(names))
        block = load_block(pieces, k, window)
        if not len(block.lengths):
            continue
        schema = ", ".join(f"`{n}` {FOUND.get(n) or types[n]}" for n in names)
        out = out.mapInArrow(_marks(docs.sparkSession.sparkContext.broadcast(block), names, SHARD_WORDS, SHARD_ROWS), schema)
    return out.select(*kept, *FOUND)


def remove_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs with the hit spans cut from their texts; clean documents keep theirs as it is."""
    found = find_passages(docs, items)
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("hit_spans.end"))
    ends = F.concat(F.col("hit_spans.start"), F.array(F.length("text").cast("long")))
    left = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), a.cast("int") + 1, (b - a).cast("int"))), "")
    return found.withColumn("text", F.when(F.col("n_hit") > 0, left).otherwise(F.col("text"))).select(*docs.columns)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    ids = F.sha2(F.array_join("hit_items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
