"""Document fingerprints from prefix polynomial hashes.

A text's prefix arrays G[i] = sum of (c_j + 1) * B**j for j < i, modulo 2**31 - 1 and for two bases,
give the hash of any span in constant time: (G[b] - G[a]) * B**-a. They decide whether two spans are
equal and find the longest common extension of two positions by binary search. The fingerprint
holds the hash of the whole text and, for 64 classes of span hashes, the least span of SPAN code
points, so that the share of classes on which two fingerprints agree estimates how many spans the texts share.

Defined cases: a null text is the empty text; texts shorter than SPAN are one span; rows that repeat
a doc_id follow each other in the order of their texts' hashes, and so do rows without one, which come last; a
single document follows itself; an empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import table

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN, CLASSES = 16, 64
EMPTY_CLASS = 0xFFFF
BUCKET_BYTES, BUCKET_ROWS = 12 << 20, 20_000
MOST_BUCKETS = 20_000


def _reduce(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2**62: the prime is a power of two less one, so folding the high bits is enough."""
    p = np.uint64(PRIME)
    x = (x & p) + (x >> np.uint64(31))
    x = (x & p) + (x >> np.uint64(31))
    return np.where(x >= p, x - p, x)


class _Powers:
    """Powers of a base and of its inverse, doubled on demand."""

    def __init__(self, base: int):
        self.steps = [base, pow(base, -1, PRIME)]
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def get(self, n: int, inverse: bool = False) -> np.ndarray:
        held = self.tables[inverse]
        while len(held) < n:
            held = np.concatenate([held, _reduce(held * np.uint64(pow(self.steps[inverse], len(held), PRIME)))])
        self.tables[inverse] = held
        return held[:n]


_powers = tuple(_Powers(b) for b in BASES)


class PrefixHashes:
    """The prefix arrays of a text's code points."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.prefix = []
        for powers in _powers:
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_reduce(codes * powers.get(self.n)), out=sums[1:])
            self.prefix.append(_reduce(sums))

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """The hash of code points start .. end - 1, equal for equal spans wherever they stand."""
        return tuple((int(g[end]) - int(g[start])) * int(p.get(self.n + 1, True)[start]) % PRIME for g, p in zip(self.prefix, _powers, strict=True))

    def all_spans(self, width: int) -> np.ndarray:
        """The hashes, by the first base, of every span of a width."""
        g, n = self.prefix[0], self.n - width + 1
        return _reduce(_reduce(g[width:] + np.uint64(PRIME) - g[:n]) * _powers[0].get(n, True))


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How far a from i and b from j agree, by binary search over span hashes."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def fingerprint(hashes: PrefixHashes) -> str:
    """Length, hash of the whole text and the span sketch, in hex."""
    whole = hashes.span(0, hashes.n)
    spans = hashes.all_spans(min(SPAN, hashes.n)).astype(np.uint32) if hashes.n else np.zeros(0, np.uint32)
    mixed = (spans ^ (spans >> np.uint32(15))) * np.uint32(0x9E3779B1)
    mixed = np.sort((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x85EBCA77))
    starts = np.arange(CLASSES, dtype=np.uint64) << np.uint64(32 - CLASSES.bit_length() + 1)
    at = np.searchsorted(mixed, starts.astype(np.uint32))
    ends = np.append(at[1:], len(mixed))
    least = mixed[np.minimum(at, max(0, len(mixed) - 1))] if len(mixed) else np.zeros(CLASSES, np.uint32)
    kept = np.minimum(((least * np.uint32(0xC2B2AE3D)) >> np.uint32(16)), EMPTY_CLASS - 1)
    sketch = np.where(at < ends, kept, EMPTY_CLASS).astype(">u2")
    return f"{hashes.n:x}:{whole[0]:08x}{whole[1]:08x}:{sketch.tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """The estimated share of common spans (twice the common over the sum of both), 1 for fingerprints of equal texts."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rpartition(":")[2]), ">u2") for f in (a, b))
    seen = (x != EMPTY_CLASS) | (y != EMPTY_CLASS)
    jaccard = float(((x == y) & seen).sum() / max(1, seen.sum()))
    return 2 * jaccard / (1 + jaccard)


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as much of the start of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


class Slots:
    """Ranges of doc_id in ascending order, numbered from 0; an id that fills several ranges has slots of its own by text hash, as have rows without an id, below 0."""

    def __init__(self, bounds: list[float], null_slots: int):
        self.bounds, times = np.unique(np.asarray(bounds, np.int64), return_counts=True)
        self.own, self.null_slots = np.where(times > 1, times, 0), null_slots
        self.before = np.concatenate([[0], np.cumsum(self.own)])
        self.many = len(self.bounds) + 1 + int(self.before[-1])

    def of(self, ids: pd.Series, hashes: pd.Series) -> np.ndarray:
        """Less hashes come first in the descending order, so they lie in higher slots."""
        share = (hashes.to_numpy(np.int64) / 2.0**64 + 0.5).clip(0, 1 - 2.0**-50)
        known = ids.fillna(0).to_numpy(np.int64)
        k = np.searchsorted(self.bounds, known, side="right")
        slot = k + self.before[k]
        if self.own.any():
            at = np.maximum(k - 1, 0)
            own = np.where((k > 0) & (self.bounds[at] == known), self.own[at], 0)
            slot = np.where(own > 0, k + self.before[at] + own - 1 - np.floor(share * own).astype(np.int64), slot)
        return np.where(ids.isna(), -1 - np.floor(share * self.null_slots).astype(np.int64), slot)


def in_order(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as runs of descending doc_id, each row with the run's bucket; a run ends with the first row of the next one as `guest`.

    Buckets are ranges of doc_id between approximate quantiles, a partition each, and at most MOST_BUCKETS, so that the driver's table of them
    does not grow with the corpus (larger ones are streamed and their sort spills); the text is shuffled once.
    """
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"), F.count("doc_id").alias("known")).first()
    many = min(MOST_BUCKETS, max(1, -(-(size["b"] or 0) // BUCKET_BYTES), -(-size["n"] // BUCKET_ROWS)))
    null_slots = max(1, round(many * (size["n"] - size["known"]) / max(1, size["n"])))
    ranges = max(1, many - null_slots) if size["known"] else 1
    slots = Slots(docs.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else [], null_slots)

    @F.pandas_udf("long")
    def bucket(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(slots.of(ids, hashes))

    text = F.coalesce("text", F.lit(""))
    h = F.xxhash64(text)
    held = docs.select(bucket(F.col("doc_id"), h).alias("bucket"), F.lit(False).alias("guest"), "doc_id", text.alias("text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.bitwise_not("doc_id"), "doc_id", "h"))  # descending doc_id, ascending hash
    leads = docs.select("doc_id", h.alias("h")).groupBy(bucket("doc_id", "h").alias("bucket")).agg(first.alias("lead")).orderBy("bucket").collect()
    led = [(leads[(i + 1) % len(leads)]["bucket"], r["lead"]["doc_id"], r["lead"]["h"]) for i, r in enumerate(leads)]
    tops = docs.sparkSession.createDataFrame(led, "to long, top long, top_h long")  # at most MOST_BUCKETS rows of 24 bytes
    guests = docs.join(F.broadcast(tops), docs["doc_id"].eqNullSafe(tops["top"]) & (h == tops["top_h"])).select(F.col("to").alias("bucket"), F.lit(True).alias("guest"), "doc_id", text.alias("text"))
    place = (F.col("bucket") + slots.null_slots).cast("int")
    return held.unionByName(guests).repartitionById(slots.many + slots.null_slots, place).sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and the likeness to the edited and to the following text."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "shared_edited", "shared_next"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, run, closed = None, None, False
        for batch in batches:
            rows = []
            for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != run:
                    last, run, closed = None, bucket, False
                if closed:
                    continue
                hashes = PrefixHashes(text)
                now = (doc_id, text, hashes, fingerprint(hashes))
                if last:
                    rows.append(compare(last, now))
                last, closed = now, guest
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def compare(this: tuple, following: tuple) -> tuple:
        doc_id, text, hashes, print_ = this
        changed = edited(text, following[1])
        other = PrefixHashes(changed)
        other_print = fingerprint(other)
        return (
            doc_id, hashes.n, hashlib.sha256(changed.encode()).hexdigest(), print_, other_print, likeness(print_, other_print), likeness(print_, following[3]),
            common_extension(hashes, 0, other, 0), common_extension(hashes, 0, following[2], 0),
        )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_edited long, shared_next long"
    return in_order(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInArrow(walk, schema)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
