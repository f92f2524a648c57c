"""External induced suffix sorting of a shard, with common-prefix values.

A shard is a byte string of UTF-8 pieces, each ended by the sentinel. The suffixes that start at a
local minimum (LMS) are sorted first: their substrings are named and the names' ranks doubled until
they reach DEPTH bytes. From them all descending (L) suffixes are induced in one scan upwards
and from these all ascending (S) suffixes in one scan downwards. The scans take suffix tuples
(position, common prefix with the tuple before) from queues of one priority per first byte,
which spill to files beyond a limit of memory; a tuple's common prefix is one more than
the least one between the two tuples that induced it and its neighbour. Large arrays live in mapped files.
Order and common prefixes are exact up to DEPTH bytes, which is all that matches of fewer bytes need.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

DEPTH = 56
BATCH = 1 << 18
NONE = np.uint8(255)


def mapped(folder: str, name: str, n: int, kind, limit: int) -> np.ndarray:
    """Zeros, in a mapped file if they take more than limit bytes."""
    if n * np.dtype(kind).itemsize <= limit:
        return np.zeros(n, kind)
    return np.memmap(os.path.join(folder, name), kind, "w+", shape=(n,))


class SuffixQueues:
    """First-in first-out queues of (position, common prefix), one for each first byte; the longest go to disk beyond `limit` bytes."""

    def __init__(self, folder: str, name: str, limit: int):
        self.folder, self.name, self.limit, self.size = folder, name, limit, 0
        self.held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(256)]
        self.files: list[list[str]] = [[] for _ in range(256)]
        self.made = 0

    def push(self, byte: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.held[byte].append((pos, lcp))
        self.size += len(pos)
        if self.size * 9 > self.limit:
            self.spill()

    def spill(self) -> None:
        for byte, parts in enumerate(self.held):
            if sum(len(p) for p, _ in parts) * 512 > self.size:
                path = os.path.join(self.folder, f"{self.name}-{self.made}.npz")
                np.savez(path, pos=np.concatenate([p for p, _ in parts]), lcp=np.concatenate([c for _, c in parts]))
                self.made += 1
                self.files[byte].append(path)
                self.size -= sum(len(p) for p, _ in parts)
                self.held[byte] = []

    def drain(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches in order, until the queue is empty; what is pushed meanwhile comes too."""
        while self.files[byte] or self.held[byte]:
            if self.files[byte]:
                path = self.files[byte].pop(0)
                with np.load(path) as f:
                    parts = [(f["pos"], f["lcp"])]
                os.unlink(path)
            else:
                parts, self.held[byte] = self.held[byte], []
                self.size -= sum(len(p) for p, _ in parts)
            pos, lcp = (np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*parts, strict=True))
            for at in range(0, len(pos), BATCH):
                yield pos[at : at + BATCH], lcp[at : at + BATCH]


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low..high] for many ranges, none of them empty; by a table of powers of two."""
    if not len(low):
        return np.zeros(0, np.uint8)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = np.empty((int(level.max()) + 1, len(values)), np.uint8)
    table[0] = values
    for k in range(1, len(table)):
        width = 1 << (k - 1)
        np.minimum(table[k - 1, : len(values) - width], table[k - 1, width:], out=table[k, : len(values) - width])
    table, at = table.ravel(), level * len(values)
    return np.minimum(table[at + low], table[at + high - (1 << level) + 1])


class _Ranks:
    """Ranks of items that keys refine step by step: an item's rank is the number of items before its group of equals."""

    def __init__(self, n: int):
        self.rank = np.zeros(n, np.int64)

    def tied(self, open_items: np.ndarray) -> np.ndarray:
        """The items of groups of several that hold an open item."""
        n = len(self.rank)
        some = np.zeros(n, bool)
        some[self.rank[open_items]] = True
        return np.flatnonzero((some & (np.bincount(self.rank, minlength=n) > 1))[self.rank]) if n else np.zeros(0, np.int64)

    def refine(self, items: np.ndarray, key: np.ndarray) -> None:
        """Order the items of whole groups by key inside their group."""
        if not len(items):
            return
        rank = self.rank[items]
        order = np.argsort(key)
        order = order[np.argsort(rank[order], kind="stable")] if rank.any() else order
        rank, key = rank[order], key[order]
        group = np.concatenate([[True], rank[1:] != rank[:-1]])
        new = group | np.concatenate([[True], key[1:] != key[:-1]])
        place = np.arange(len(rank))
        first = np.maximum.accumulate(np.where(group, place, 0))
        self.rank[items[order]] = rank + np.maximum.accumulate(np.where(new, place, 0)) - first


class Shard:
    """The text of a shard: bytes + 1 (valid UTF-8 stays below 0xF9), 0 as sentinel and padding."""

    def __init__(self, text: np.ndarray, folder: str, limit: int):
        self.n, self.folder, self.limit = len(text), folder, limit
        self.t = mapped(folder, "text", self.n + DEPTH + 16, np.uint8, limit)
        self.t[: self.n] = text
        rises = np.zeros(self.n, bool)
        different = np.flatnonzero(self.t[: self.n - 1] != self.t[1 : self.n])
        up = self.t[different] < self.t[different + 1]
        rises[: self.n - 1] = np.repeat(up, np.diff(np.concatenate([[-1], different])))[: self.n - 1] if len(different) else False
        rises[-1] = True
        self.rises = rises
        self.words = mapped(folder, "words", self.n + DEPTH + 8, np.uint64, limit)
        for r in range(8):
            m = (len(self.t) - r) // 8
            part = self.t[r : r + 8 * m].view(">u8")
            self.words[r::8] = part[: len(self.words[r::8])]

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The common prefix of suffixes p and q, up to DEPTH."""
        out, live = np.zeros(len(p), np.uint8), np.arange(len(p))
        for at in range(0, DEPTH, 8):
            a, b = self.words[np.minimum(p[live] + at, self.n + DEPTH)], self.words[np.minimum(q[live] + at, self.n + DEPTH)]
            x = a ^ b
            lead = np.zeros(len(live), np.uint8)
            for k in range(8):
                lead += x < np.uint64(1 << (8 * k)) if k else x == 0
            out[live] += lead
            live = live[x == 0]
        return out

    def minima(self) -> tuple[np.ndarray, np.ndarray]:
        """The LMS suffixes in order, with common prefixes."""
        pos = np.flatnonzero(self.rises[1:] & ~self.rises[:-1]) + 1
        ends = np.append(pos[1:], self.n - 1)
        size = np.minimum(ends - pos + 1, DEPTH)
        size[-1:] = DEPTH  # the last sentinel, followed by padding, is the least suffix
        ranks = _Ranks(len(pos))
        for at in range(0, int(size.max(initial=1)), 8):  # names: later words split only what earlier words left equal
            live = ranks.tied(size > at)
            left = np.clip(size[live] - at, 0, 8).astype(np.uint64)
            pad = np.where(left == 0, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(np.uint64(8) * (np.uint64(8) - left), np.uint64(63))) - np.uint64(1))
            ranks.refine(live, self.words[np.minimum(pos[live] + at, self.n + DEPTH)] | pad)
        step = 1
        while step < DEPTH // 2 + 1 and step < len(pos):
            reach = np.full(len(pos), DEPTH)
            reach[:-step] = pos[step:] - pos[:-step]
            live = ranks.tied(reach < DEPTH)
            if not len(live):
                break
            after = np.zeros(len(live), np.uint64)
            inside = live < len(pos) - step
            after[inside] = (ranks.rank[live[inside] + step] + 1).astype(np.uint64)
            ranks.refine(live, after)
            step *= 2
        at = pos[np.argsort(ranks.rank, kind="stable")]
        lcp = np.zeros(len(at), np.uint8)
        lcp[1:] = self.common(at[:-1], at[1:])
        return at, lcp


class _Scan:
    """One direction of induction: hands each scanned batch's predecessors of one type to the queues."""

    def __init__(self, shard: Shard, rising: bool, queues: SuffixQueues):
        self.shard, self.rising, self.queues = shard, rising, queues
        self.since = np.full(256, NONE)  # the least common prefix since a byte was last handed on
        self.started = np.zeros(256, bool)
        self.last, self.byte = -1, -1

    def seam(self, byte: int, first: int, given: int | None) -> int:
        """The common prefix of a batch's first suffix with the one scanned before."""
        if byte != self.byte:
            return 0
        return int(given) if given is not None else int(self.shard.common(np.array([self.last]), np.array([first]))[0])

    def take(self, byte: int, pos: np.ndarray, lcp: np.ndarray, joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scan a batch of suffixes that start with byte; joined: lcp[0] refers to the suffix scanned before."""
        lcp = lcp.copy()
        lcp[0] = self.seam(byte, int(pos[0]), int(lcp[0]) if joined else None)
        self.last, self.byte = int(pos[-1]), byte
        before = pos - 1
        picked = np.flatnonzero((before >= 0) & (self.shard.rises[before] == self.rising))
        heads = self.shard.t[before[picked]]
        order = np.argsort(heads, kind="stable")
        heads, picked = heads[order], picked[order]
        cut = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]])) if len(heads) else np.zeros(0, np.int64)
        low = np.zeros(len(picked), np.int64)
        low[1:] = picked[:-1] + 1
        low[cut] = 0
        least = _range_least(lcp, low, picked)
        firsts = heads[cut]
        least[cut] = np.minimum(least[cut], self.since[firsts])
        new = np.minimum(least, DEPTH - 1).astype(np.uint8) + np.uint8(1)
        new[cut] = np.where(self.started[firsts], new[cut], 0)
        self.since = np.minimum(self.since, lcp.min())
        if len(cut):
            ends = np.append(cut[1:], len(picked))
            after = picked[ends - 1] + 1
            rest = np.append(np.minimum.accumulate(lcp[::-1])[::-1], NONE)
            self.since[firsts] = rest[after]
            self.started[firsts] = True
            found = before[picked]
            for h, a, b in zip(firsts.tolist(), cut.tolist(), ends.tolist(), strict=True):
                self.queues.push(h, found[a:b], new[a:b])
        return pos, lcp


def suffix_order(text: np.ndarray, folder: str, limit: int = 256 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order as batches (positions, common prefix with the suffix before). text: uint8 as in Shard, last value 0."""
    shard = Shard(text, folder, limit)
    minima, minima_lcp = shard.minima()
    starts = np.searchsorted(shard.t[minima], np.arange(257))
    rising, falling, done = (SuffixQueues(folder, name, limit) for name in ("rising", "falling", "done"))
    scan = _Scan(shard, False, falling)
    for byte in range(256):
        joined = False
        for pos, lcp in falling.drain(byte):
            done.push(byte, *scan.take(byte, pos, lcp, joined))
            joined = True
        for at in range(starts[byte], starts[byte + 1], BATCH):
            end = min(at + BATCH, starts[byte + 1])
            scan.take(byte, minima[at:end], minima_lcp[at:end], at > starts[byte])
    scan = _Scan(shard, True, rising)
    for byte in range(255, -1, -1):
        joined = False
        for pos, lcp in rising.drain(byte):
            yield scan.take(byte, pos, lcp, joined)
            joined = True
        parts = list(done.drain(byte))
        after = None
        for k in range(len(parts) - 1, -1, -1):
            pos, lcp = parts[k]
            back = np.empty_like(lcp)
            back[1:] = lcp[:0:-1]
            back[0] = 0 if after is None else after
            yield scan.take(byte, pos[::-1], back, after is not None)
            after = lcp[0]
