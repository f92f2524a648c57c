"""Suffix-array deduplication: remove the bytes of strings that an earlier document already has.

Every string of WINDOW bytes that also starts in a document with a smaller doc_id is removed from
the later ones. Documents are dealt to groups by a hash of the row, the text is shuffled once, and
all later steps meet it there:

1. Each window is keyed by the least hash among its KEY-byte strings, so that equal windows have equal keys
   wherever they stand; neighbouring windows with one key form a run. Groups report their
   keys, and keys that only one document has are out.
2. Runs with a shared key go, with their bytes, to the shard of the key. A group sends
   equal runs once, on behalf of the smallest doc_id, so that thousands of copies of
   a passage reach a shard at most once per group. Runs of a key that HOT_RUNS documents or more have are cut
   in pieces first, each keyed by all the bytes that its windows share, so that no key fills a shard.
3. A shard is suffix sorted by external induction (suffixes.py); suffixes that share WINDOW bytes
   form classes and windows of all but the smallest doc_id of a class are marked. Bytes, sorted
   suffixes and classes beyond the memory limit lie in files of the task's own folder, gone with the task.
4. Marks return to the groups as places of their texts, which remove the covered bytes.

Keys are 48 bits and only choose candidates; what is removed is decided on the bytes: equal runs of a group or a
shard are found by hashes and then compared byte by byte.

Defined cases: a null text is empty; rows that repeat a doc_id are judged each and do not remove from each other;
a null doc_id counts as larger than all others; an empty table gives an empty table;
other columns are ignored, only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import table, utf8
from framewright.llm.suffixes import mapped, suffix_order

WINDOW, KEY = 50, 16
GROUP_BYTES, PART_BYTES = 8 << 20, 1 << 20
SHARDS_PER_GROUP = 4
HOT_RUNS, MANY, PIECE = 2048, 16, 5
LARGEST = np.iinfo(np.int64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _words(joined: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes that start at each place, as numbers."""
    held = np.zeros(len(joined) + pad + 8, np.uint8)
    held[: len(joined)] = joined
    out = np.zeros(len(joined) + pad, np.uint64)
    for r in range(8):
        part = held[r : r + (len(held) - r) // 8 * 8].view("<u8")
        out[r::8] = part[: len(out[r::8])]
    return out


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first .. first + size - 1 of each range, one after another."""
    total = int(size.sum())
    out = np.arange(total, dtype=np.int64 if total >= 1 << 31 or len(first) and first.max() + size.max() >= 1 << 31 else np.int32)
    out += np.repeat(first - (np.cumsum(size) - size), size).astype(out.dtype)
    return out


def _blocks(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of items of about PART_BYTES together."""
    ends, at = np.cumsum(size), 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_BYTES, side="right")))
        yield at, end
        at = end


@dataclass
class Runs:
    """The runs of a group's documents, which are in order of doc_id: first window, windows, key, document's place."""

    joined: np.ndarray
    edges: np.ndarray
    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    doc: np.ndarray

    def taken(self, which: np.ndarray) -> Runs:
        return Runs(self.joined, self.edges, self.start[which], self.count[which], self.key[which], self.doc[which])


def _string_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hashes of the n strings of KEY bytes."""
    return _mix(_mix(words[:n] * np.uint64(0x9E3779B97F4A7C15)) + words[KEY - 8 : n + KEY - 8])


def runs_of(raws: list[bytes]) -> Runs:
    edges = np.concatenate([[0], np.cumsum([len(r) for r in raws], dtype=np.int64)])
    joined = np.frombuffer(b"".join(raws), np.uint8)
    kept: list[list[np.ndarray]] = [[], [], [], []]
    for at, end in _blocks(np.diff(edges)):  # parts of whole documents, small enough for the processor's cache
        low, high = int(edges[at]), int(edges[end])
        part = joined[low:high]
        if len(part) >= WINDOW:
            span, width = _string_hashes(_words(part, 0), len(part) - KEY + 1), 1
            while 2 * width <= WINDOW - KEY + 1:
                span, width = np.minimum(span[:-width], span[width:]), 2 * width
            rest = WINDOW - KEY + 1 - width
            key = np.minimum(span[: len(span) - rest], span[rest:]) if rest else span
            valid = np.ones(len(key) + 1, bool)
            cut = (edges[at + 1 : end] - low)[:, None] - np.arange(WINDOW - 1, 0, -1)[None, :]
            # documents shorter than a window: their places before the cut may lie in an earlier one, which ends there anyway
            valid[cut[(cut >= 0) & (cut < len(key))]] = False
            valid[-1] = False
            first = valid[:-1].copy()
            first[1:] &= ~valid[:-2] | (key[1:] != key[:-1])
            last = valid[:-1].copy()
            last[:-1] &= ~valid[1:-1] | (key[1:] != key[:-1])
            start = np.flatnonzero(first)
            count = np.flatnonzero(last) - start + 1
            for held, found in zip(kept, (start + low, count, key[start] >> np.uint64(16), np.searchsorted(edges, start + low, side="right") - 1), strict=True):
                held.append(found)
    start, count, key, doc = (np.concatenate(k) if k else np.zeros(0, np.int64) for k in kept)
    return Runs(joined, edges, start, count, key.astype(np.uint64), doc)


def cut_hot(runs: Runs, hot: np.ndarray) -> Runs:
    """runs with those of a hot key cut in pieces of at most PIECE windows, keyed by the WINDOW - PIECE + 1 bytes that all windows of a piece share.

    Pieces depend on where the first string of least hash stands in the window, so that equal windows have equal keys again.
    """
    held = np.isin(runs.key, hot)
    if not held.any():
        return runs
    out = [[x[~held]] for x in (runs.start, runs.count, runs.key, runs.doc)]
    heavy = runs.taken(held)
    for a, b in _blocks(heavy.count * 16):
        start, count = heavy.start[a:b], heavy.count[a:b]
        size = count + WINDOW - 1
        begin = np.cumsum(size) - size
        words = _words(runs.joined[_spread(start, size)], WINDOW)
        at = _spread(begin, count).astype(np.int64)
        h = _string_hashes(words, len(words) - KEY)
        offset = np.argmin(h[at[:, None] + np.arange(WINDOW - KEY + 1)], axis=1)
        piece = offset - offset % PIECE
        own = at + offset - piece  # where the shared bytes begin
        key = _mix(words[own])
        width = WINDOW - PIECE + 1
        for k in [*range(8, width - 8, 8), width - 8]:
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + words[own + k])
        run = np.repeat(np.arange(len(start)), count)
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (run[1:] != run[:-1])]))
        for held_, found in zip(out, (start[run[first]] + at[first] - begin[run[first]], np.diff(np.append(first, len(key))), key[first] >> np.uint64(16), heavy.doc[a:b][run[first]]), strict=True):
            held_.append(found)
    start, count, key, doc = map(np.concatenate, out)
    order = np.argsort(start, kind="stable")
    return Runs(runs.joined, runs.edges, start[order], count[order], key[order], doc[order])


def _content(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range."""
    out = _mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for a, b in _blocks(size):
        here = size[a:b]
        words, begin = _words(data[_spread(at[a:b], here)], 8), np.cumsum(here) - here
        live, place = np.arange(b - a), 0
        while len(live):
            own = begin[live] + np.minimum(place, here[live] - 8)
            out[a + live] = _mix(out[a + live] * np.uint64(0x9E3779B97F4A7C15) + words[own])
            place += 8
            live = live[here[live] > place]
    return out


def _leaders(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each range the first one with the same bytes; ranges that only their hash makes equal lead themselves."""
    _, first, inverse = np.unique(_content(data, at, size), return_index=True, return_inverse=True)
    lead = first[inverse]
    follow = np.flatnonzero(lead != np.arange(len(lead)))
    other = np.flatnonzero(size[follow] != size[lead[follow]])
    lead[follow[other]] = follow[other]
    follow = np.delete(follow, other)
    for a, b in _blocks(size[follow]):
        here = follow[a:b]
        differs = data[_spread(at[here], size[here])] != data[_spread(at[lead[here]], size[here])]
        wrong = here[np.logical_or.reduceat(differs, np.cumsum(size[here]) - size[here])]
        lead[wrong] = wrong
    return lead


def _group(rows: pa.Table) -> tuple[list[int | None], np.ndarray, list[bytes]]:
    """A group's doc_ids, the same with null as the largest number, and bytes, in the order of (doc_id, bytes)."""
    pairs = sorted(zip(rows.column("doc_id").to_pylist(), rows.column("raw").to_pylist(), strict=True), key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    return [i for i, _ in pairs], np.asarray([LARGEST if i is None else i for i, _ in pairs], np.int64), [r for _, r in pairs]


def _pack48(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def group_keys(parts: int):
    def report(rows: pa.Table) -> pa.Table:
        """The distinct keys of a group, dealt to parts: those of one document, of several and of MANY (with their number) apart."""
        _, ids, raws = _group(rows)
        runs = runs_of(raws)
        order = np.argsort(runs.key, kind="stable")
        keys, docs = runs.key[order], ids[runs.doc[order]]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        turns = np.concatenate([[0], docs[1:] != docs[:-1]]) if len(keys) else np.zeros(0, np.int64)
        turns[first] = 1
        times = np.add.reduceat(turns, first) if len(keys) else turns
        keys = keys[first]
        part = (_mix(keys) % np.uint64(parts)).astype(np.int64)
        out, g = [], rows.column("g")[0].as_py()
        for p in np.unique(part).tolist():
            k, n = keys[part == p], times[part == p]
            out.append((p, g, _pack48(k[n == 1]), _pack48(k[(n > 1) & (n < MANY)]), _pack48(k[n >= MANY]), n[n >= MANY].astype("<i4").tobytes()))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "g", "single", "several", "many", "times"])

    return report


def shared_keys(hot_runs: int):
    def choose(rows: pa.Table) -> pa.Table:
        """The keys of a part that several documents have, and those of them that are hot, for each group that has them."""
        groups, held = rows.column("g").to_pylist(), []
        for least, name in ((1, "single"), (2, "several"), (MANY, "many")):
            found = [_unpack48(b) for b in rows.column(name).to_pylist()]
            owner = np.repeat(np.arange(len(groups)), [len(k) for k in found])
            held.append((np.concatenate(found), owner, np.full(len(owner), least)))
        times = np.concatenate([np.frombuffer(b, "<i4") for b in rows.column("times").to_pylist()])
        held[-1] = (*held[-1][:2], times)
        keys, owner, n = map(np.concatenate, zip(*held, strict=True))
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, n)[inverse]
        keep = total > 1
        keys, owner, hot = keys[keep], owner[keep], total[keep] >= hot_runs
        out = [(g, _pack48(keys[owner == k]), _pack48(keys[hot & (owner == k)])) for k, g in enumerate(groups)]
        columns = list(zip(*[x for x in out if x[1]], strict=True)) or [[], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["g", "keys", "hot"])

    return choose


SENT = "shard long, g long, start binary, doc binary, count binary, followers binary, following binary, bytes binary"


def shared_runs(shards: int):
    def send(rows: pa.Table, flags: pa.Table) -> pa.Table:
        """A group's distinct runs with a shared key, dealt to shards by key, each with the places of the later runs equal to it."""
        names = [c.split()[0] for c in SENT.split(", ")]
        out: list[tuple] = []
        if rows.num_rows and flags.num_rows:
            _, ids, raws = _group(rows)
            runs = runs_of(raws)
            keys, hot = (np.unique(np.concatenate([_unpack48(b) for b in flags.column(c).to_pylist()])) for c in ("keys", "hot"))
            near = np.minimum(np.searchsorted(keys, runs.key), len(keys) - 1)
            runs = cut_hot(runs.taken(keys[near] == runs.key), hot)
            size = runs.count + WINDOW - 1
            lead = _leaders(runs.joined, runs.start, size)
            doc = ids[runs.doc]
            shard = (_mix(runs.key + np.uint64(1)) % np.uint64(shards)).astype(np.int64)
            follow = np.flatnonzero(lead != np.arange(len(lead)))
            follow = follow[np.argsort(lead[follow], kind="stable")]
            n_follow = np.bincount(lead[follow], minlength=len(lead))
            place = runs.start[follow] * 2 + (doc[follow] > doc[lead[follow]])  # the last bit: the run is a later document's
            begin = np.cumsum(n_follow) - n_follow
            own = np.flatnonzero(lead == np.arange(len(lead)))
            own = own[np.argsort(shard[own], kind="stable")]
            cut = np.flatnonzero(np.concatenate([[True], shard[own][1:] != shard[own][:-1]])) if len(own) else []
            for a, b in zip(cut, np.append(cut[1:], len(own)), strict=True):
                run = own[a:b]
                data = runs.joined[_spread(runs.start[run], size[run])]
                after = place[_spread(begin[run], n_follow[run])]
                numbers = [x.astype(k).tobytes() for x, k in ((runs.start[run], "<i8"), (doc[run], "<i8"), (runs.count[run], "<i4"), (n_follow[run], "<i4"), (after, "<i8"))]
                out.append((int(shard[run[0]]), rows.column("g")[0].as_py(), *numbers, data.tobytes()))
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 6)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return send


def _first_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The key of the first window of each run."""
    out = np.zeros(len(at), np.uint64)
    for a, b in _blocks(np.full(len(at), WINDOW)):
        words = _words(data[_spread(at[a:b], np.full(b - a, WINDOW))], 0)
        h = np.append(_string_hashes(words, len(words) - KEY + 1), np.zeros(KEY - 1, np.uint64))
        out[a:b] = h.reshape(-1, WINDOW)[:, : WINDOW - KEY + 1].min(axis=1)
    return out


def mark_windows(docs: np.ndarray, counts: np.ndarray, data: np.ndarray, folder: str, memory: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The marked windows of a shard's runs as ranges: run, first, end. Equal runs are sorted once, as the one of the smallest document."""
    size = counts + WINDOW - 1
    at = np.cumsum(size) - size
    order = np.argsort(docs, kind="stable")
    lead = np.empty(len(order), np.int64)
    lead[order] = order[_leaders(data, at[order], size[order])]
    own = np.flatnonzero(lead == np.arange(len(lead)))
    _, key, times = np.unique(_first_keys(data, at[own]), return_inverse=True, return_counts=True)
    own = own[times[key] > 1]  # a key with a single distinct run has no suffix to be compared with
    run, low, high = _mark_distinct(docs[own], counts[own], data, at[own], folder, memory)
    run = own[run]
    later = np.flatnonzero(docs > docs[lead])
    same = np.flatnonzero((docs == docs[lead]) & (lead != np.arange(len(lead))))
    order = np.argsort(run, kind="stable")
    run, low, high = run[order], low[order], high[order]
    first, end = np.searchsorted(run, lead[same]), np.searchsorted(run, lead[same], side="right")
    pick = _spread(first, end - first)
    return (
        np.concatenate([run, np.repeat(same, end - first), later]),
        np.concatenate([low, low[pick], np.zeros(len(later), np.int64)]), np.concatenate([high, high[pick], counts[later]]),
    )


class _Classes:
    """Marks the places of a class that do not belong to its smallest document; a class may span batches and, beyond `memory`, lies in files."""

    def __init__(self, marked: np.ndarray, folder: str, memory: int):
        self.marked, self.folder, self.memory = marked, folder, memory
        self.least, self.held, self.files, self.spilled = LARGEST, [], [], 0

    def close(self) -> None:
        for place, owner in [*self.held, *(np.load(f, mmap_mode="r") for f in self.files)]:
            self.marked[place[owner > self.least]] = True
        self.least, self.held, self.files = LARGEST, [], []

    def extend(self, place: np.ndarray, owner: np.ndarray) -> None:
        if len(place):
            self.least = min(self.least, int(owner.min()))
            self.held.append(np.stack([place, owner]))
            if sum(h.nbytes for h in self.held) > self.memory:
                self.files.append(f"{self.folder}/class-{self.spilled}.npy")
                self.spilled += 1
                np.save(self.files[-1], np.concatenate(self.held, axis=1))
                self.held = []

    def take(self, new: np.ndarray, place: np.ndarray, owner: np.ndarray) -> None:
        """The next places in order; new: whether a class begins there."""
        first = np.flatnonzero(new)
        if not len(first):
            return self.extend(place, owner)
        self.extend(place[: first[0]], owner[: first[0]])
        self.close()
        last = first[-1]
        if len(first) > 1:
            least = np.repeat(np.minimum.reduceat(owner[:last], first[:-1]), np.diff(first))
            self.marked[place[first[0] : last][owner[first[0] : last] > least]] = True
        return self.extend(place[last:], owner[last:])


def _mark_distinct(docs: np.ndarray, counts: np.ndarray, data: np.ndarray, at: np.ndarray, folder: str, memory: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix sort distinct runs; the windows that a run of a smaller document has too, as ranges: run, first, end."""
    if not len(docs):
        return (np.zeros(0, np.int64),) * 3
    size = counts + WINDOW - 1
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    text, window = mapped(folder, "runs", begin[-1], np.uint8, memory), mapped(folder, "windows", begin[-1], bool, memory)
    for a, b in _blocks(size):
        text[_spread(begin[a:b], size[a:b])] = data[_spread(at[a:b], size[a:b])] + np.uint8(1)
        window[_spread(begin[a:b], counts[a:b])] = True
    marked = mapped(folder, "marks", begin[-1], bool, memory)
    classes, opened = _Classes(marked, folder, memory), True
    for pos, lcp in suffix_order(text, folder, memory):
        number = np.cumsum(lcp < WINDOW)
        keep = np.flatnonzero(window[pos])
        number = number[keep]
        if len(keep):
            new = np.concatenate([[opened or number[0] > 0], number[1:] != number[:-1]])
            place = pos[keep]
            classes.take(new, place, docs[np.searchsorted(begin, place, side="right") - 1])
            opened = bool((lcp[keep[-1] + 1 :] < WINDOW).any())
        else:
            opened |= bool((lcp < WINDOW).any())
    classes.close()
    low, high = [], []
    for a, b in _blocks(np.diff(begin)):
        turns = np.diff(np.concatenate([[0], marked[begin[a] : begin[b]], [0]]).astype(np.int8))
        low.append(np.flatnonzero(turns > 0) + begin[a])
        high.append(np.flatnonzero(turns < 0) + begin[a])
    low, high = np.concatenate(low), np.concatenate(high)
    run = np.searchsorted(begin, low, side="right") - 1
    return run, low - begin[run], high - begin[run]


def solve_shard(memory: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Mark a shard's windows; for each group the places of their texts as ranges of windows."""
        with tempfile.TemporaryDirectory() as folder, tempfile.SpooledTemporaryFile(memory, dir=folder) as spool:
            groups, held = [], [[] for _ in range(5)]
            for batch in batches:
                groups += batch.column("g").to_pylist()
                for to, name, kind in zip(held, ("start", "doc", "count", "followers", "following"), ("<i8", "<i8", "<i4", "<i4", "<i8"), strict=True):
                    to += [np.frombuffer(b, kind) for b in batch.column(name).to_pylist()]
                for data in batch.column("bytes"):
                    spool.write(data.as_buffer())
            owner = np.repeat(np.arange(len(groups)), [len(r) for r in held[0]])
            start, doc, count, followers, following = map(np.concatenate, held)
            count = count.astype(np.int64)
            size = spool.tell()
            spool.flush()
            spool.seek(0)
            data = np.memmap(spool, np.uint8, "r", shape=(size,)) if size > memory else np.frombuffer(spool.read(), np.uint8)
            run, low, high = mark_windows(doc, count, data, folder, memory)
        later = following & 1 == 1
        lead = np.repeat(np.arange(len(count)), followers)
        same, place = lead[~later], following[~later] >> 1  # these follow the marks of their run
        order = np.argsort(run, kind="stable")
        first, end = np.searchsorted(run[order], same), np.searchsorted(run[order], same, side="right")
        pick = order[_spread(first, end - first)]
        of = np.concatenate([owner[run], owner[lead[later]], np.repeat(owner[same], end - first)])
        base = np.concatenate([start[run], following[later] >> 1, np.repeat(place, end - first)])
        low, high = np.concatenate([low, np.zeros(int(later.sum()), np.int64), low[pick]]), np.concatenate([high, count[lead[later]], high[pick]])
        order = np.argsort(of, kind="stable")
        marks, cut = np.stack([base + low, base + high], 1)[order], np.searchsorted(of[order], np.arange(len(groups) + 1))
        some = np.flatnonzero(cut[1:] > cut[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([groups[k] for k in some], pa.int64()), pa.array([marks[cut[k] : cut[k + 1]].astype("<i8").tobytes() for k in some], pa.binary())], names=["g", "marks"])

    return solve


def remove_marked(keep_bytes: bool):
    def remove(rows: pa.Table, marks: pa.Table) -> pa.Table:
        """Cover the marked windows and report what is left."""
        doc_ids, _, raws = _group(rows) if rows.num_rows else ([], None, [])
        joined = np.frombuffer(b"".join(raws), np.uint8)
        depth = np.zeros(len(joined) + 1, np.int32)
        for found in marks.column("marks").to_pylist():
            low, high = np.frombuffer(found, "<i8").reshape(-1, 2).T
            np.add.at(depth, low, 1)
            np.add.at(depth, high - 1 + WINDOW, -1)
        gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
        out, a = [], 0
        for doc_id, raw in zip(doc_ids, raws, strict=True):
            own = gone[a : a + len(raw)]
            n = int(np.count_nonzero(own))
            left = joined[a : a + len(raw)][~own].tobytes() if n else raw
            spans = int(own[0]) + int(np.count_nonzero(own[1:] & ~own[:-1])) if n else 0
            out.append((doc_id, len(raw), n, spans, hashlib.sha256(left).hexdigest(), *((left,) if keep_bytes else ())))
            a += len(raw)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + keep_bytes]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    return remove


def remove_repeats(docs: DataFrame, keep_bytes: bool = False, memory: int = 64 << 20, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs (and the kept bytes)."""
    size = docs.agg(F.sum(F.octet_length(F.col("text")))).first()[0] or 0
    many = max(4, -(-size // GROUP_BYTES))
    texts = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(many)).alias("g"), F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text").cast("string")).alias("raw"))
    keys = texts.groupBy("g").applyInArrow(group_keys(many), "part long, g long, single binary, several binary, many binary, times binary")
    flags = keys.groupBy("part").applyInArrow(shared_keys(hot_runs), "g long, keys binary, hot binary")
    runs = texts.groupBy("g").cogroup(flags.groupBy("g")).applyInArrow(shared_runs(SHARDS_PER_GROUP * many), SENT)
    marks = runs.groupBy("shard").applyInArrow(solve_shard(memory), "g long, marks binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_bytes else "")
    return texts.groupBy("g").cogroup(marks.groupBy("g")).applyInArrow(remove_marked(keep_bytes), schema)


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
