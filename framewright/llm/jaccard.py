"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Words are maximal runs of ASCII letters, digits and non-ASCII characters of the lower-cased text; a document
is its set of five-word shingles (all its words, if fewer), hashed to 64 bits. Documents with the same words in
the same order are one class and are joined once. Each class's representative has TREES labels of DEPTH minhash
values, one per prefix trie. A trie lies sorted by label, so that what shares a prefix stands together. A document starts with its whole
label and shortens the prefix until the chance that it meets a partner of the least similarity that its number of shingles
allows at the threshold (1 below four shingles, as all must agree) reaches TARGET_RECALL over all trees; documents under one
node of that depth are candidates. Of two documents the shorter prefix decides: a document also stands under the shorter prefixes of
the sizes that a partner may have (only below some twenty shingles do sizes differ in their prefix). Boilerplate also brings together what is not alike, so pairs under a node must agree on enough of
all TREES * DEPTH minhash values (six deviations below the threshold): an agreeing row keeps one edge to the least row it is connected to. Candidates' clusters are then
verified exactly on whole shingle sets, in blocks of at most about BLOCK rows; a block reports its rows' links and one edge a row to
the component it found, never its pairs. Nodes with many rows are compared in such blocks too.

Defined cases: null and empty texts have no words and link only to their copies; rows without a
doc_id are not compared (class_id null, n_links 0); rows that repeat a doc_id are one document, the
one whose text has the least hash; an empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from framewright.llm.common import materialize, table
from framewright.llm.components import components

WORDS, THRESHOLD = 5, Fraction(4, 5)
TREES, DEPTH, TARGET_RECALL = 24, 8, 0.9999
BLOCK, GROUP_BYTES, COLUMNS = 256, 400_000, 4096
BASE = 0x9E3779B97F4A7C15
WORD_BYTE = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def matching_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """The longest prefix at which a pair at the threshold still meets in some tree with the target probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


@cache
def least_similarity(n: int, threshold: Fraction = THRESHOLD) -> float:
    """The least similarity, at the threshold or above, that a set of n shingles can have to another set."""
    over, under = threshold.numerator, threshold.denominator
    out = Fraction(1)
    for m in range(-(-n * over // under), n * under // over + 1):
        common = -(-over * (n + m) // (over + under))
        if common <= min(n, m):
            out = min(out, Fraction(common, n + m - common))
    return float(out)


@cache
def depths(n: int, threshold: Fraction = THRESHOLD) -> list[int]:
    """The prefixes under which a set of n shingles stands: its own, and the shorter ones of sets that can be as like it as the threshold."""
    over, under = threshold.numerator, threshold.denominator
    own = matching_depth(least_similarity(n, threshold))
    sizes = range(max(1, -(-n * over // under)), n * under // over + 1)
    return sorted({own} | {d for d in (matching_depth(least_similarity(m, threshold)) for m in sizes) if d < own})


def agreement_bound(threshold: float = float(THRESHOLD), values: int = TREES * DEPTH) -> int:
    """How many minhash values a pair at the threshold shares at least, six deviations below the mean."""
    return int(values * threshold - 6 * (values * threshold * (1 - threshold)) ** 0.5)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    for i, base in enumerate((BASE, inverse)):
        while len(_powers[i]) < n:
            _powers[i] = np.concatenate([_powers[i], _powers[i] * np.uint64(pow(base, len(_powers[i]), 1 << 64))])
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_rows(texts: list[str], words: int = WORDS) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """For a group of texts: a digest of each one's word sequence, all shingle hashes, and each text's first shingle (with the end)."""
    raw = [t.lower().encode() for t in texts]
    joined = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    inside = np.concatenate([[False], WORD_BYTE[joined]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[0::2], turns[1::2]
    power, inverse = _power_table(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * power[: len(joined)], out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * inverse[starts])
    edges = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    first = np.searchsorted(starts, edges)
    digests = [hashlib.blake2b((hashes[a:b] if b > a else np.frombuffer(r, np.uint8)).tobytes(), digest_size=16, key=b"words" if b > a else b"none").digest() for a, b, r in zip(first[:-1], first[1:], raw, strict=True)]
    n = len(hashes)
    rolled = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        rolled += hashes[k : n - words + 1 + k] * np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
    rolled = _mix(rolled)
    parts, at = [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            parts.append(rolled[a : b - words + 1])
        elif b > a:
            parts.append(_mix(np.array([int(sum(int(h) * pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k, h in enumerate(hashes[a:b])) & ((1 << 64) - 1))], np.uint64)))
        at.append(at[-1] + (max(b - a - words + 1, 1) if b > a else 0))
    return digests, np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.asarray(at)


def _groups(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Rows whose last field is a text, in groups of about GROUP_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= GROUP_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def sketches(docs: DataFrame) -> DataFrame:
    """docs: doc_id, h, text. Returns doc_id, h, digest, depths, labels (TREES labels of DEPTH minhash values, null without shingles), bits (a byte of each value)."""
    rng = np.random.default_rng(5)
    factors = rng.integers(1 << 31, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    few = 128  # beyond, the number of shingles no longer decides the depth

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list] = [[] for _ in range(6)]
            for group in _groups(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                found, shingles, at = shingle_rows([t for *_, t in group])
                some = np.flatnonzero(at[1:] > at[:-1])
                mins = np.zeros((len(some), len(factors)), np.uint32)
                if len(some):
                    x = (shingles >> np.uint64(32)).astype(np.uint32)
                    for k, a in enumerate(factors):
                        mins[:, k] = np.minimum.reduceat(x * a, at[:-1][some])
                bits = ((mins ^ (mins >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                row = {i: k for k, i in enumerate(some.tolist())}
                for i, (doc_id, h, _) in enumerate(group):
                    n = int(at[i + 1] - at[i])
                    n = len(np.unique(shingles[at[i] : at[i + 1]])) if 0 < n <= few else few
                    values = (doc_id, h, found[i], depths(n), mins[row[i]].tobytes() if i in row else None, bits[row[i]].tobytes() if i in row else None)
                    for to, v in zip(held, values, strict=True):
                        to.append(v)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=["doc_id", "h", "digest", "depths", "labels", "bits"])

    return docs.mapInArrow(sketch, "doc_id long, h long, digest binary, depths array<int>, labels binary, bits binary")


def _clean(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _blocked(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """rows (rep, blocks and columns) copied to the pairs i <= j of blocks that their own block is in, so that all rows of `by` meet, at most two blocks at a time."""
    placed = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    return placed.select(*by, "rep", *columns, "block", F.explode(pairs).alias("p")).select(*by, F.col("p.i").alias("i"), F.col("p.j").alias("j"), "block", "rep", *columns)


def _connected(near: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """For each row the least rep of its component."""
    root, most = rep.copy(), np.iinfo(np.int64).max
    while True:
        least = np.minimum(root, np.where(near, root[None, :], most).min(axis=1, initial=most))
        if (least == root).all():
            return root
        root = least


def _apart(i: int, j: int, side: np.ndarray) -> np.ndarray:
    """Which pairs of a block are compared: all but a row with itself, or only those across its two halves."""
    return ~np.eye(len(side), dtype=bool) if i == j else side[:, None] != side[None, :]


def forest_edges(classes: DataFrame) -> DataFrame:
    """classes: rep, depths, labels, bits. Returns a, b: an edge from each row of a node to the least row of the node that it is connected to by agreeing pairs."""
    own = lambda t, width: F.substring("labels", F.lit(4 * DEPTH * t + 1), width)
    trees = F.flatten(F.transform("depths", lambda d: F.array(*[F.struct(F.xxhash64(F.lit(t), d, own(t, 4 * d)).alias("node"), own(t, F.lit(4 * DEPTH)).alias("label")) for t in range(TREES)])))
    leaves = classes.where(F.col("labels").isNotNull()).select("rep", F.explode(F.transform(trees, lambda x: x["node"])).alias("node"))
    nodes = materialize(leaves.groupBy(F.col("node").alias("n")).agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > 1), "near-nodes")
    shared = leaves.join(nodes, F.col("node") == F.col("n")).select("node", F.col("rep").alias("r"), F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks"))
    rows = shared.join(classes, F.col("r") == F.col("rep")).select("node", "rep", "blocks", "bits", F.filter(trees, lambda x: x["node"] == F.col("node"))[0]["label"].alias("label"))
    spread = _blocked(rows, ["node"], ["label", "bits"]).repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "label", "rep")
    bound = agreement_bound()

    def edges(i: int, j: int, side: np.ndarray, rep: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        agree = np.zeros((len(rep), len(rep)), bool)
        for k in range(len(rep)):
            agree[k] = (bits[k] == bits).sum(axis=1) >= bound
        return rep, _connected(agree & _apart(i, j, side), rep)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come node by node, each in the order of its labels; the last node of a batch may go on in the next."""
        held: list[pa.RecordBatch] = []

        def compared(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
            i, j, side, rep = (table.column(c).to_numpy() for c in ("i", "j", "block", "rep"))
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(rep), -1)
            found = [edges(int(i[a]), int(j[a]), side[a:b], rep[a:b], bits[a:b]) for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a[a != b], pa.int64()), pa.array(b[a != b], pa.int64())], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("node", "i", "j")], 1)
            turns = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(turns):
                yield compared(table.slice(0, int(turns[-1])), turns)
                held = table.slice(int(turns[-1])).to_batches()
        table = pa.Table.from_batches(held) if held else None
        if table is not None and table.num_rows:
            yield compared(table, np.array([table.num_rows]))

    return spread.mapInArrow(walk, "a long, b long")


def shingle_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """members: rep, root, blocks, n, digest. Returns root, rep, blocks, n, shingles (sorted distinct hashes, binary) from the representatives' whole texts."""
    texts = docs.join(members, docs["doc_id"] == members["rep"]).select("root", "rep", "blocks", "n", "digest", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            same: list[bool] = []
            for group in _groups(list(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True))):
                digests, shingles, at = shingle_rows([t for _, t in group])
                out += [np.unique(shingles[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                same += [bytes(d) == digest for (d, _), digest in zip(group, digests, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], names=["root", "rep", "blocks", "n", "shingles"]).filter(pa.array(same, pa.bool_()))

    return texts.mapInArrow(build, "root long, rep long, blocks int, n long, shingles binary")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two of the sets share."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    rows, column = rows[keep], (np.cumsum(times > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    counts = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[rows[a:b], column[a:b] - low] = 1
        counts += part @ part.T
    return counts.astype(np.int64)


def verify(sets: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """sets: root, rep, blocks (of its cluster), n, shingles. Returns rep, links (documents, not classes), root: the least rep it is joined to in the block."""
    over, under = threshold.numerator, threshold.denominator
    spread = _blocked(sets, ["root"], ["n", "shingles"]).repartition("root", "i", "j")  # else Spark may keep all blocks of a cluster where the cluster is

    def compare(rows: pa.Table) -> pa.Table:
        _, once = np.unique(np.asarray(rows.column("rep").to_pylist(), np.int64), return_index=True)  # a repeated row comes again
        rows = rows.take(once)
        side, rep, n = (np.asarray(rows.column(c).to_pylist(), np.int64) for c in ("block", "rep", "n"))
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        held = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        common, sizes = common_counts(held), np.asarray([len(s) for s in held], np.int64)
        near = (under * common >= over * (sizes[:, None] + sizes[None, :] - common)) & _apart(i, j, side)
        return pa.table({"rep": rep, "links": (near @ n).astype(np.int64), "root": _connected(near, rep)})

    return spread.groupBy("root", "i", "j").applyInArrow(compare, "rep long, links long, root long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id that it is joined to through links), copy_id (least doc_id with the same words), n_links."""
    clean = _clean(docs)
    held = materialize(sketches(clean), "near-sketches")
    ids = held.groupBy("doc_id").agg(F.min(F.struct("h", "digest"))["digest"].alias("digest"))
    first = ids.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    labels = held.groupBy(F.col("digest").alias("l_digest")).agg(F.min(F.struct("depths", "labels", "bits")).alias("l"))
    classes = materialize(first.join(labels, F.col("digest") == F.col("l_digest")).select("digest", "rep", "n", "l.*"), "near-classes")
    clusters = components(forest_edges(classes.select("rep", "depths", "labels", "bits")))
    members = materialize(classes.select("digest", "rep", "n").join(clusters, F.col("rep") == F.col("node")).select("rep", "root", "n", "digest"), "near-members")
    size = materialize(members.groupBy(F.col("root").alias("r")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "near-sizes")
    members = members.join(size, F.col("root") == F.col("r")).select("rep", "root", "blocks", "n", "digest")
    found = materialize(verify(materialize(shingle_sets(clean, members), "near-sets")), "near-found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links")).withColumnRenamed("rep", "l_rep")
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("root", "class_id")
    known = classes.select("digest", "rep", "n").join(links, F.col("rep") == F.col("l_rep"), "left").join(joined, F.col("rep") == F.col("node"), "left")
    known = known.select(F.col("digest").alias("d"), F.coalesce("class_id", "rep").alias("class_id"), F.col("rep").alias("copy_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = ids.join(known, F.col("digest") == F.col("d")).select("doc_id", "class_id", "copy_id", "n_links")
    nameless = docs.where(F.col("doc_id").isNull()).select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "class_id", "copy_id")], F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(nameless)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one document of each class: its least doc_id. Rows without a doc_id stay; rows that repeat a doc_id become one, that which was judged.

    A class is what links join, so that a document may go which is like another that goes, but not itself like the one that stays.
    """
    keep = near_duplicates(docs).where(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("__keep"))
    held = docs.join(materialize(keep, "near-keep"), docs["doc_id"] == F.col("__keep"), "left_semi")
    nth = F.row_number().over(W.partitionBy("doc_id").orderBy(F.xxhash64(F.coalesce("text", F.lit("")))))
    return held.withColumn("__nth", nth).where(F.col("__nth") == 1).drop("__nth").unionByName(docs.where(F.col("doc_id").isNull()))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
