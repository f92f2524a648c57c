"""Sharding by a k-d tree over document metadata (DataFrame functions only).

A node that must hold m shards is cut along its widest metadata dimension at the weighted quantile
floor(m / 2) / m, until every leaf is one shard of the target bytes. The quantile is found by
refining a histogram: a scan sums bytes in at most WIDE buckets of each dimension of each node, a second one in FINE
buckets of the part that holds the cut, so that the driver sees so many rows a node, whatever the number of documents. Dimensions: doc_id,
bytes, source and lang; text dimensions use a hashed coordinate, which keeps equal values together.

Equal texts share one point of the tree (that of their smallest doc_id) and so one shard. Groups that
weigh over GROUP_SHARE of a shard would upset the cuts: they are placed whole before, the heaviest first and
each in the emptiest shard (there are at most shards / GROUP_SHARE of them), and the tree deals the rest in
proportion to the room that is left. Only a group that weighs more than a shard's bytes is spread by doc_id.

Defined cases: a null text counts as no bytes; null metadata lie at the low end; rows that repeat
a doc_id are rows of their own; an empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

import heapq
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import dense_number, driver_rows, materialize, table, utf8

KEY_BITS, TIE_BITS = 63, 32
WIDE, FINE = 512, 4096
GROUP_SHARE, CUT_SHARE = 0.01, 0.0005
OVERHEAD = 16


def _scaled(value: Column, low: float, high: float) -> Column:
    """0 for null, else 1 .. 2**30 in the order of the value."""
    span = max(float(high) - float(low), 1.0)
    return F.coalesce(F.least(F.lit(1 << 30), F.floor((value.cast("double") - float(low)) / span * ((1 << 30) - 1)) + 1), F.lit(0)).cast("long")


def _hashed(value: Column) -> Column:
    return F.coalesce(F.shiftright(F.crc32(F.encode(value, "UTF-8")), 2), F.lit(0)).cast("long")


def _placed(rules: dict[int, tuple[int, int]], n: int = 0) -> Column:
    """The node of a row. A rule maps a node to (dimension, last key of its left child); its children are 2n+1 and 2n+2."""
    if n not in rules:
        return F.lit(n)
    dim, cut = rules[n]
    return F.when(F.col(f"key{dim}") <= cut, _placed(rules, 2 * n + 1)).otherwise(_placed(rules, 2 * n + 2))


def _histogram(points: DataFrame, node: Column, dims: int, asked: dict[tuple[int, int], tuple[int, int]], buckets: int) -> dict[tuple[int, int], list[tuple]]:
    """asked: (node, dimension) -> range of keys. One scan: for each the occupied buckets of the range in order, as (weight, least key, largest key)."""
    ranges = driver_rows(points.sparkSession, [(n, d, low, (high - low) // buckets + 1) for (n, d), (low, high) in asked.items()], "n int, d int, low long, width long")
    keys = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(f"key{d}").alias("key")) for d in range(dims)]))
    live = points.select("weight", node.alias("node"), keys.alias("k")).select("weight", "node", "k.*")
    near = live.join(F.broadcast(ranges), (F.col("node") == F.col("n")) & (F.col("dim") == F.col("d")))  # a row for each open node and dimension
    inside = near.withColumn("b", F.expr("(key - low) div width")).where((F.col("key") >= F.col("low")) & (F.col("b") < buckets))
    sums = inside.groupBy("node", "dim", "b").agg(F.sum("weight"), F.min("key"), F.max("key")).collect()
    out: dict[tuple[int, int], list[tuple]] = {}
    for n, d, _, *found in sorted(map(tuple, sums)):
        out.setdefault((n, d), []).append(tuple(found))
    return out


def kd_nodes(points: DataFrame, dims: int, room: list[float]) -> tuple[Column, dict[int, int]]:
    """points: weight and key0 .. key{dims-1} (non-negative longs). room: the share of the bytes that each leaf shall have. Returns the node expression and leaf node -> place in room.

    A level takes one scan for the histograms of all dimensions of all its nodes, which also show the widest one, and one that refines the
    bucket of each cut by its own least and largest key; only cuts between keys of one heavy value need more.
    """
    want, rules = {0: (0, len(room))}, {}
    box = {(0, d): (0, (1 << KEY_BITS) - 1) for d in range(dims)}
    while open_nodes := [n for n, (a, b) in want.items() if b - a > 1]:
        node = _placed(rules)
        seen = _histogram(points, node, dims, {k: r for k, r in box.items() if k[0] in open_nodes}, WIDE)
        box = {k: (found[0][1], found[-1][2]) for k, found in seen.items()}
        cuts, state, done = {}, {}, {}
        for n in {n for n, _ in seen}:
            a, b = want[n]
            cuts[n] = max(range(dims), key=lambda d: ((box[n, d][1] >> TIE_BITS) - (box[n, d][0] >> TIE_BITS), -d))  # noqa: B023
            total = sum(w for w, *_ in seen[n, cuts[n]])
            middle = (a + b) // 2
            goal = total * sum(room[a:middle]) / (sum(room[a:b]) or 1.0)
            state[n] = (goal, CUT_SHARE * total / (b - a), 0)
        while state:
            asked = {}
            for n, (goal, slack, run) in list(state.items()):
                for w, low, high in seen[n, cuts[n]]:
                    if run + w >= goal:
                        break
                    run += w
                if low == high or w <= slack:
                    done[n] = high if run + w - goal <= goal - run else low - 1
                    del state[n]
                else:
                    asked[n, cuts[n]], state[n] = (low, high), (goal, slack, run)
            if asked:
                seen = _histogram(points, node, dims, asked, FINE)
        rules |= {n: (cuts[n], done[n]) for n in cuts}
        split = {}
        for n, (a, b) in want.items():
            if n not in cuts:
                split[n] = (a, a + 1)
                continue
            split[2 * n + 1], split[2 * n + 2] = (a, (a + b) // 2), ((a + b) // 2, b)
            for d in range(dims):
                low, high = box[n, d]
                box[2 * n + 1, d] = (low, done[n] if d == cuts[n] else high)
                box[2 * n + 2, d] = (done[n] + 1 if d == cuts[n] else low, high)
        want = split
        box = {k: r for k, r in box.items() if r[0] <= r[1]}
    return _placed(rules), {n: a for n, (a, _) in want.items()}


def place_heavy(weights: list[int], shards: int) -> tuple[list[int], list[int]]:
    """The shard of each group, the heaviest first into the emptiest shard, and the bytes that each shard then has."""
    heap, where, load = [(0, s) for s in range(shards)], [0] * len(weights), [0] * shards
    for g in sorted(range(len(weights)), key=lambda g: -weights[g]):
        held, s = heap[0]
        where[g], load[s] = s, held + weights[g]
        heapq.heapreplace(heap, (load[s], s))
    return where, load


def room_left(load: list[int], rest: int) -> list[float]:
    """How much of the rest each shard takes, so that the shards come out as equal as their loads allow."""
    held, level = 0, 0.0
    for k, low in enumerate(sorted(load)):
        if k and level <= low:
            break
        held += low
        level = (rest + held) / (k + 1)
    return [max(0.0, level - x) for x in load]


def shard_rows(rows: DataFrame, shards: int) -> DataFrame:
    """rows: doc_id, size, source, lang, text_hash (long) and others. Adds shard (int)."""
    rows = materialize(rows, "shard-rows")
    b = rows.agg(F.min("doc_id").alias("i0"), F.max("doc_id").alias("i1"), F.min("size").alias("z0"), F.max("size").alias("z1"), F.sum("size").alias("all")).first()
    if b["all"] is None:
        return rows.withColumn("shard", F.lit(0))
    target = b["all"] / shards
    groups = rows.groupBy("text_hash", "size").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "source", "lang")).alias("lead"))
    weight = F.col("n") * F.col("size")
    shared = groups.where((F.col("n") > 1) & (weight <= target)).select(F.col("text_hash").alias("g_hash"), F.col("size").alias("g_size"), "lead", weight.alias("g_weight"))
    shared = materialize(shared, "shard-groups")  # read again, so that the join has a shuffle on either side and a hot text can be split
    heavy = [tuple(r) for r in shared.where(F.col("g_weight") > GROUP_SHARE * target).select("g_hash", "g_size", "g_weight").orderBy("g_hash", "g_size").collect()]
    where, load = place_heavy([w for *_, w in heavy], shards)
    room = room_left(load, b["all"] - sum(load))
    free = [s for s, r in enumerate(room) if r > 0] or [0]
    fixed = driver_rows(rows.sparkSession, [(h, z, s) for (h, z, _), s in zip(heavy, where, strict=True)], "g_hash long, g_size long, fixed int")
    shared = shared.join(F.broadcast(fixed), ["g_hash", "g_size"], "left") if heavy else shared.withColumn("fixed", F.lit(None).cast("int"))
    led = rows.join(shared, (rows["text_hash"] == shared["g_hash"]) & (rows["size"] == shared["g_size"]), "left")
    own = lambda c: F.when(F.col("lead").isNotNull(), F.col(f"lead.{c}")).otherwise(F.col(c))
    tie = F.shiftrightunsigned(F.xxhash64(F.when(F.col("lead").isNotNull(), F.col("text_hash")).otherwise(F.xxhash64("text_hash", "doc_id"))), 32)
    coords = [_scaled(own("doc_id"), b["i0"] or 0, b["i1"] or 0), _scaled(F.col("size"), b["z0"], b["z1"]), _hashed(own("source")), _hashed(own("lang"))]
    points = materialize(led.select(*[rows[c] for c in rows.columns], "fixed", F.col("size").alias("weight"), *[(F.shiftleft(c, 32) + tie).alias(f"key{d}") for d, c in enumerate(coords)]), "shard-points")
    node, leaf = kd_nodes(points.where(F.col("fixed").isNull()), len(coords), [room[s] for s in free])
    shard = F.coalesce("fixed", *[F.when(F.col("node") == n, F.lit(free[s])) for n, s in leaf.items()], F.lit(0))
    return points.withColumn("node", node).select(*rows.columns, shard.cast("int").alias("shard"))


def shard_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document, for a number of shards or for target bytes a shard."""
    raw = utf8(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.xxhash64(raw).alias("text_hash"),
    )
    if shards is None:
        rows = materialize(rows, "shard-sizes")
        shards = max(1, ceil((rows.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    placed = materialize(shard_rows(rows, shards), "shard-placed")
    pieces = max(1, placed.count() // (shards * 50_000))
    numbered = dense_number(placed, ["shard"], [F.col("doc_id"), F.col("text_hash")], "slot", ["doc_id", "text_hash"], pieces)
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
