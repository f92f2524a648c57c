"""Scans, jumps, machines and cell hierarchies: equal to plain Python on random rows, and one long video over many tasks."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from framewright.functions.rounding import round_exact
from framewright.operators import folds, intervals, jumps, layout, scans, series
from framewright.operators.machines import fragments


def tuples(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def tasks_with_rows(df):
    """How many partitions hold rows when an operator's last shuffle was left as it is."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_scans_equal_plain_ones(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("ab"), rng.randrange(60), i, rng.choice([None, rng.randrange(9)])) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, t long, i long, v long").repartition(4)
    kinds = {f"{kind}_{forward}_{own}": scans.Scan(kind, F.col("v"), forward, own) for kind in ("sum", "max", "min", "nearest") for forward in (True, False) for own in (True, False)}
    out = {r["i"]: r for r in scans.scans(df, ["k"], ["t", "i"], width, **kinds).collect()}
    ordered = sorted(rows, key=lambda r: r[:3])
    for name, s in kinds.items():
        for k, t, i, v in rows:
            mine = [r for r in ordered if r[0] == k]
            at = mine.index((k, t, i, v))
            seen = mine[: at + s.own] if s.forward else mine[at + 1 - s.own :]
            values = [r[3] for r in seen if r[3] is not None]
            want = sum(values) if s.kind == "sum" else None if not values else max(values) if s.kind == "max" else min(values) if s.kind == "min" else values[-1] if s.forward else values[0]
            assert out[i][name] == want, (name, i)


def test_scans_take_null_keys_axes_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 5, 2), ("a", 1, 3), ("a", None, 4)], "k string, t long, v long")
    assert tuples(scans.numbered(df, ["k"], ["t"], 2, "n"), "v", "n") == [(1, 1), (2, 2), (3, 2), (4, 1)]
    assert scans.numbered(df.limit(0), ["k"], ["t"], 2, "n").count() == 0


def test_runs_and_neighbourhoods_in_cells(spark):
    rng = random.Random(2)
    values = [(v, n, rng.random()) for v in (1, 2) for n in range(5, 400)]
    df = spark.createDataFrame(values, "v int, n long, x double")
    plain = {}
    for v in (1, 2):
        xs = [x for w, _, x in values if w == v]
        for i, x in enumerate(xs):
            a = b = i
            while x < 0.7 and a and xs[a - 1] < 0.7:
                a -= 1
            while x < 0.7 and b + 1 < len(xs) and xs[b + 1] < 0.7:
                b += 1
            plain[v, i + 5] = (a + 5, b + 6) if x < 0.7 else (None, None)
    out = scans.runs(df, ["v"], "n", F.col("x") < 0.7, 16)
    assert {(r["v"], r["n"]): (r["vs"], r["ve"]) for r in out.collect()} == plain
    low = {(r["v"], r["n"]): r["run_length"] for r in series.low_runs(df, ["v"], ["n"], "x", 0.7, 16).collect()}
    assert low == {k: b - a if b else 0 for k, (a, b) in plain.items()}
    one = lambda w: sorted(map(tuple, series.shoulders(series.local_valley(df, ["v"], ["n"], "x", 0.5, width=w), ["v"], ["n"], "x", 0.9, width=w).collect()))
    assert one(20) == one(None) and any(r[3] for r in one(None))


@pytest.mark.parametrize("block", [9, 4096])
def test_walks_over_blocks(spark, block):
    rng = random.Random(block)
    steps = [(k, i, i + rng.choice([1, 1, 1, 2, 9, 40])) for k in ("a", "b", "c") for i in range(1, {"a": 90, "b": 2, "c": 37}[k])]
    want = []
    for k in ("a", "b", "c"):
        to = {i: n for q, i, n in steps if q == k}
        at = 1
        while at in to:
            want.append((k, at, -at))
            at = to[at]
    df = spark.createDataFrame(steps, "key string, i long, next long").withColumn("more", -F.col("i"))
    assert tuples(jumps.visited(df, block), "key", "i", "more") == sorted(want)


def plain_bursts(cuts, span, least, before, after):
    out, i = [], 0
    cuts = sorted(cuts)
    while i < len(cuts):
        near = [c for c in cuts if cuts[i] <= c < cuts[i] + span]
        if len(near) >= least:
            out.append((cuts[i] - before, max(near) + after, len(near)))
            i += len(near) - 1
        i += 1
    return sorted(out)


@pytest.mark.parametrize("block", [5, 4096])
def test_burst_zones_equal_a_plain_scan(spark, block):
    rng = random.Random(7)
    cuts = [(v, rng.randrange(500)) for v in ("a", "b") for _ in range(150)] + [("c", 5)]
    df = spark.createDataFrame(cuts, "v string, t long")
    found = folds.burst_zones(df, "v", "t", "t", 12, 3, 1, 2, block=block)
    assert tuples(found, "v", "zs", "ze", "n") == sorted((v, *z) for v in ("a", "b", "c") for z in plain_bursts([t for w, t in cuts if w == v], 12, 3, 1, 2))


def plain_merge(bounds, least):
    scenes = list(zip(bounds, bounds[1:]))
    while len(scenes) > 1:
        short = next((i for i, (a, b) in enumerate(scenes) if b - a < least), None)
        if short is None:
            break
        long = lambda i: scenes[i][1] - scenes[i][0]  # noqa: B023, E731
        left = short - 1 if short and (short == len(scenes) - 1 or long(short - 1) <= long(short + 1)) else short
        scenes[left : left + 2] = [(scenes[left][0], scenes[left + 1][1])]
    return scenes


def test_fragments_merge_as_by_repeated_search(spark):
    rng = random.Random(1)
    for _ in range(3000):
        bounds = sorted(rng.sample(range(60), rng.randrange(1, 14)))
        least = rng.randrange(1, 15)
        assert list(fragments(least)(iter([(b,) for b in bounds]))) == plain_merge(bounds, least), (bounds, least)
    rows = [(v, t) for v in (1, 2, 3) for t in sorted(rng.sample(range(2000), 120))]
    df = spark.createDataFrame(rows + rows[:5], "v int, t long")
    want = [(v, i + 1, *s) for v in (1, 2, 3) for i, s in enumerate(plain_merge([t for w, t in rows if w == v], 20))]
    for width in (50, None):
        assert tuples(folds.merge_fragments(df, "v", "t", 20, width), "v", "id", "start", "end") == want


def test_a_piece_of_many_short_scenes_takes_seconds(spark):
    n = 100_000
    df = spark.range(n).select(F.lit(1).alias("v"), (F.col("id") * 10 + F.col("id") % 3).alias("t"))
    began = time.time()
    out = folds.merge_fragments(df, "v", "t", 1000)
    held = out.agg(F.count(F.lit(1)), F.min(F.col("end") - F.col("start")), F.min("start"), F.max("end")).first()
    assert held[1] >= 1000 and held[2] == 0 and held[3] == (n - 1) * 10 + (n - 1) % 3 and time.time() - began < 60


def test_one_video_of_many_cuts_is_dealt_over_tasks(spark):
    n = 200_000
    df = spark.range(n).select(F.lit(1).alias("v"), (F.col("id") * 7 + (F.col("id") * F.col("id")) % 5).alias("t"))
    zones = folds.burst_zones(df, "v", "t", "t", 30, 3)
    found = tuples(zones.where("zs < 3000"), "zs", "n")
    plain = plain_bursts([i * 7 + i * i % 5 for i in range(600)], 30, 3, 0, 0)
    assert found == [(a, k) for a, _, k in plain if a < 3000] and zones.count() > n // 8
    numbered = scans.scans(df, ["v"], ["t"], 10_000, n=scans.Scan("sum", F.lit(1), own=True))
    assert numbered.agg(F.max("n"), F.count_distinct("n")).first() == (n, n)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for df in (numbered, zones, layout.offsets(df.withColumnRenamed("t", "id"), "v", F.lit(1.0))):
            assert tasks_with_rows(df) >= 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_layout_offsets_in_cells(spark):
    df = spark.createDataFrame([(v, i, float(i % 5)) for v in (1, 2) for i in range(1, 50)], "v int, id long, d double")
    for width in (4, 4096):
        out = {(r["v"], r["id"]): r for r in layout.offsets(df, "v", F.col("d"), 100.0, 50.0, width).collect()}
        top = 0.0
        for i in range(1, 50):
            h = max(i % 5 * 100.0, 50.0)
            r = out[2, i]
            assert (r["h"], r["y_start"], r["y_end"]) == (h, top, top + h)
            top += h
        assert {r["total"] for r in out.values()} == {top}


def test_intervals_of_any_length_take_few_nodes(spark):
    rng = random.Random(4)
    day = 86_400
    spans = [(i, s, s + rng.choice([1, 30, 3_600, day, 30 * day, 365 * day])) for i, s in ((i, rng.randrange(-day, 400 * day)) for i in range(300))]
    df = spark.createDataFrame([("v", i, a, b) for i, a, b in spans] + [("v", -1, 5, 5)], "v string, id long, start long, end long")
    points = [(k, rng.randrange(-day, 800 * day)) for k in range(400)] + [(1000 + i, b) for i, _, b in spans[:50]] + [(2000 + i, a) for i, a, _ in spans[:50]]
    p = spark.createDataFrame([("v", k, t) for k, t in points], "v string, k long, t long")
    found = tuples(intervals.point_in_interval(p, df, "v", "t", 60), "k", "id")
    assert found == sorted((k, i) for k, t in points for i, a, b in spans if a <= t < b)
    nodes = df.select(F.size(intervals.cell_nodes(F.col("start"), F.col("end"), 60)).alias("n"), (F.col("end") - F.col("start")).alias("long"))
    assert nodes.agg(F.max("n")).first()[0] <= 2 * 20 and nodes.where("long > 31000000").count() > 20
    covered = df.select("id", F.explode(intervals.cell_nodes(F.col("start"), F.col("end"), 60)).alias("x")).select("id", "x.*")
    sizes = {r["id"]: r["cells"] for r in covered.groupBy("id").agg(F.sum(F.expr("shiftleft(1L, level)")).alias("cells")).collect()}
    assert all(sizes[i] == b // 60 - a // 60 + 1 for i, a, b in spans)  # every cell once


def test_zone_flags_are_one_row_a_zone(spark):
    rng = random.Random(9)
    zones = [(v, a, a + rng.choice([0, 3, 500])) for v in ("a", "b") for a in rng.sample(range(1000), 15)]
    points = [(v, t) for v in ("a", "b", "c", None) for t in range(-5, 1600, 3)] + [("a", None)]
    z = spark.createDataFrame(zones + [("a", None, 5), (None, 0, 2000)], "v string, zs long, ze long")
    out = intervals.zone_flags(spark.createDataFrame(points, "v string, t long"), z, "v", "t", 40).collect()
    assert len(out) == len(points)
    for r in out:
        assert r["in_zone"] == (r["t"] is not None and any(v == r["v"] and a <= r["t"] <= b for v, a, b in zones)), r


def test_rounding_by_the_exact_value(spark):
    rng = random.Random(6)
    values = [2.675, 0.125, 0.375, 1.005, 2.5, 3.5, 0.5, -0.5, -2.675, 1e-300, 4503599627370495.5, 1e22, 0.1 + 0.2, 5e-324, -0.0, 8.345] + [rng.uniform(-1000, 1000) for _ in range(500)] + [rng.randrange(10**6) / 2000 for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None), (-2, float("nan")), (-3, float("inf"))], "i long, v double")
    for digits in (0, 1, 2, 4):
        out = {r["i"]: r["x"] for r in df.select("i", round_exact(F.col("v"), digits).alias("x")).collect()}
        assert out[-1] is None and out[-2] != out[-2] and out[-3] == float("inf")
        for i, v in enumerate(values):
            assert out[i] == round(v, digits), (v, digits)
