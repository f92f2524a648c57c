"""Streams with timers over several batches, with late rows, and state that ends."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from framewright.operators import folds, intervals
from framewright.streaming.buckets import ended, state_store
from framewright.streaming.similarity import lag_stream
from framewright.streaming.timers import burst_stream, caption_stream
from tests.test_scale import tuples

SECOND = 1_000_000


class Feed:
    """A folder of files that a stream reads one a batch, in the order in which they were written; run() reads what is new and gives all results so far."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.path}/in/part={self.n:03d}")
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{self.path}/in")

    def run(self, made):
        out = f"{self.path}/out"
        with state_store(self.spark):
            query = made.writeStream.option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).foreachBatch(lambda b, _: b.write.mode("append").parquet(out)).start()
            query.awaitTermination()
        return self.spark.read.schema(made.schema).parquet(out)


def shuffled(rows, at, late, rng):
    """Rows in the order in which they come: at most `late` after later ones."""
    return sorted(rows, key=lambda r: at(r) + rng.randrange(late))


def test_burst_zones_on_a_stream(spark, tmp_path):
    rng = random.Random(3)
    cuts = [(v, rng.randrange(400) * SECOND // 4) for v in ("a", "b", "c") for _ in range(120)]
    feed = Feed(spark, str(tmp_path), "v string, t long")
    coming = shuffled(cuts, lambda r: r[1], 5 * SECOND, rng)
    for k in range(0, len(coming), 90):
        feed.put(coming[k : k + 90])
    made = burst_stream(feed.stream(), "v", "t", 2 * SECOND, 3, 10, 20, "6 seconds")
    early = feed.run(made).count()
    want = tuples(folds.burst_zones(spark.createDataFrame(cuts, "v string, t long"), "v", "t", "t", 2 * SECOND, 3, 10, 20), "v", "zs", "ze", "n")
    assert 0 < early < len(want)  # zones come before the stream ends, the last ones do not
    feed.put([("z", 10_000 * SECOND)])
    assert tuples(feed.run(made), "v", "zs", "ze", "n") == want
    feed.put([("a", 3 * SECOND), ("a", 3 * SECOND + 1), ("a", 3 * SECOND + 2), ("z", 10_001 * SECOND)])  # too late: dropped
    assert tuples(feed.run(made), "v", "zs", "ze", "n") == want


def test_captions_on_a_stream(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for v in ("a", "b"):
        for i in range(60):
            start = rng.randrange(100 * SECOND)
            rows.append((v, True, start, start + rng.randrange(1, 4 * SECOND), rng.choice([None, "x", f"s{i}"]), None))
            rows.append((v, False, None, rng.randrange(104 * SECOND), None, i))
    feed = Feed(spark, str(tmp_path), "v string, is_segment boolean, start long, at long, text string, id long")
    coming = shuffled(rows, lambda r: r[3], 5 * SECOND, rng)
    for k in range(0, len(coming), 60):
        feed.put(coming[k : k + 60])
    feed.put([("z", True, 9_000 * SECOND, 9_001 * SECOND, None, None)])
    probes = feed.stream().where("NOT is_segment").select("v", F.col("at").alias("t"), "id")
    segments = feed.stream().where("is_segment").select("v", "start", F.col("at").alias("end"), "text")
    found = feed.run(caption_stream(probes, segments, "v", "t", "id", 4 * SECOND, "6 seconds"))
    held = spark.createDataFrame(rows, feed.schema)
    batch = intervals.as_of(held.where("NOT is_segment").select("v", F.col("at").alias("t"), "id"), held.where("is_segment").select("v", "start", F.col("at").alias("end"), "text"), "v", "t", "id")
    key = lambda df: sorted(((r["v"], r["id"], r["t"], r["text"]) for r in df.collect()), key=repr)
    assert key(found) == key(batch) and any(r[3] for r in key(found))


def test_an_idle_video_has_no_state(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "v string, n long, h array<double>")
    rng = random.Random(1)
    frames = lambda v, a, b: [(v, n, [rng.random() for _ in range(4)]) for n in range(a, b)]
    feed.put(frames("a", 0, 5))
    made = lag_stream(feed.stream(), "v", "n", "h", 2, idle=3)
    assert tuples(feed.run(made), "v", "n") == [("a", n) for n in (2, 3, 4)]
    time.sleep(4)
    feed.put(frames("b", 0, 3))  # a batch in which the first video has timed out
    feed.run(made)
    feed.put(frames("a", 5, 8))
    out = tuples(feed.run(made), "v", "n")
    assert out == [("a", 2), ("a", 3), ("a", 4), ("a", 7), ("b", 2)]  # it starts anew


def test_the_end_of_a_stream(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "v string, t long")
    feed.put([("a", t * SECOND) for t in (1, 2, 3)])
    assert tuples(feed.run(burst_stream(ended(feed.stream(), "v", "t"), "v", "t", 9 * SECOND)), "v", "n") == [("a", 3)]


@pytest.mark.parametrize("width", [None, 10])
def test_lookup_of_stored_intervals(spark, tmp_path, width):
    from framewright.streaming.buckets import interval_stream

    feed = Feed(spark, str(tmp_path), "v string, t long")
    feed.put([("a", t) for t in range(0, 100, 7)] + [("b", 5)])
    held = spark.createDataFrame([("a", 1, 0, 15), ("a", 2, 15, 90), ("b", 3, 6, 9)], "v string, id long, start long, end long")
    found = feed.run(interval_stream(feed.stream(), held, "v", "t", width).select("v", "t", "id"))
    assert tuples(found, "v", "t", "id") == [("a", t, 1 if t < 15 else 2) for t in range(0, 90, 7)]
