"""Tumbling buckets over a stream of events, and the drained form that equals the batch result."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.operators.intervals import spread_nodes
from framewright.storage import shared_folder


def bucket_stream(stream: DataFrame, width: str, late: str = "1 day") -> DataFrame:
    """event_type, bucket, n, total per tumbling window of ts."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    sums = timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return sums.select("event_type", F.col("w.start").alias("bucket"), "n", "total")


def interval_stream(stream: DataFrame, intervals: DataFrame, key: str, t: str, width: float | None = None) -> DataFrame:
    """Each event of a stream with the stored interval (key, id, start, end) that holds it: a stream-static join, with a width on nodes of cells too."""
    held = intervals.select(F.col(key).alias("__k"), "id", "start", "end").where(F.col("end") > F.col("start"))
    p, i, node = spread_nodes(stream, F.col(t), held, F.col("start"), F.col("end"), width)
    i = i.withColumnsRenamed({c: f"{c}_i" for c in node})
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{c}_i") for c in node], F.col(key) == F.col("__k"))
    return p.join(i, same & (F.col(t) >= F.col("start")) & (F.col(t) < F.col("end"))).drop("__k", *node, *[f"{c}_i" for c in node])


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, as timers need; the session's own setting comes back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def ended(stream: DataFrame, key: str, t: str, far: int = 1 << 52) -> DataFrame:
    """The stream with one row more, of a video -1, that has only a far time (microseconds), so that the watermark passes all others once they are read: for streams that are read in one batch."""
    place = shared_folder(stream.sparkSession, "stream-end")
    values = {t: far, key: "-1"}
    last = stream.sparkSession.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in stream.schema.fields])
    last.write.parquet(place)
    return stream.unionByName(stream.sparkSession.readStream.schema(stream.schema).parquet(place))


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files at a path; a pattern may name a single file, a plain path must be a folder."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over all that is there now; its result, from the shared folder: the last one (complete) or all (append)."""
    place = shared_folder(stream.sparkSession, "stream")
    write = lambda batch, _: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{place}/out")
    with state_store(stream.sparkSession):
        started = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(write).start()
        started.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{place}/out")


def drained_buckets(spark: SparkSession, path: str, width: str) -> DataFrame:
    return drained(bucket_stream(read_stream(spark, path), width), "complete")
