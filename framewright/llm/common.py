"""What the operators share: table access, cut lineage, distributed ranks, safe attachment by id."""

from __future__ import annotations

import json
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

EQUAL_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, one of our own if all run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if not held:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-ckpt-", dir="/tmp"))
        held = spark.sparkContext.getCheckpointDir()
    return held.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_number(df: DataFrame, keys: list[str], order: list[Column], out: str, by: list[str], chunks: int) -> DataFrame:
    """Number rows 0.. without gaps inside each key, without bringing a key's rows into one task.

    Equal rows are counted before the shuffle and travel as blocks of at most EQUAL_ROWS. A key's blocks are dealt by a
    hash of the columns `by` over `chunks` pieces; pieces are numbered one after another, blocks inside a piece by order.
    The offsets of the pieces come from a table of one row per (key, piece).
    """
    equal = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    blocks = equal.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / EQUAL_ROWS))).alias("__block"))
    times = F.least(F.lit(EQUAL_ROWS).cast("long"), F.col("__n") - F.col("__block") * EQUAL_ROWS)
    held = blocks.select(*df.columns, "__block", times.alias("__times"), F.pmod(F.xxhash64(*by, "__block"), F.lit(chunks)).alias("__chunk"))
    sizes = held.groupBy(*keys, "__chunk").agg(F.sum("__times").alias("__size"))
    before = W.partitionBy(*keys).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__chunk", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inner = W.partitionBy(*keys, "__chunk").orderBy(*order, "__block").rowsBetween(W.unboundedPreceding, -1)
    ranked = held.withColumn("__in", F.coalesce(F.sum("__times").over(inner), F.lit(0)))
    same = reduce(lambda a, b: a & b, [ranked[k].eqNullSafe(offsets[k]) for k in [*keys, "__chunk"]])
    first = F.col("__before") + F.col("__in")
    placed = ranked.join(offsets, same, "left").select(*[ranked[c] for c in df.columns], first.alias("__first"), "__times")
    return placed.select(*df.columns, F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__times") - 1)).alias(out))


def unit(*cols: Column) -> Column:
    """A repeatable number in [0, 1) from the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def utf8(text: Column) -> Column:
    return F.coalesce(F.encode(text, "UTF-8"), F.to_binary(F.lit(""), F.lit("utf-8")))


def attach(docs: DataFrame, decided: DataFrame, value: str, by: str = "doc_id") -> DataFrame:
    """Give each row of docs the value decided for its key `by`; rows that repeat a key share that key's values in order.

    decided: the key and value, one row for each row of docs. Clashing names: decided's column wins.
    """
    kept = [c for c in docs.columns if c != value]
    key = F.coalesce(F.col(by).cast("string"), F.lit(""))  # never null, so that numbering and join share one shuffle of docs
    left = docs.select(*kept, key.alias("__key"))
    order = W.partitionBy("__key").orderBy(F.xxhash64(*[left[c] for c in kept if c != by]))
    left = left.withColumn("__k", F.row_number().over(order))
    right = decided.groupBy(key.alias("__key")).agg(F.array_sort(F.collect_list(value)).alias("__values"))
    return left.join(right, "__key", "left").select(*kept, F.try_element_at("__values", F.col("__k")).alias(value))


def driver_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows that the driver decided, as a table that the JVM makes by itself (createDataFrame starts Python workers). schema: `name type, ...`, numbers only."""
    names = [field.split()[0] for field in schema.split(",")]
    held = F.from_json(F.lit(json.dumps([dict(zip(names, r, strict=True)) for r in rows])), f"array<struct<{schema}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(held))
