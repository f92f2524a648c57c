"""Tables in the folder that driver and executors share, to cut a lineage."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger("framewright")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a folder of our own if all run on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix=f"spark-{label}-", dir="/tmp")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back, so that later steps survive lost executors and nothing is computed twice. Its number of rows, observed while it is written, goes to the log."""
    path = shared_folder(df.sparkSession, label)
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    LOG.info("%s: %d rows", label, seen.get["rows"])
    return df.sparkSession.read.schema(df.schema).parquet(path)
