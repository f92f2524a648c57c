"""Session settings shared by the queries, the tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "framewright", cores: str | int | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    n = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
