"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns node, root: the least node of each node's component, for all nodes that have an edge.

    Alternating large-star and small-star steps; every step is a minimum per node (combined before
    the shuffle) joined back to the edges, written to the shared folder. The roots are read off
    when a round changes nothing. The steps are known to settle after at most about log(nodes)^2 rounds, so none are cut off.

    Defined cases: an edge with a null end, or from a node to itself, is left out; repeated edges count once; no edges
    give an empty table.
    """
    held = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    mark = None
    while True:
        both = held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "k")
        least = materialize(least, "cc-least")  # read again, so that the join has a shuffle on either side and a hub's edges can be split
        large = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "cc-large")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k"), "cc-low")
        small = large.join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        small = small.unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()
        held = materialize(small, "cc-small")
        now = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = held.select("b").distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
