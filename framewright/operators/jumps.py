"""Scans that skip: from a row to the row that its own value names, found for all blocks of rows at once.

The jumps i -> next(i) > i of a video's numbered rows form a functional graph. A block of rows is one task's work: it tells for each of its rows where a walk
from it leaves the block. Only the places where walks leave are entries of later blocks; the small graph of entries is walked by
pointer doubling, in as many rounds as the number of blocks has binary digits, and each block is then walked once from its entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators.machines import leaves, run_machine, walk
from framewright.storage import kept

BLOCK = 4096


def visited(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """steps: key, i (1, 2, .. in each key), next (> i) and others. Gives the rows that a walk from 1 meets, without next."""
    more = [f for f in steps.schema.fields if f.name not in ("key", "i", "next")]
    numbered = kept(steps.select("*", F.floor((F.col("i") - 1) / block).cast("long").alias("block")), "jumps")
    most = (numbered.agg(F.max("block")).first()[0] or 0) + 1
    entries = numbered.where("i = 1").select("key", F.col("block"), F.col("i").alias("entry"))
    if most > 1:
        exits = kept(run_machine(numbered.withColumn("down", -F.col("i")).select("key", "block", "down", "i", "next"), ["key", "block"], ["down"], leaves, ["i long", "to long"]).drop("block"), "jump-exits")
        places = exits.select("key", F.col("to").alias("i")).distinct().unionByName(entries.select("key", F.col("entry").alias("i"))).distinct()
        graph = kept(exits.join(places, ["key", "i"]), "jump-graph")  # only entries of blocks
        powers = [graph]
        while 1 << len(powers) < most:
            last = powers[-1]
            after = last.select("key", F.col("i").alias("to"), F.col("to").alias("far"))
            powers.append(kept(last.join(after, ["key", "to"]).select("key", "i", F.col("far").alias("to")), "jump-graph"))
        met = entries.select("key", F.col("entry").alias("i"))
        for jumps in reversed(powers):
            met = kept(met.unionByName(met.join(jumps, ["key", "i"]).select("key", F.col("to").alias("i"))), "jump-met")
        entries = met.select("key", F.floor((F.col("i") - 1) / block).cast("long").alias("block"), F.col("i").alias("entry")).distinct()
    live = numbered.join(entries, ["key", "block"]).select("key", "block", "i", "next", "entry", *[f.name for f in more])
    return run_machine(live, ["key", "block"], ["i"], walk, ["i long", *[f"{f.name} {f.dataType.simpleString()}" for f in more]]).drop("block")
