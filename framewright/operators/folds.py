"""Order-dependent folds over a video's cuts.

Gap rules and fragment merges start anew where neighbouring cuts are far enough apart; two-level scans find these places, and each
piece between them is folded for itself: gap rules as an array inside the JVM, merges as a state machine over sorted rows. The scan for
bursts, which skips by numbers of cuts, walks blocks of cuts by their jump tables. No window, array or task grows with the video; an array grows with
a piece, a run of cuts without a gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from framewright.operators.jumps import BLOCK, visited
from framewright.operators.machines import fragments, run_machine
from framewright.operators.scans import Scan, numbered, scans, with_halo

#: Cells of a scan, in gaps; in rows where the axis counts rows.
CELL_GAPS, CELL_ROWS = 4096, 4096


def _cuts(cuts: DataFrame, key: str, fields: list[str], *piece: str) -> DataFrame:
    return cuts.groupBy(key, *piece).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__cuts"))


def _pieces(cuts: DataFrame, key: str, t: str, apart, width: float) -> DataFrame:
    """Adds __piece: cuts of a video are in one piece until one is `apart` from the one before."""
    seen = scans(cuts, [key], [t], width, __last=Scan("nearest", F.col(t)))
    starts = seen.withColumn("__start", F.coalesce(apart(F.col(t) - F.col("__last")), F.lit(True)).cast("long")).withColumn("__rest", 1 - F.col("__start"))
    return scans(starts, [key], [t, "__rest"], width, __piece=Scan("sum", F.col("__start"), own=True)).drop("__last", "__start", "__rest")


def gap_dedupe(cuts: DataFrame, key: str, t: str, preferred: str, gap) -> DataFrame:
    """Keep a cut more than `gap` after the last kept one; a nearer one takes the last one's place if only it is preferred."""
    kind = cuts.select(F.struct(F.col(t).alias("t"), F.col(preferred).alias("p")).alias("s")).schema["s"].dataType.simpleString()

    def step(kept, x):
        last = F.try_element_at(kept, F.lit(-1))
        far = (F.size(kept) == 0) | (x["t"] - last["t"] > gap)
        return F.when(far, F.concat(kept, F.array(x))).when(x["p"] & ~last["p"], F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(x))).otherwise(kept)

    named = _pieces(cuts.select(key, F.col(t).alias("t"), F.col(preferred).alias("p")), key, "t", lambda step: step > gap, (gap or 1) * CELL_GAPS)
    folded = _cuts(named, key, ["t", "p"], "__piece").select(key, F.aggregate("__cuts", F.array().cast(f"array<{kind}>"), step).alias("k"))
    return folded.select(key, F.explode("k").alias("k")).select(key, F.col("k.t").alias(t), F.col("k.p").alias(preferred))


def zone_min_gap(cuts: DataFrame, key: str, t: str, in_zone: str, gap_inside, gap_outside) -> DataFrame:
    """Keep a cut at least the gap after the last kept one; the gap depends on whether the cut lies in a burst zone."""
    kind = cuts.select(F.struct(F.col(t).alias("t"), F.col(in_zone).alias("z")).alias("s")).schema["s"].dataType.simpleString()

    def step(kept, x):
        least = F.when(x["z"], F.lit(gap_inside)).otherwise(F.lit(gap_outside))
        return F.when((F.size(kept) == 0) | (x["t"] - F.try_element_at(kept, F.lit(-1))["t"] >= least), F.concat(kept, F.array(x))).otherwise(kept)

    named = _pieces(cuts.select(key, F.col(t).alias("t"), F.col(in_zone).alias("z")), key, "t", lambda step: step >= max(gap_inside, gap_outside), (max(gap_inside, gap_outside) or 1) * CELL_GAPS)
    folded = _cuts(named, key, ["t", "z"], "__piece").select(key, F.aggregate("__cuts", F.array().cast(f"array<{kind}>"), step).alias("k"))
    return folded.select(key, F.explode("k").alias("k")).select(key, F.col("k.t").alias(t), F.col("k.z").alias(in_zone))


def burst_zones(cuts: DataFrame, key: str, t: str, seq: str, span: int, least: int = 3, before: int = 0, after: int = 0, seq_width: float | None = None, block: int = BLOCK) -> DataFrame:
    """Zones of `least` or more cuts within `span` (exclusive) of an anchor; the scan goes on after as many cuts as the zone had.

    Anchors come in the order of `seq` (then of t); the count looks at all cuts of the video. t is an integer axis; cells of seq are `seq_width` long (default: as
    those of t where it is t, else CELL_ROWS).
    """
    width = span * CELL_GAPS
    order = [t] if seq == t else [seq, t]
    cells = seq_width or (width if seq == t else CELL_ROWS)
    anchors = numbered(cuts.select(*dict.fromkeys([key, t, seq])), [key], order, cells, "i")
    near, cell = with_halo(anchors.select(F.col(key).alias("key"), F.col(t).alias("t"), "i"), ["key"], F.col("t"), width, 0, span - 1)
    ahead = W.partitionBy(*cell).orderBy("t").rangeBetween(0, span - 1)
    seen = near.withColumns({"k": F.count(F.lit(1)).over(ahead), "mx": F.max("t").over(ahead)}).where("__own")
    steps = seen.select("key", "i", (F.col("i") + F.when(F.col("k") >= least, F.col("k")).otherwise(1)).alias("next"), "t", "k", "mx")
    met = visited(steps, block).where(F.col("k") >= least)
    return met.select(F.col("key").alias(key), (F.col("t") - before).alias("zs"), (F.col("mx") + after).alias("ze"), F.col("k").alias("n"))


def merge_fragments(bounds: DataFrame, key: str, t: str, least, width: float | None = None) -> DataFrame:
    """Merge scenes shorter than `least` until none is left: always the first such scene, into its shorter neighbour (a tie: the one before).

    On the boundaries of the scenes each step takes away one inner boundary; returns the scenes left. A boundary between two scenes that are long
    enough is never taken away, so that the boundaries between two such ones are merged for themselves, by a machine that reads them once.
    """
    width = width or least * CELL_GAPS
    once = scans(bounds.select(key, t).distinct(), [key], [t], width, __last=Scan("nearest", F.col(t)), __next=Scan("nearest", F.col(t), forward=False))
    firm = F.coalesce((F.col(t) - F.col("__last") >= least) & (F.col("__next") - F.col(t) >= least), F.lit(False)).cast("long")
    pieces = scans(once.withColumn("__firm", firm), [key], [t], width, __piece=Scan("sum", F.col("__firm"), own=True))
    both = F.when(F.col("__firm") == 1, F.array(F.col("__piece") - 1, F.col("__piece"))).otherwise(F.array("__piece"))  # it ends one piece and starts the next
    held = pieces.select(key, F.explode(both).alias("__piece"), t)
    kind = bounds.schema[t].dataType.simpleString()
    scenes = run_machine(held, [key, "__piece"], [t], fragments(least), [f"start {kind}", f"end {kind}"]).drop("__piece")
    return numbered(scenes, [key], ["start"], width, "id").select(key, "id", "start", "end")
