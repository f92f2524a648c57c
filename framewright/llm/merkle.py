"""A Merkle manifest of a table by slot pivots (DataFrame functions only).

Leaves get places 0.. in order of their key. A pass groups the nodes of a tree by place div (fanout ** depth) and spreads them by conditional aggregates into
one column a slot; concatenated columns hashed give the `depth` levels above, and for each slot the concatenation without
its own column gives the siblings of every level. So a pass climbs `depth` levels with one shuffle, and the next has
1 / fanout ** depth of its rows. Paths come back downwards: a group's path is joined to its slots' own siblings; the path of a leaf is made and hashed in the last
stage and never stored. The roots of the parts' trees are the leaves of a last tree, by the same passes.

Places come without a sort in one task: equal rows are counted and travel as blocks, blocks are dealt to ranges of the order, numbered inside each range and moved by
the sizes of the ranges before. Every table of a pass is written to the shared folder.

Defined cases: a null field counts as `-`; a null doc_id comes first and is never tampered; rows that repeat a doc_id are leaves each, in order of
their hashes; a null text, lang or source is a value of its own; a lone leaf is its subroot; an empty table gives an empty table; columns beyond the five are not read.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from framewright.llm.common import EQUAL_ROWS, materialize, table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT, DEPTH = 2, 4
PIECE_ROWS = 50_000


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after another; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A field with its length before it, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def placed(rows: DataFrame, part: str, order: list[str]) -> tuple[DataFrame, int]:
    """Adds at (long): the place of each row among those of its part (never null), in the order of the columns; m: how many there are. Gives the largest m, too."""
    total = rows.count()
    pieces = max(1, ceil(total / PIECE_ROWS))
    equal = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n"))
    blocks = equal.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / EQUAL_ROWS))))
    times = F.least(F.lit(EQUAL_ROWS).cast("long"), F.col("__n") - F.col("__block") * EQUAL_ROWS)
    ranged = blocks.withColumn("__times", times).drop("__n").repartitionByRange(pieces, part, *order, "__block")
    ranged = materialize(ranged.withColumn("__piece", F.spark_partition_id()), "merkle-ranges")
    sizes = ranged.groupBy(part, "__piece").agg(F.sum("__times").alias("__size"))
    by_piece = W.partitionBy(part).orderBy("__piece")
    before = sizes.select(part, "__piece", (F.sum("__size").over(by_piece.rowsBetween(W.unboundedPreceding, 0)) - F.col("__size")).alias("__before"), F.sum("__size").over(W.partitionBy(part)).alias("m"))
    inside = W.partitionBy(part, "__piece").orderBy(*order, "__block")
    first = F.sum("__times").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("__times")
    numbered = ranged.withColumn("__first", first).join(before, [part, "__piece"])
    start = F.col("__before") + F.col("__first")
    most = sizes.groupBy(part).agg(F.sum("__size").alias("m")).agg(F.max("m")).first()[0] or 0
    return numbered.select(*rows.columns, "m", F.explode(F.sequence(start, start + F.col("__times") - 1)).alias("at")), most


class SlotTree:
    """The trees over nodes (part, at, m, node and further columns; most: the largest m), as one table of pivoted groups for each pass.

    Expressions over slots are written as SQL, as there are many of them.
    """

    def __init__(self, nodes: DataFrame, most: int, fanout: int = FANOUT, depth: int = DEPTH):
        self.fanout, self.depth, self.width = fanout, depth, fanout**depth
        self.passes: list[DataFrame] = []
        self.roots: list[DataFrame] = []
        extra = [c for c in nodes.columns if c not in ("part", "at", "m")]
        while most:
            own = f"named_struct({', '.join(f"'{c}', {c}" for c in extra)})"
            spread = [F.expr(f"max(CASE WHEN at % {self.width} = {j} THEN {own} END) AS s{j}") for j in range(self.width)]
            pivoted = materialize(nodes.groupBy("part", F.expr(f"at div {self.width} AS at")).agg(F.max("m").alias("m"), *spread), "merkle-slots")
            self.passes.append(pivoted)
            named = self._named(pivoted)
            ends = [f"WHEN m <= {self.fanout**level} THEN n{level}_0" for level in range(depth + 1)]  # a part with few nodes left ends below the top
            self.roots.append(named.where(F.col("m") <= self.width).selectExpr("part", f"CASE {' '.join(ends)} END AS root"))
            nodes = named.where(F.col("m") > self.width).selectExpr("part", "at", f"(m + {self.width - 1}) div {self.width} AS m", f"n{depth}_0 AS node")
            extra, most = ["node"], ceil(most / self.width) if most > self.width else 0

    def _named(self, pivoted: DataFrame) -> DataFrame:
        """Adds n{level}_{i}: the node of each level and place in a group; null where it has no children."""
        named = pivoted.selectExpr("*", *[f"s{j}.node AS n0_{j}" for j in range(self.width)])
        for level in range(1, self.depth + 1):
            below = [[f"n{level - 1}_{i}" for i in range(k, k + self.fanout)] for k in range(0, self.fanout ** (self.depth - level + 1), self.fanout)]
            named = named.selectExpr("*", *[f"CASE WHEN {run[0]} IS NOT NULL THEN sha2(concat_ws('', {', '.join(run)}), 256) END AS n{level}_{i}" for i, run in enumerate(below)])
        return named

    def _siblings(self, j: int) -> str:
        """Of slot j: for each level the siblings before and after, as far as the part's tree goes."""
        held = []
        for level in range(self.depth):
            own = j // self.fanout**level
            run = [f"n{level}_{i}" for i in range(own - own % self.fanout, own - own % self.fanout + self.fanout)]
            joined = lambda ids: f"concat_ws('', {', '.join(ids)})" if ids else "''"
            held.append(f"named_struct('l', {joined(run[: own % self.fanout])}, 'r', {joined(run[own % self.fanout + 1 :])})")
        levels = " ".join(f"WHEN m <= {self.fanout**level} THEN {level}" for level in range(self.depth))
        return f"slice(array({', '.join(held)}), 1, CASE {levels} ELSE {self.depth} END)"

    def subroots(self) -> DataFrame:
        """part, root."""
        return reduce(DataFrame.unionByName, self.roots)

    def leaves(self, above: DataFrame) -> DataFrame:
        """above: part and what its leaves inherit, with path (array of l, r) for what lies over the part's root. Gives each leaf with its whole path and what it inherits."""
        kept = [c for c in above.columns if c not in ("part", "path")]
        slots = [f"CASE WHEN s{j} IS NOT NULL THEN named_struct('at', at * {self.width} + {j}, 'own', s{j}, 'path', concat({self._siblings(j)}, path)) END" for j in range(self.width)]
        given = None
        for k in range(len(self.passes) - 1, -1, -1):
            groups = self._named(self.passes[k])
            ends = groups.where(F.col("m") <= self.width).join(above, "part")  # one group a part
            if given is not None:
                ends = ends.unionByName(groups.where(F.col("m") > self.width).join(given, ["part", "at"]))
            out = ends.selectExpr("part", *kept, f"inline(array_compact(array({', '.join(slots)})))")
            if k:
                given = materialize(out.drop("own"), "merkle-paths")
        return out.select("part", *kept, "at", "own.*", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def manifest(docs: DataFrame, forge: Column | None = None, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    A part for each lang. forge: what n_chars is taken to be when the root is recomputed (default: what it is).
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in FIELDS[1:]])
    hashed = lambda n: digest(*[field(n if c == "n_chars" else F.col(c)) for c in FIELDS])
    leaf = hashed(F.col("n_chars"))
    forged = F.lit(None).cast("string") if forge is None else F.when(forge.eqNullSafe(F.col("n_chars")), None).otherwise(hashed(forge))
    part = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))  # null first, never null
    leaves = materialize(named.select(part.alias("part"), "doc_id", leaf.alias("node"), forged.alias("forged")), "merkle-leaves")
    tree = SlotTree(*placed(leaves, "part", ["doc_id", "node", "forged"]), fanout, depth)
    if not tree.passes:
        none = F.lit(None).cast("string")
        return leaves.select("doc_id", F.col("node").alias("leaf"), *[none.alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")], F.lit(None).cast("boolean").alias("verified"))
    parts = tree.subroots().select(F.lit("").alias("part"), F.col("part").alias("of"), F.col("root").alias("node"))
    top = SlotTree(*placed(parts, "part", ["of", "node"]), fanout, depth)
    above = top.subroots().withColumn("path", F.array().cast("array<struct<l:string,r:string>>"))
    above = materialize(top.leaves(above).select(F.col("of").alias("part"), F.col("node").alias("subroot"), "root", "path"), "merkle-above")
    found = tree.leaves(above)
    steps = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    back = folded(F.coalesce("forged", "node"), F.col("path"))
    done = found.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", F.sha2(steps, 256).alias("proof_sha256"), back.alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_chars() -> Column:
    """n_chars, one more where 7 divides the CRC-32 of the doc_id."""
    return F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), tampered_chars())
