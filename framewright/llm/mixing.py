"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Each source gets a target number of words; a document's share of it is its copy probability
target / source size, whose whole part is certain. The fractional parts are rounded together:
two documents of a source exchange probability mass, counted in words, in a random direction that
keeps every document's expectation, until one of them is integral. What stays fractional moves up
a reduction tree: a bucket of about FAN documents leaves at most one, FAN buckets merge into one
bucket of the next level. Words are conserved exactly at each exchange, so that a source misses
its target by less than the last document's size.

Defined cases: a null text has 0 words and is taken 0 times; a null source is a source of its own
(last in order); an empty table gives an empty table; rows that repeat a doc_id are separate
documents, and equal rows are counted before the shuffle and numbered, so that they spread over buckets; columns of other names pass through `mix_documents` unchanged, columns named
like its own results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from framewright.llm.common import attach, materialize, table, unit

FAN = 32
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source: source, n, source_size, target.

    Water filling: target = min(cap * size, level * weight), where level spends share * all sizes.
    With sources sorted by cap * size / weight, those that are full at the level form a prefix.
    The table has a row per source, so its global windows are as small as the list of sources.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1)
    ranked = per.select("*", weight.alias("w"), (F.lit(float(cap)) * F.col("source_size")).alias("most"))
    by_fill = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    earlier, later = by_fill.rowsBetween(W.unboundedPreceding, -1), by_fill.rowsBetween(0, W.unboundedFollowing)
    goal = F.lit(float(share)) * F.sum("source_size").over(W.partitionBy(F.lit(1)))
    level = (goal - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("w").over(later)
    levels = ranked.select("*", level.alias("level"), (F.col("most") / F.col("w") >= level).alias("open"))
    spent = F.min(F.when(F.col("open"), F.struct("fill", "level"))).over(W.partitionBy(F.lit(1)))["level"]
    found = levels.withColumn("fill", F.col("most") / F.col("w")).withColumn("at", spent)
    target = F.when(F.col("at").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("at") * F.col("w")))
    return found.select("source", "n", "source_size", target.alias("target"))


def _exchange(held: Column, new: Column, seed: int) -> Column:
    """Two fractional items: (decided item, item that stays fractional or null)."""
    p, s, q, t = held["p"], held["size"], new["p"], new["size"]
    give, room = p * s, (1 - q) * t
    down, up = F.least(give, room), F.least((1 - p) * s, q * t)
    falls = unit(held["doc_id"], new["doc_id"], held["size"], new["size"], F.lit(seed)) * (down + up) < up
    p1 = F.when(falls, F.when(give <= room, 0.0).otherwise(p - room / s)).otherwise(F.when((1 - p) * s <= q * t, 1.0).otherwise(p + q * t / s))
    q1 = F.when(falls, F.when(room <= give, 1.0).otherwise(q + give / t)).otherwise(F.when(q * t <= (1 - p) * s, 0.0).otherwise(q - (1 - p) * s / t))
    at = lambda item, value: F.struct(item["doc_id"].alias("doc_id"), item["size"].alias("size"), item["base"].alias("base"), value.alias("p"))
    return F.struct(at(held, p1).alias("a"), at(new, q1).alias("b"))


def _fold(items: Column, kind: str, seed: int) -> Column:
    """Round a bucket's fractional items one after another: (done items, the one left over)."""
    start = F.struct(F.lit(None).cast(kind).alias("rest"), F.array().cast(f"array<{kind}>").alias("done"))

    def step(state: Column, item: Column) -> Column:
        pair = _exchange(state["rest"], item, seed)
        whole = lambda x: (x["p"] <= 0.0) | (x["p"] >= 1.0)
        moved = F.transform(F.array(pair), lambda x: F.struct(
            F.when(~whole(x["a"]), x["a"]).when(~whole(x["b"]), x["b"]).alias("rest"),
            F.filter(F.array(x["a"], x["b"]), whole).alias("done"),
        ))[0]
        after = F.transform(F.array(moved), lambda m: F.struct(m["rest"].alias("rest"), F.concat(state["done"], m["done"]).alias("done")))[0]
        return F.when(state["rest"].isNull(), F.struct(item.alias("rest"), state["done"].alias("done"))).otherwise(after)

    return F.aggregate(items, start, step)


def round_copies(items: DataFrame, seed: int) -> DataFrame:
    """items: source, n (documents of the source), doc_id, size, p (copies wanted, >= 0). Returns doc_id, source, size, copies."""
    kind = "struct<doc_id:bigint,size:bigint,base:bigint,p:double>"
    base = F.floor("p").cast("long")
    split = items.select("source", "n", F.col("doc_id").cast("long").alias("doc_id"), F.col("size").cast("long").alias("size"), base.alias("base"), (F.col("p") - base).alias("p"))
    loose = (F.col("p") > 0) & (F.col("size") > 0)
    plain = split.where(~loose).select("doc_id", "source", "size", F.col("base").alias("copies"))
    most = split.agg(F.max("n")).first()[0] or 0
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / FAN)).cast("long")
    equal = split.where(loose).groupBy(*split.columns).agg(F.count(F.lit(1)).alias("times"))
    each = equal.select("*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
    rows = each.select("source", F.pmod(F.xxhash64("doc_id", "size", "nth", F.lit(seed)), buckets).alias("bucket"), F.struct("doc_id", "size", "base", "p").alias("item"))
    parts, level, groups = [plain], 0, -(-most // FAN)
    while True:
        mixed = F.array_sort(F.transform(F.collect_list("item"), lambda x: F.struct(F.xxhash64(x["doc_id"], x["size"], F.lit(seed + 1)).alias("h"), x.alias("x"))))
        folded = rows.groupBy("source", "bucket").agg(F.transform(mixed, lambda m: m["x"]).alias("items")).select("source", "bucket", _fold(F.col("items"), kind, seed).alias("r"))
        folded = materialize(folded, f"mix-level{level}")
        done = folded.select("source", F.explode("r.done").alias("d"))
        parts.append(done.select("d.doc_id", "source", "d.size", (F.col("d.base") + F.col("d.p").cast("long")).alias("copies")))
        rows = folded.where(F.col("r.rest").isNotNull()).select("source", F.floor(F.col("bucket") / FAN).alias("bucket"), F.col("r.rest").alias("item"))
        if groups <= 1:
            break
        groups, level = -(-groups // FAN), level + 1
    last = F.col("item.base") + (unit(F.col("item.doc_id"), F.lit(seed + 2)) < F.col("item.p")).cast("long")
    parts.append(rows.select("item.doc_id", "source", "item.size", last.alias("copies")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix_sizes(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 20) -> DataFrame:
    """sizes: doc_id, source, size. Returns doc_id, source, size, source_size, target, copies, taken."""
    targets = materialize(source_targets(sizes, weights, share, cap), "mix-targets")
    t = targets.withColumnRenamed("source", "t_source")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    items = sizes.join(t, sizes["source"].eqNullSafe(t["t_source"]), "left").select("source", "n", "doc_id", "size", F.least(F.lit(float(cap)), wanted).alias("p"))
    copies = round_copies(items, seed)
    return copies.join(t, copies["source"].eqNullSafe(t["t_source"]), "left").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Repeat or leave out whole documents so that their sources meet their targets: docs with each row as often as decided."""
    named = docs.withColumn("__row", F.xxhash64("doc_id", "source", "text"))  # rows without a doc_id spread by their text
    sizes = materialize(document_sizes(named.drop("doc_id").withColumnRenamed("__row", "doc_id")), "mix-sizes")
    decided = mix_sizes(sizes, **options).select(F.col("doc_id").alias("__row"), F.col("copies").alias("mix_copies"))
    held = attach(named, decided, "mix_copies", "__row").where(F.col("mix_copies") > 0)
    return held.withColumn("mix_copies", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*[c for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = materialize(document_sizes(table(spark, sf_dir, "documents")), "mix-sizes")
    return mix_sizes(sizes).select("doc_id", "size", "source_size", "target", "taken")
