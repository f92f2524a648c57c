"""URL filtering: rules first, then trust and distrust spread over the host graph.

A url is judged by the longest rule that fits its host (or a parent domain) and path. The remaining
urls get the verdict of their host. Hosts are joined by the hyperlinks of their pages and, both
ways, by the step from a host to its parent domain, so that subdomains of one site speak for each
other. Steps end at a site's own domain: two labels, or three where the last two are one of SUFFIXES; addresses and hosts with a port are whole. Trust is a personalised PageRank that starts from the pages that rules allow and follows the
edges; distrust starts from the pages that rules block and runs against them. A host is blocked where
its distrust exceeds `margin` times its trust; a host that neither reaches is allowed.

Work per step is one join on the host graph, for both ranks; ranks are written to the shared folder each ROUND
steps, so that plans stay short and survive lost executors. Iteration ends when a round moves less than the tolerance
of all mass and of each single rank, so that far hosts are reached and compared too.

Defined cases: a null url or one without `://` has an empty host and path, no rule, and the verdict
allow; null html has no links; rows that repeat a page_id are judged each; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import materialize, table

#: (rule, verdict): a host, then the path's start.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: Domains of two labels below which sites are registered.
SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "or.jp", "org.au", "org.uk"]
DAMPING, TOLERANCE, ROUND = 0.85, 1e-5, 8
TASK_EDGES = 100_000
LEAST = 1e-300  # ranks below are beyond a double's precision
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, start = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits as (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    return F.coalesce(*[F.when(fits(host, path, r), F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"))) for r, v in ordered])


def site_chain(host: Column, suffixes: list[str] = SUFFIXES) -> Column:
    """A host and its parent domains down to the site's own, as an array; only the host where it has a port or is an address."""
    labels = F.split(host, r"\.")
    ends = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".").isin(*suffixes)
    last = F.greatest(F.lit(1), F.size(labels) - F.when(ends, 2).otherwise(1))  # the place of the first label of the site's domain
    chain = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host.rlike(r"[:\[\]]|^[0-9.]+$"), F.array(host)).otherwise(chain)


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, w: hyperlinks between hosts (counted) and steps between a host and its parent domain inside its site."""
    linked = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("to"))
    linked = linked.select("src", F.translate("to", UPPER, LOWER).alias("dst")).where(F.col("src") != "").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w"))
    linked = materialize(linked, "links-linked")  # pages are searched once
    known = pages.select("host").distinct().unionByName(linked.select(F.col("dst").alias("host"))).where(F.col("host") != "").distinct()
    steps = known.select(site_chain(F.col("host")).alias("c")).where(F.size("c") > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(F.element_at("c", i).alias("a"), F.element_at("c", i + 1).alias("b")))).alias("s")).distinct()
    up = steps.select(F.col("s.a").alias("src"), F.col("s.b").alias("dst"), F.lit(1.0).alias("w"))
    down = steps.select(F.col("s.b").alias("src"), F.col("s.a").alias("dst"), F.lit(1.0).alias("w"))
    return linked.where(F.col("src") != F.col("dst")).unionByName(up).unionByName(down).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, most_steps: int | None = None) -> DataFrame:
    """seeds: host, trust, distrust (each sums to 1 or 0). Returns host, trust, distrust after propagation, or after most_steps."""
    bound = ceil(log(LEAST) / log(damping)) + ROUND  # no rank can still move by LEAST
    way = lambda kind, a, b: edges.select(F.lit(kind).alias("kind"), F.col(a).alias("from"), F.col(b).alias("to"), "w")
    ways = way("trust", "src", "dst").unionByName(way("distrust", "dst", "src"))
    total = ways.groupBy(F.col("kind").alias("k"), F.col("from").alias("f")).agg(F.sum("w").alias("all"))
    flow = ways.join(total, (F.col("kind") == F.col("k")) & (F.col("from") == F.col("f"))).select("kind", "from", "to", (F.col("w") / F.col("all")).alias("part"))
    tasks = max(1, -(-2 * edges.count() // TASK_EDGES))  # ranks are far smaller than pages: their tables and shuffles get tasks by their own size
    flow = materialize(flow.coalesce(tasks), "links-flow")
    nodes = flow.select(F.col("to").alias("host")).unionByName(flow.select(F.col("from").alias("host"))).unionByName(seeds.select("host")).distinct()
    first = nodes.join(seeds, "host", "left").select("host", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.coalesce(c, F.lit(0.0)).alias("seed")) for c in ("trust", "distrust")])).alias("e"))
    base = materialize(first.select("host", "e.*").coalesce(tasks), "links-seeds")
    ranks = base.select("host", "kind", F.col("seed").alias("rank"))
    for done in range(0, bound if most_steps is None else most_steps, ROUND):
        before = ranks
        for _ in range(ROUND):
            moved = flow.join(ranks.withColumnRenamed("kind", "k"), (F.col("kind") == F.col("k")) & (F.col("from") == F.col("host")))
            sums = moved.groupBy(F.col("to").alias("t"), F.col("kind").alias("k")).agg(F.sum(F.col("rank") * F.col("part")).alias("got"))
            step = (1 - damping) * F.col("seed") + damping * F.coalesce("got", F.lit(0.0))
            ranks = base.join(sums, (F.col("host") == F.col("t")) & (F.col("kind") == F.col("k")), "left").select("host", "kind", step.alias("rank")).coalesce(tasks)
        ranks = materialize(ranks, f"links-ranks{done}")
        was = before.select(F.col("host").alias("h"), F.col("kind").alias("k"), F.col("rank").alias("was"))
        change = F.abs(F.col("rank") - F.col("was"))
        moved, most = ranks.join(was, (F.col("host") == F.col("h")) & (F.col("kind") == F.col("k"))).agg(F.sum(change), F.max(change - tolerance * F.col("rank"))).first()
        if not moved or (moved < tolerance and most <= LEAST):
            break
    else:
        if most_steps is None:
            raise ValueError(f"ranks still move after {bound} steps")
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("rank"))).alias(kind)
    return ranks.groupBy("host").agg(of("trust"), of("distrust"))


def judge_pages(pages: DataFrame, rules: list[tuple[str, str]] = RULES, margin: float = 1.0) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust (of the host) for every row of pages (page_id, url, html)."""
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    judged = materialize(ruled.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("ruled")), "links-judged")
    count = lambda v: F.count_if(F.col("ruled") == v).cast("double")
    per_host = judged.where(F.col("host") != "").groupBy("host").agg(count("allow").alias("trust"), count("block").alias("distrust"))
    total = per_host.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    seeds = per_host.where((F.col("trust") > 0) | (F.col("distrust") > 0)).select("host", (F.col("trust") / (total["t"] or 1.0)).alias("trust"), (F.col("distrust") / (total["d"] or 1.0)).alias("distrust"))
    edges = materialize(host_edges(parts.select("host", "html")), "links-edges")
    ranks = spread(edges, seeds).withColumnRenamed("host", "ranked")
    scored = judged.join(ranks, judged["host"] == ranks["ranked"], "left")
    of_host = F.when(F.coalesce(F.col("distrust"), F.lit(0.0)) > margin * F.coalesce(F.col("trust"), F.lit(0.0)), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", of_host).alias("verdict"), "trust", "distrust")


def op6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages")).drop("trust", "distrust")
