"""The queries of the engine's own operators on the star-schema tables, each with its SQL twin.

Stand-ins: a video is a user, its time axis the event times in microseconds; signups are the cuts of the adaptive detector,
clicks those of the histogram detector; event types stand for audio stems and values for amplitudes; embeddings for
frame histograms (a video for each label); documents for prompts (parts by source).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from framewright.functions import text as txt
from framewright.operators import documents as docs_ops
from framewright.operators import energy, folds, intervals, layout, scans, series

HOUR = 3_600_000_000
DAY = 24 * HOUR
#: Cells of two-level scans: of the time axis, and of numbered rows.
CELL, CELL_ROWS = 32 * DAY, 4096
STEM = {"click": "vocals", "view": "drums", "purchase": "bass", "signup": "other"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None, name: str | None = None):
    def keep(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE[name or f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    t = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    held = table(spark, sf_dir, "events")
    held = held.where(F.col("event_type").isin(*types)) if types else held
    return held.select("event_id", F.col("user_id").alias("video_id"), "event_type", t.alias("t"), "value", "props")


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = intervals.boundaries_to_intervals(events(spark, sf_dir, "signup").select("video_id", "t", "event_id"), "video_id", "t", "event_id", width=CELL)
    return intervals.number_intervals(held.select("video_id", "start", "end"), "video_id", width=CELL)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.coalesce(*[F.when(F.col("event_type") == e, F.lit(s)) for e, s in STEM.items()])
    return events(spark, sf_dir, *STEM).select("video_id", "t", stem.alias("stem"), F.col("value").alias("amplitude"))


EV = "ev AS (SELECT event_id, user_id AS video_id, event_type, epoch_us(ts) AS t, value, props FROM events)"
SHOTS = EV + """, iv AS (SELECT video_id, t AS st, lead(t) OVER (PARTITION BY video_id ORDER BY t, event_id) AS en FROM ev WHERE event_type = 'signup'),
shots AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY st, en) AS id, st, en FROM iv WHERE en IS NOT NULL)"""
ENERGY = SHOTS + """, smp AS (SELECT video_id, t, value AS amp, CASE event_type WHEN 'click' THEN 'vocals' WHEN 'view' THEN 'drums' WHEN 'purchase' THEN 'bass' WHEN 'signup' THEN 'other' END AS stem FROM ev WHERE event_type <> 'error'),
got AS (SELECT s.video_id, s.id, a.stem, sqrt(avg(a.amp * a.amp) + 1e-10) AS energy FROM shots s JOIN smp a ON a.video_id = s.video_id AND a.t >= s.st AND a.t < s.en GROUP BY s.video_id, s.id, a.stem),
energy AS (SELECT s.video_id, s.id, k.stem, coalesce(g.energy, 0) AS energy FROM shots s CROSS JOIN (VALUES ('vocals'), ('drums'), ('bass'), ('other')) k(stem) LEFT JOIN got g ON g.video_id = s.video_id AND g.id = s.id AND g.stem = k.stem),
ratio AS (SELECT *, energy / (sum(energy) OVER (PARTITION BY video_id, id) + 1e-10) AS ratio FROM energy),
wide AS (SELECT video_id, id, max(CASE WHEN stem = 'vocals' THEN ratio END) AS vocals, max(CASE WHEN stem = 'drums' THEN ratio END) AS drums, max(CASE WHEN stem = 'bass' THEN ratio END) AS bass, max(CASE WHEN stem = 'other' THEN ratio END) AS other FROM ratio GROUP BY video_id, id),
typed AS (SELECT video_id, id, CASE WHEN vocals > 0.5 THEN 'dialogue' WHEN drums + bass > 0.5 THEN 'bgm' WHEN other > 0.4 THEN 'sfx' ELSE 'mixed' END AS dominant_type FROM wide)"""


# Shots and their dialogue ------------------------------------------------------------------------


@query(f"""WITH {EV}, iv AS (SELECT video_id, t AS st, lead(t) OVER (PARTITION BY video_id ORDER BY t, event_id) AS en FROM ev WHERE event_type = 'signup')
SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY st, en) AS id, st AS start_us, en AS end_us, en - st AS dur_us FROM iv WHERE en - st >= {6 * HOUR}""")
def shot_intervals(spark, d):
    held = intervals.boundaries_to_intervals(events(spark, d, "signup").select("video_id", "t", "event_id"), "video_id", "t", "event_id", width=CELL).select("video_id", "start", "end")
    kept = intervals.number_intervals(held, "video_id", F.lit(6 * HOUR), CELL)
    return kept.select("video_id", "id", F.col("start").alias("start_us"), F.col("end").alias("end_us"), (F.col("end") - F.col("start")).alias("dur_us"))


def typed_shots(spark, d):
    e = energy.interval_rms(shots(spark, d), samples(spark, d), "video_id", "t", width=DAY)
    w = energy.wide_ratios(energy.stem_ratios(e, "video_id"), "video_id")
    return w.select("video_id", "id", energy.dominant_type(F.col("vocals"), F.col("drums"), F.col("bass"), F.col("other")).alias("dominant_type"))


@query(f"""WITH {ENERGY}, words AS (SELECT s.video_id, s.id, string_agg(e.props, ' ' ORDER BY e.t, e.event_id) AS dialogue FROM shots s JOIN ev e ON e.video_id = s.video_id AND e.event_type = 'view' AND e.t >= s.st AND e.t < s.en GROUP BY s.video_id, s.id)
SELECT s.video_id, s.id, s.st AS start_us, s.en AS end_us, '' AS ff, '' AS lf, coalesce(y.dominant_type, 'mixed') AS type, coalesce(w.dialogue, '') AS dialogue
FROM shots s LEFT JOIN words w ON w.video_id = s.video_id AND w.id = s.id LEFT JOIN typed y ON y.video_id = s.video_id AND y.id = s.id""")
def dialogue_alignment(spark, d):
    from framewright.plans.timeline import timeline_rows

    segments = events(spark, d, "view").select("video_id", "t", "event_id", F.col("props").alias("text"))
    frames = shots(spark, d).select("video_id", "id", F.lit(None).cast("string").alias("first_frame"), F.lit(None).cast("string").alias("last_frame"))
    rows = timeline_rows(shots(spark, d), segments, typed_shots(spark, d), frames, width=DAY)
    return rows.select("video_id", "id", F.col("start").alias("start_us"), F.col("end").alias("end_us"), "ff", "lf", "type", "dialogue")


@query(f"""WITH {SHOTS}, seg AS (SELECT video_id, t, CASE WHEN value < 100 THEN '  ' ELSE props END AS txt FROM ev WHERE event_type = 'view'),
hit AS (SELECT DISTINCT s.video_id, s.id FROM shots s JOIN seg e ON e.video_id = s.video_id AND e.t >= s.st AND e.t < s.en WHERE trim(e.txt) <> '')
SELECT s.video_id, count(*) AS n_shots, count(h.id) AS n_with_dialogue FROM shots s LEFT JOIN hit h ON h.video_id = s.video_id AND h.id = s.id GROUP BY s.video_id""")
def dialogue_nonempty(spark, d):
    seg = events(spark, d, "view").select("video_id", "t", F.when(F.col("value") < 100, "  ").otherwise(F.col("props")).alias("text"))
    s = shots(spark, d)
    hit = intervals.point_in_interval(seg.where(txt.strip(F.col("text")) != ""), s, "video_id", "t", DAY).select("video_id", "id").distinct().withColumn("hit", F.lit(1))
    return s.join(hit, ["video_id", "id"], "left").groupBy("video_id").agg(F.count(F.lit(1)).alias("n_shots"), F.count("hit").alias("n_with_dialogue"))


@query(f"""WITH {EV}, seg AS (SELECT video_id, t AS st, t + CAST(floor(value * 1000000) AS BIGINT) AS en, props AS txt FROM ev WHERE event_type = 'click'),
pr AS (SELECT video_id, event_id, t FROM ev WHERE event_type = 'purchase'),
nx AS (SELECT p.video_id, p.event_id, p.t, s.st, s.txt, row_number() OVER (PARTITION BY p.event_id ORDER BY s.en, s.st, s.txt) AS k FROM pr p LEFT JOIN seg s ON s.video_id = p.video_id AND s.en > p.t)
SELECT video_id, event_id, t, CASE WHEN st <= t THEN txt END AS text FROM nx WHERE k = 1""")
def caption_asof(spark, d):
    end = F.col("t") + F.floor(F.col("value") * 1000000).cast("long")
    seg = events(spark, d, "click").select("video_id", F.col("t").alias("start"), end.alias("end"), F.col("props").alias("text"))
    return intervals.as_of(events(spark, d, "purchase"), seg, "video_id", "t", "event_id", DAY)


@query(f"""WITH {SHOTS} SELECT e.event_id, arg_min(s.id, (s.st, s.en)) AS id FROM ev e JOIN shots s ON s.video_id = e.video_id AND e.t >= s.st AND e.t < s.en WHERE e.event_type = 'error' GROUP BY e.event_id""")
def current_shot(spark, d):
    return intervals.point_in_interval(events(spark, d, "error"), shots(spark, d), "video_id", "t", DAY, ["event_id"]).select("event_id", "id")


# Cut algebra ---------------------------------------------------------------------------------------


@query(f"""WITH {EV} SELECT a.video_id, a.event_id, a.t FROM ev a WHERE a.event_type = 'click' AND EXISTS (SELECT 1 FROM ev b WHERE b.event_type = 'signup' AND b.video_id = a.video_id AND abs(a.t - b.t) < {6 * HOUR})""")
def cut_band_semi(spark, d):
    return intervals.band(events(spark, d, "click"), events(spark, d, "signup"), "video_id", "t", 6 * HOUR, True, DAY).select("video_id", "event_id", "t")


@query(f"""WITH {EV} SELECT a.video_id, a.event_id, a.t FROM ev a WHERE a.event_type = 'click' AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.event_type = 'signup' AND b.video_id = a.video_id AND abs(a.t - ((b.t + {HOUR // 2}) // {HOUR}) * {HOUR}) < {6 * HOUR})""")
def cut_band_anti(spark, d):
    rounded = events(spark, d, "signup").withColumn("t", F.floor((F.col("t") + HOUR // 2) / HOUR) * HOUR)
    return intervals.band(events(spark, d, "click"), rounded, "video_id", "t", 6 * HOUR, False, DAY).select("video_id", "event_id", "t")


def shot_zones(spark, d):
    return shots(spark, d).select("video_id", F.col("start").alias("zs"), (F.col("start") + 6 * HOUR).alias("ze"))


@query(f"""WITH {SHOTS} SELECT e.video_id, e.event_id, EXISTS (SELECT 1 FROM shots s WHERE s.video_id = e.video_id AND e.t BETWEEN s.st AND s.st + {6 * HOUR}) AS in_zone FROM ev e WHERE e.event_type = 'view'""")
def zone_membership(spark, d):
    views, zones = events(spark, d, "view"), shot_zones(spark, d)
    return intervals.zone_flags(views.select("video_id", "event_id", "t"), zones, "video_id", "t", CELL).drop("t")


@query(f"""WITH RECURSIVE {EV}, seq AS (SELECT video_id, t, row_number() OVER (PARTITION BY video_id ORDER BY t) AS i, count(*) OVER w AS k, max(t) OVER w AS mx FROM ev WHERE event_type = 'click' WINDOW w AS (PARTITION BY video_id ORDER BY t RANGE BETWEEN CURRENT ROW AND {36 * HOUR - 1} FOLLOWING)),
r AS (SELECT video_id, i, t, k, mx FROM seq WHERE i = 1 UNION ALL SELECT n.video_id, n.i, n.t, n.k, n.mx FROM r JOIN seq n ON n.video_id = r.video_id AND n.i = r.i + CASE WHEN r.k >= 3 THEN r.k ELSE 1 END)
SELECT video_id, t - {HOUR} AS zs, mx + {2 * HOUR} AS ze, k AS n FROM r WHERE k >= 3""")
def burst_zones(spark, d):
    return folds.burst_zones(events(spark, d, "click"), "video_id", "t", "t", 36 * HOUR, 3, HOUR, 2 * HOUR)


@query(f"""WITH {EV}, c AS (SELECT video_id, t, event_type = 'signup' AS p FROM ev WHERE event_type IN ('signup', 'click')),
f AS (SELECT video_id, list_reduce(list([struct_pack(t := t, p := p)] ORDER BY t, p), lambda m, x: CASE WHEN x[1].t - m[-1].t > {HOUR} THEN list_concat(m, x) WHEN x[1].p AND NOT m[-1].p THEN list_concat(m[:-2], x) ELSE m END) AS m FROM c GROUP BY video_id),
u AS (SELECT video_id, unnest(m) AS k FROM f) SELECT video_id, k.t AS t, k.p AS is_psd FROM u""")
def priority_gap_dedupe(spark, d):
    cuts = events(spark, d, "signup", "click").withColumn("is_psd", F.col("event_type") == "signup")
    return folds.gap_dedupe(cuts, "video_id", "t", "is_psd", HOUR)


@query(f"""WITH {SHOTS}, c AS (SELECT e.video_id, e.t, EXISTS (SELECT 1 FROM shots s WHERE s.video_id = e.video_id AND e.t BETWEEN s.st AND s.st + {6 * HOUR}) AS z FROM ev e WHERE e.event_type = 'click'),
f AS (SELECT video_id, list_reduce(list([struct_pack(t := t, z := z)] ORDER BY t, z), lambda m, x: CASE WHEN x[1].t - m[-1].t >= CASE WHEN x[1].z THEN {3 * HOUR} ELSE {12 * HOUR} END THEN list_concat(m, x) ELSE m END) AS m FROM c GROUP BY video_id),
u AS (SELECT video_id, unnest(m) AS k FROM f) SELECT video_id, k.t AS t, k.z AS in_zone FROM u""")
def zone_min_gap(spark, d):
    cuts, zones = events(spark, d, "click"), shot_zones(spark, d)
    flagged = intervals.zone_flags(cuts.select("video_id", "t"), zones, "video_id", "t", CELL)
    return folds.zone_min_gap(flagged, "video_id", "t", "in_zone", 3 * HOUR, 12 * HOUR)


@query(f"""WITH RECURSIVE {EV}, b AS (SELECT video_id, list_sort(list(DISTINCT t)) AS bs FROM ev WHERE event_type = 'signup' GROUP BY video_id),
r AS (SELECT video_id, bs, 0 AS k FROM b UNION ALL SELECT video_id, list_concat(bs[1:p - 1], bs[p + 1:]) AS bs, k + 1 AS k FROM (SELECT *, CASE WHEN i = 1 THEN 2 WHEN i = len(bs) - 1 THEN i WHEN bs[i] - bs[i - 1] <= bs[i + 2] - bs[i + 1] THEN i ELSE i + 1 END AS p FROM (SELECT *, list_position(list_transform(range(1, len(bs)), lambda j: bs[j + 1] - bs[j] < {12 * HOUR}), true) AS i FROM r WHERE len(bs) > 2) WHERE i > 0)),
z AS (SELECT video_id, arg_max(bs, k) AS bs FROM r GROUP BY video_id), u AS (SELECT video_id, bs, unnest(range(1, len(bs))) AS id FROM z)
SELECT video_id, id, bs[id] AS start, bs[id + 1] AS "end" FROM u""")
def fragment_merge(spark, d):
    return folds.merge_fragments(events(spark, d, "signup"), "video_id", "t", 12 * HOUR)


@query(f"""WITH {EV} SELECT video_id, t // {DAY} AS day FROM ev WHERE event_type = 'signup' UNION SELECT video_id, t // {DAY} FROM ev WHERE event_type = 'click' UNION SELECT video_id, 0 FROM ev""")
def cut_union_distinct(spark, d):
    day = F.floor(F.col("t") / DAY).cast("long").alias("day")
    cuts = events(spark, d, "signup").select("video_id", day).unionByName(events(spark, d, "click").select("video_id", day))
    return cuts.unionByName(events(spark, d).select("video_id", F.lit(0).cast("long").alias("day"))).distinct()


@query(f"""WITH {EV} SELECT video_id, t // {DAY} AS day FROM ev WHERE event_type = 'signup' EXCEPT SELECT video_id, t // {DAY} FROM ev WHERE event_type = 'click'""")
def cut_except(spark, d):
    day = F.floor(F.col("t") / DAY).cast("long").alias("day")
    return events(spark, d, "signup").select("video_id", day).subtract(events(spark, d, "click").select("video_id", day))


@query(f"""WITH {EV}, cut AS (SELECT DISTINCT video_id, t FROM ev WHERE event_type = 'signup'), lim AS (SELECT video_id, max(t) AS e, min(t) AS s FROM ev GROUP BY video_id),
b AS (SELECT video_id, t FROM cut UNION SELECT video_id, s FROM lim UNION SELECT video_id, e FROM lim), iv AS (SELECT video_id, t AS st, lead(t) OVER (PARTITION BY video_id ORDER BY t) AS en FROM b)
SELECT video_id, st AS start, en AS "end" FROM iv WHERE en - st >= {3 * DAY}""")
def long_shots(spark, d):
    lim = events(spark, d).groupBy("video_id").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    ends = lim.select("video_id", F.explode(F.array("s", "e")).alias("t"))
    bounds = events(spark, d, "signup").select("video_id", "t").unionByName(ends).distinct()
    return intervals.boundaries_to_intervals(bounds, "video_id", "t", width=CELL).where(F.col("end") - F.col("start") >= 3 * DAY).select("video_id", "start", "end")


# Similarity series ---------------------------------------------------------------------------------

PAIRS = """e AS (SELECT label, vec_id, embedding::DOUBLE[] AS v, lag(embedding::DOUBLE[], {k}) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM embeddings),
c AS (SELECT label, vec_id, list_transform(v, lambda x: x - list_avg(v)) AS v, list_transform(p, lambda x: x - list_avg(p)) AS p FROM e WHERE p IS NOT NULL)"""
PEARSON = "list_inner_product(v, p) / sqrt(list_inner_product(v, v) * list_inner_product(p, p))"


@query("""WITH e AS (SELECT label, vec_id, embedding::DOUBLE[] AS v, lag(embedding::DOUBLE[], 1) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM embeddings),
s AS (SELECT label, vec_id, list_inner_product(v, p) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(p, p)) + 1e-8) AS sim FROM e WHERE p IS NOT NULL)
SELECT label, vec_id, round(sim, 6) AS sim FROM s WHERE sim < 0.9""")
def lag1_cosine(spark, d):
    sim = series.lag_similarity(table(spark, d, "embeddings"), ["label"], "vec_id", "embedding", 1, "cosine")
    return sim.where(F.col("sim") < 0.9).select("label", "vec_id", F.round("sim", 6).alias("sim"))


@query(f"WITH {PAIRS.format(k=1)} SELECT label, vec_id, round({PEARSON}, 6) AS sim FROM c WHERE {PEARSON} < 0.88")
def lag1_pearson(spark, d):
    sim = series.lag_similarity(table(spark, d, "embeddings"), ["label"], "vec_id", "embedding", 1, "pearson")
    return sim.where(F.col("sim") < 0.88).select("label", "vec_id", F.round("sim", 6).alias("sim"))


@query(f"WITH {PAIRS.format(k=15)} SELECT label, vec_id, round({PEARSON}, 6) AS sim FROM c")
def lag15_pearson(spark, d):
    sim = series.lag_similarity(table(spark, d, "embeddings"), ["label"], "vec_id", "embedding", 15, "pearson")
    return sim.select("label", "vec_id", F.round("sim", 6).alias("sim"))


@query("""WITH x AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS v FROM embeddings), b AS (SELECT vec_id, CAST(least(7, greatest(0, floor((v + 1) * 4))) AS INTEGER) AS bin FROM x)
SELECT vec_id, bin, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY vec_id), 6) AS share FROM b GROUP BY vec_id, bin""")
def bin_histogram(spark, d):
    from framewright.functions.arrays import bin_of

    x = table(spark, d, "embeddings").select("vec_id", F.explode("embedding").alias("v"))
    return series.histogram_shares(x, ["vec_id"], bin_of(F.col("v").cast("double"), -1, 1, 8)).withColumn("share", F.round("share", 6))


@query("""SELECT source, bin, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY source), 6) AS share
FROM (SELECT source, (((n_chars % 256) // 32) * 8 + ((doc_id % 256) // 32)) * 8 + (octet_length(encode(text)) % 256) // 32 AS bin FROM documents WHERE n_chars IS NOT NULL AND text IS NOT NULL) GROUP BY source, bin""")
def colour_histogram(spark, d):
    """Documents as pixels of a source: length, number and bytes for red, green and blue."""
    from framewright.functions.arrays import colour_bin

    r, g, b = F.col("n_chars") % 256, F.col("doc_id") % 256, F.octet_length("text") % 256
    held = table(spark, d, "documents").where("n_chars IS NOT NULL AND text IS NOT NULL")
    return series.histogram_shares(held, ["source"], colour_bin(r, g, b).cast("long")).withColumn("share", F.round("share", 6))


SERIES = f"WITH {EV}, s AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t, event_id) AS n FROM ev)"


def value_series(spark, d):
    return scans.numbered(events(spark, d), ["video_id"], ["t", "event_id"], CELL)


VALLEY = """v AS (SELECT *, coalesce(value < 50 AND value <= min(value) OVER l AND value <= min(value) OVER r AND count(value) OVER l >= 3 AND count(value) OVER r >= 3, false) AS is_valley FROM s
WINDOW l AS (PARTITION BY video_id ORDER BY n ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING), r AS (PARTITION BY video_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING))"""
SHOULDER = """h AS (SELECT *, coalesce(max(value) OVER l > 150 AND max(value) OVER r > 150, false) AS has_shoulders FROM v
WINDOW l AS (PARTITION BY video_id ORDER BY n ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING), r AS (PARTITION BY video_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING))"""
RUNS = """i AS (SELECT *, value < 80 AS low, n - row_number() OVER (PARTITION BY video_id, value < 80 ORDER BY n) AS isl FROM {src}),
w AS (SELECT *, CASE WHEN low THEN count(*) OVER (PARTITION BY video_id, low, isl) ELSE 0 END AS run_length, min(n) OVER (PARTITION BY video_id, low, isl) AS vs, max(n) OVER (PARTITION BY video_id, low, isl) + 1 AS ve FROM i)"""


@query(f"{SERIES}, {VALLEY} SELECT video_id, event_id, value FROM v WHERE is_valley")
def local_valley(spark, d):
    return series.local_valley(value_series(spark, d), ["video_id"], ["n"], "value", 50, width=CELL_ROWS).where("is_valley").select("video_id", "event_id", "value")


@query(f"{SERIES}, {VALLEY}, {SHOULDER} SELECT video_id, event_id, value FROM h WHERE is_valley AND has_shoulders")
def valley_shoulder(spark, d):
    v = series.local_valley(value_series(spark, d), ["video_id"], ["n"], "value", 50, width=CELL_ROWS)
    return series.shoulders(v, ["video_id"], ["n"], "value", 150, width=CELL_ROWS).where("is_valley AND has_shoulders").select("video_id", "event_id", "value")


@query(f"{SERIES}, {RUNS.format(src='s')} SELECT video_id, event_id, run_length FROM w")
def valley_width(spark, d):
    return series.low_runs(value_series(spark, d), ["video_id"], ["n"], "value", 80).select("video_id", "event_id", "run_length")


def candidates(spark, d):
    v = series.local_valley(value_series(spark, d), ["video_id"], ["n"], "value", 50, width=CELL_ROWS)
    h = series.shoulders(v, ["video_id"], ["n"], "value", 150, width=CELL_ROWS)
    w = series.run_bounds(series.low_runs(h, ["video_id"], ["n"], "value", 80), ["video_id"], "n", "value", 80)
    return w.where("is_valley AND has_shoulders AND run_length < 30").select("video_id", F.col("event_id").alias("cand"), "t", "n", "vs", "ve")


CANDIDATES = f"{SERIES}, {VALLEY}, {SHOULDER}, {RUNS.format(src='h')}, cand AS (SELECT video_id, event_id AS cand, t, n, vs, ve FROM w WHERE is_valley AND has_shoulders AND run_length < 30)"
NEAR = CANDIDATES + """, near AS (SELECT c.video_id, c.cand, c.vs, c.ve, f.n AS f_n, f.value, CASE WHEN f.n < c.vs THEN 'pre' WHEN f.n < c.ve THEN 'in' ELSE 'post' END AS part FROM cand c JOIN s f ON f.video_id = c.video_id AND f.n >= c.vs - 15 AND f.n < c.ve + 15),
st AS (SELECT video_id, cand, count(*) FILTER (part = 'pre') AS n_pre, count(*) FILTER (part = 'in') AS n_in, count(*) FILTER (part = 'post') AS n_post, coalesce(stddev_pop(value) FILTER (part = 'pre'), 0) AS dev_pre, coalesce(stddev_pop(value) FILTER (part = 'post'), 0) AS dev_post, avg(value) FILTER (part = 'pre') AS pre_value, avg(value) FILTER (part = 'post') AS post_value FROM near GROUP BY video_id, cand)"""


def near_frames(spark, d):
    return series.neighbourhood(candidates(spark, d).select("video_id", "cand", "vs", "ve"), value_series(spark, d).select("video_id", "n", "value"), "video_id", "n", 15)


@query(f"{NEAR} SELECT video_id, cand, n_pre, n_in, n_post, round(dev_pre, 6) AS dev_pre, round(pre_value, 6) AS pre_value, round(dev_post, 6) AS dev_post, round(post_value, 6) AS post_value FROM st")
def transition_stats(spark, d):
    found = series.transition_stats(near_frames(spark, d), "video_id", "cand", ["value"])
    return found.select("video_id", "cand", "n_pre", "n_in", "n_post", *[F.round(c, 6).alias(c) for c in ("dev_pre", "pre_value", "dev_post", "post_value")])


@query(f"""{NEAR}, ste AS (SELECT n.*, (value - lag(value) OVER (PARTITION BY n.video_id, n.cand ORDER BY f_n)) * sign(post_value - pre_value) AS d FROM near n JOIN st USING (video_id, cand) WHERE part = 'in' AND abs(post_value - pre_value) >= 3),
sh AS (SELECT video_id, cand, count(*) FILTER (d >= -1) / count(*) AS share FROM ste GROUP BY video_id, cand)
SELECT c.video_id, c.cand, c.t, round(sh.share, 6) AS share FROM cand c JOIN st USING (video_id, cand) JOIN sh USING (video_id, cand)
WHERE n_pre >= 5 AND n_post >= 5 AND dev_pre < 150 AND dev_post < 150 AND share >= 0.3 AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.event_type = 'signup' AND b.video_id = c.video_id AND abs(c.t - b.t) < {2 * HOUR})""")
def dissolve_candidates(spark, d):
    near = near_frames(spark, d)
    stats = series.transition_stats(near, "video_id", "cand", ["value"])
    shift = F.col("post_value") - F.col("pre_value")
    steady = stats.where((F.col("n_pre") >= 5) & (F.col("n_post") >= 5) & (F.col("dev_pre") < 150) & (F.col("dev_post") < 150) & (F.abs(shift) >= 3))
    moved = near.join(steady.select("video_id", "cand", F.signum(shift).alias("direction")), ["video_id", "cand"])
    share = series.monotone_share(moved, "video_id", "cand", "f_n", "value", F.col("direction")).where(F.col("share") >= 0.3)
    free = intervals.band(candidates(spark, d), events(spark, d, "signup"), "video_id", "t", 2 * HOUR, False, DAY)
    return free.join(share, ["video_id", "cand"]).select("video_id", "cand", "t", F.round("share", 6).alias("share"))


@query(f"""{SERIES}, c AS (SELECT video_id, event_id, n FROM s WHERE event_type = 'click'), m AS (SELECT c.event_id, arg_min(s.n, (s.value, s.n)) AS best FROM c JOIN s ON s.video_id = c.video_id AND abs(s.n - c.n) <= 5 AND s.value < 300 GROUP BY c.event_id)
SELECT c.video_id, c.event_id, c.n, coalesce(m.best, c.n) AS refined FROM c LEFT JOIN m USING (event_id)""")
def refine_argmin(spark, d):
    s = value_series(spark, d)
    return series.refine_argmin(s.where("event_type = 'click'").select("video_id", "event_id", "n"), s, "video_id", "event_id", "n", "n", "value", 5, 300.0)


# Energy ----------------------------------------------------------------------------------------------


@query(f"WITH {ENERGY} SELECT video_id, id, stem, round(energy, 6) AS energy FROM energy")
def interval_rms(spark, d):
    return energy.interval_rms(shots(spark, d), samples(spark, d), "video_id", "t", width=DAY).withColumn("energy", F.round("energy", 6))


@query(f"WITH {ENERGY} SELECT video_id, id, stem, round(ratio, 6) AS ratio FROM ratio")
def stem_ratios(spark, d):
    e = energy.interval_rms(shots(spark, d), samples(spark, d), "video_id", "t", width=DAY)
    return energy.stem_ratios(e, "video_id").select("video_id", "id", "stem", F.round("ratio", 6).alias("ratio"))


@query(f"WITH {ENERGY} SELECT * FROM typed")
def dominant_type(spark, d):
    return typed_shots(spark, d)


@query(f"WITH {ENERGY} SELECT dominant_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct, row_number() OVER (ORDER BY count(*) DESC, dominant_type) AS place FROM typed GROUP BY dominant_type")
def type_distribution(spark, d):
    return energy.type_distribution(typed_shots(spark, d))


@query(f"""WITH {SHOTS} SELECT video_id, id, CASE WHEN (en - st) / {HOUR}.0 < 12 THEN 'short' WHEN (en - st) / {HOUR}.0 > 240 THEN 'long' ELSE '' END AS duration_class, CASE WHEN (en - st) / {HOUR}.0 > 2 THEN 'major' ELSE 'minor' END AS marker, (en - st) / {HOUR}.0 >= 1.5 AS labelled FROM shots""")
def duration_class(spark, d):
    hours = (F.col("end") - F.col("start")) / HOUR
    return shots(spark, d).select("video_id", "id", layout.duration_class(hours, 12, 240).alias("duration_class"), layout.marker_class(hours).alias("m")).select("video_id", "id", "duration_class", "m.marker", "m.labelled")


@query(f"""WITH {SHOTS} SELECT video_id, count(*) AS n_shots, count(*) FILTER (en - st < {12 * HOUR}) AS n_short, count(*) FILTER (en - st > {240 * HOUR}) AS n_long, round(avg((en - st) / {HOUR}.0), 6) AS mean_duration, arg_max(en, id) AS total_duration FROM shots GROUP BY video_id""")
def duration_stats(spark, d):
    s = shots(spark, d).withColumn("hours", (F.col("end") - F.col("start")) / HOUR)
    return layout.duration_stats(s, "video_id", "hours", "end", 12, 240).withColumn("mean_duration", F.round("mean_duration", 6))


NUMBERED = f"""WITH {EV}, smp AS (SELECT video_id, event_type AS stem, value AS amp, row_number() OVER (PARTITION BY video_id, event_type ORDER BY t, event_id) - 1 AS n FROM ev),
b AS (SELECT video_id, stem, CAST(n // 4 AS BIGINT) AS bucket, sqrt(avg(amp * amp) + 1e-10) AS energy FROM smp GROUP BY video_id, stem, n // 4 HAVING count(*) = 4)"""


def numbered(spark, d):
    n = F.row_number().over(W.partitionBy("video_id", "event_type").orderBy("t", "event_id")) - 1
    return events(spark, d).select("video_id", F.col("event_type").alias("stem"), F.col("value").alias("amplitude"), n.alias("number"))


def buckets(spark, d):
    return energy.bucket_rms(numbered(spark, d), ["video_id", "stem"], "number", 4)


@query(f"{NUMBERED} SELECT video_id, stem, bucket, round(energy, 6) AS energy FROM b")
def bucket_rms(spark, d):
    return buckets(spark, d).withColumn("energy", F.round("energy", 6))


@query(f"{NUMBERED} SELECT video_id, stem, bucket, CAST(round_even(100 * energy / max(energy) OVER (PARTITION BY video_id, stem), 0) AS INTEGER) AS pct FROM b")
def bucket_pct(spark, d):
    return energy.bucket_percent(buckets(spark, d), ["video_id", "stem"]).select("video_id", "stem", "bucket", "pct")


@query(f"{NUMBERED} SELECT video_id, stem, bucket, round(least(1, energy / (SELECT max(energy) FROM b)), 6) AS level FROM b")
def global_norm(spark, d):
    return energy.global_norm(buckets(spark, d)).select("video_id", "stem", "bucket", F.round("level", 6).alias("level"))


HOURLY = f"""WITH {SHOTS}, base AS (SELECT video_id, min(t) AS t0 FROM ev GROUP BY video_id), hb AS (SELECT e.video_id, CAST((e.t - b.t0) // {HOUR} AS BIGINT) AS bucket, max(e.value) / 500 AS level FROM ev e JOIN base b USING (video_id) GROUP BY e.video_id, (e.t - b.t0) // {HOUR}),
rel AS (SELECT s.video_id, s.id, (s.st - b.t0) / {HOUR}.0 AS st, (s.en - b.t0) / {HOUR}.0 AS en FROM shots s JOIN base b USING (video_id))"""


def relative(spark, d):
    base = events(spark, d).groupBy("video_id").agg(F.min("t").alias("t0"))
    hourly = events(spark, d).join(base, "video_id").groupBy("video_id", F.floor((F.col("t") - F.col("t0")) / HOUR).alias("bucket")).agg((F.max("value") / 500).alias("level"))
    rel = shots(spark, d).join(base, "video_id").select("video_id", "id", *[((F.col(c) - F.col("t0")) / HOUR).alias(c) for c in ("start", "end")])
    return hourly, rel


@query(f"{HOURLY} SELECT r.video_id, r.id, h.bucket, round(h.level, 6) AS level, round(greatest(2, 100 * h.level), 6) AS bar FROM rel r JOIN hb h ON h.video_id = r.video_id AND h.bucket >= floor(r.st) AND h.bucket < floor(r.en)")
def bucket_slice(spark, d):
    hourly, rel = relative(spark, d)
    return energy.bucket_slice(hourly, rel, "video_id", F.lit(1)).select("video_id", "id", "bucket", F.round("level", 6).alias("level"), F.round("bar", 6).alias("bar"))


#: The transform of 64 samples written out: amplitudes of the frequencies 0 .. 32 of each group.
DFT = f"""{NUMBERED.split(", b AS")[0]}, head AS (SELECT stem, video_id, n, amp FROM smp WHERE n < 64), g AS (SELECT stem, video_id, count(*) AS m FROM head GROUP BY stem, video_id),
k AS (SELECT unnest(range(0, 33)) AS k), f AS (SELECT h.stem, h.video_id, k.k, sqrt(pow(sum(h.amp * cos(2 * pi() * k.k * h.n / 64)), 2) + pow(sum(h.amp * sin(2 * pi() * k.k * h.n / 64)), 2)) AS size FROM head h CROSS JOIN k GROUP BY h.stem, h.video_id, k.k),
c AS (SELECT stem, video_id, sum(k * 16 / 64.0 * size) AS top, sum(size) AS whole FROM f GROUP BY stem, video_id)"""


@query(f"{DFT} SELECT stem, video_id, CASE WHEN g.m >= 8 AND whole >= 1e-10 THEN round(top / whole, 1) ELSE 0 END AS centroid FROM c JOIN g USING (stem, video_id)")
def spectral_centroid(spark, d):
    return energy.spectral_centroid(numbered(spark, d), ["stem", "video_id"], "number", 16, first=64, least=8)


@query(f"""WITH {SHOTS}, l AS (SELECT video_id, (arg_max(en, id) - arg_min(st, id)) / {HOUR} AS duration FROM shots GROUP BY video_id), n AS (SELECT *, greatest(1, CAST(floor(duration * 1000 / 24000) AS INTEGER)) AS n FROM l)
SELECT video_id, duration, stem, CAST(unnest(range(0, n)) AS INTEGER) AS bucket, 0 AS pct FROM n CROSS JOIN (VALUES ('vocals'), ('drums')) s(stem)""")
def silent_waveform(spark, d):
    lengths = shots(spark, d).groupBy("video_id").agg((F.max_by("end", "id") - F.min_by("start", "id")).alias("us")).select("video_id", (F.col("us") / HOUR).alias("duration"))
    return energy.silent_waveform(lengths, ("vocals", "drums"), 24_000)


# Documents -----------------------------------------------------------------------------------------------


@query("""SELECT prompt_id, doc_id, lang, source, n_rows FROM (SELECT doc_id // 3 AS prompt_id, doc_id, lang, source, count(*) OVER (PARTITION BY doc_id // 3) AS n_rows, row_number() OVER (PARTITION BY doc_id // 3 ORDER BY source DESC, doc_id DESC) AS k FROM documents) WHERE k = 1""")
def prompt_last_wins(spark, d):
    parts = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 3).alias("prompt_id"), "doc_id", "lang", "source")
    return docs_ops.last_wins(parts, "prompt_id", "source", "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def prompts_missing(spark, d):
    return docs_ops.missing_ids(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("SELECT DISTINCT doc_id FROM labels WHERE toxic = 0 AND doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def prompts_extra(spark, d):
    return docs_ops.extra_ids(table(spark, d, "documents").where("lang = 'en'"), table(spark, d, "labels").where("toxic = 0"), "doc_id")


@query("""WITH p AS (SELECT doc_id, CASE WHEN n_chars < 300 THEN '' ELSE lang END AS camera, CASE WHEN lang = 'de' THEN NULL ELSE source END AS scene FROM documents)
SELECT doc_id, 'camera' AS field FROM p WHERE coalesce(camera, '') = '' UNION ALL SELECT doc_id, 'scene' FROM p WHERE coalesce(scene, '') = ''""")
def required_fields(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") < 300, "").otherwise(F.col("lang")).alias("camera"), F.when(F.col("lang") == "de", None).otherwise(F.col("source")).alias("scene"))
    return docs_ops.empty_fields(p, "doc_id", ("camera", "scene"))


@query("SELECT d.doc_id, d.lang, d.source, l.doc_id IS NOT NULL AS labelled, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def prompt_merge(spark, d):
    found = docs_ops.with_times(table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels"), "doc_id", ["quality", "toxic"])
    return found.select("doc_id", "lang", "source", F.col("quality").isNotNull().alias("labelled"), *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")])


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def frames_fill(spark, d):
    cache = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "data:").otherwise("").alias("first_frame"))
    return docs_ops.lacking(table(spark, d, "documents").select("doc_id", "n_chars"), cache, "doc_id", "first_frame")


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'thing')")
def text_filter(spark, d):
    return docs_ops.text_filter(table(spark, d, "documents"), "text", "  Thing ").select("doc_id")


@query("SELECT conv_id, string_agg('#' || turn || ' ' || role || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS script FROM conversations GROUP BY conv_id")
def copy_all(spark, d):
    line = F.concat(F.lit("#"), F.col("turn").cast("string"), F.lit(" "), F.col("role"), F.lit("\n"), F.col("text"))
    return docs_ops.ordered_text(table(spark, d, "conversations"), ["conv_id"], ["turn"], line, "\n\n", "script")


@query("""SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS escaped_md5 FROM pages""")
def html_escape(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(txt.html_escape(F.col("html"))).alias("escaped_md5"))


@query("SELECT page_id, replace(html, '</', '<\\/') AS safe FROM pages")
def json_script_safe(spark, d):
    return table(spark, d, "pages").select("page_id", txt.script_safe(F.col("html")).alias("safe"))


@query("SELECT doc_id, md5('data:image/jpeg;base64,' || to_base64(encode(text))) AS url_md5, text AS back FROM documents")
def data_url_roundtrip(spark, d):
    url = txt.data_url(F.encode("text", "UTF-8"))
    return table(spark, d, "documents").select("doc_id", F.md5(url).alias("url_md5"), F.decode(txt.from_data_url(url), "UTF-8").alias("back"))


@query("""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<style>(.*?)</style>', 1) AS style, regexp_extract(html, '(?s)<script>(.*?)</script>', 1) AS script FROM pages""")
def html_block_extract(spark, d):
    from framewright.sources.reports import html_block

    return table(spark, d, "pages").select("page_id", *[html_block(F.col("html"), tag).alias(tag) for tag in ("title", "style", "script")])


@query(f"""WITH {SHOTS} SELECT video_id, id, printf('shot_%03d_first.jpg', CAST(id AS INTEGER)) AS frame, printf('%.1f', round((en - st) / {HOUR}.0, 1)) || 'h' AS label FROM shots""")
def label_format(spark, d):
    hours = F.round((F.col("end") - F.col("start")) / HOUR, 1)
    return shots(spark, d).select("video_id", "id", txt.frame_name(F.col("id"), F.lit("first_frame")).alias("frame"), F.format_string("%.1fh", hours).alias("label"))


# Layout ------------------------------------------------------------------------------------------------------

LAID = HOURLY + """, h AS (SELECT *, greatest((en - st) * 4.0, 280.0) AS h FROM rel), lay AS (SELECT *, coalesce(sum(h) OVER (PARTITION BY video_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS y_start, sum(h) OVER (PARTITION BY video_id) AS total FROM h)"""


def laid(spark, d):
    _, rel = relative(spark, d)
    return layout.offsets(rel, "video_id", F.col("end") - F.col("start"), 4.0, 280.0)


@query(f"{LAID} SELECT video_id, id, round(h, 4) AS h, round(y_start, 4) AS y_start, round(y_start + h, 4) AS y_end, round(total, 4) AS total FROM lay")
def layout_offsets(spark, d):
    return laid(spark, d).select("video_id", "id", *[F.round(c, 4).alias(c) for c in ("h", "y_start", "y_end", "total")])


def located(spark, d):
    last = F.max("end").over(W.partitionBy("video_id"))
    return laid(spark, d).select("video_id", "start", "end", "y_start", "y_end", "total", last.alias("last_end"))


@query(f"""{LAID}, p AS (SELECT e.event_id, e.video_id, (e.t - b.t0) / {HOUR}.0 AS t FROM ev e JOIN base b USING (video_id) WHERE event_type = 'view'), bound AS (SELECT video_id, max(en) AS e, max(total) AS total FROM lay GROUP BY video_id),
hit AS (SELECT p.event_id, arg_min(l.y_start + (p.t - l.st) * l.h / nullif(l.en - l.st, 0), (l.st, l.en)) AS y FROM p JOIN lay l ON l.video_id = p.video_id AND p.t >= l.st AND p.t <= l.en GROUP BY p.event_id)
SELECT p.video_id, p.event_id, round(CASE WHEN p.t >= b.e THEN b.total ELSE coalesce(h.y, 0) END, 3) AS y FROM p JOIN bound b USING (video_id) LEFT JOIN hit h USING (event_id)""")
def time_to_y(spark, d):
    base = events(spark, d).groupBy("video_id").agg(F.min("t").alias("t0"))
    p = events(spark, d, "view").join(base, "video_id").select("video_id", "event_id", ((F.col("t") - F.col("t0")) / HOUR).alias("t"))
    return intervals.position_of_time(p, located(spark, d), "video_id", "t", "event_id", 24.0).select("video_id", "event_id", F.round("y", 3).alias("y"))


@query(f"""{LAID}, p AS (SELECT event_id, video_id, value * 10 - 100 AS y FROM ev WHERE event_type = 'view'), bound AS (SELECT video_id, max(en) AS e FROM lay GROUP BY video_id),
hit AS (SELECT p.event_id, arg_min(l.st + (p.y - l.y_start) * (l.en - l.st) / l.h, (l.y_start, l.y_start + l.h)) AS t FROM p JOIN lay l ON l.video_id = p.video_id AND p.y >= l.y_start AND p.y <= l.y_start + l.h GROUP BY p.event_id)
SELECT p.video_id, p.event_id, round(CASE WHEN p.y < 0 THEN 0 ELSE coalesce(h.t, b.e) END, 3) AS t FROM p JOIN bound b USING (video_id) LEFT JOIN hit h USING (event_id)""")
def y_to_time(spark, d):
    p = events(spark, d, "view").select("video_id", "event_id", (F.col("value") * 10 - 100).alias("y"))
    return intervals.time_of_position(p, located(spark, d), "video_id", "y", "event_id", 1000.0).select("video_id", "event_id", F.round("t", 3).alias("t"))


@query(f"{HOURLY} SELECT video_id, unnest(range(0, CAST(floor(max(en)) AS BIGINT) + 1, 10)) AS tick FROM rel GROUP BY video_id")
def ticks(spark, d):
    _, rel = relative(spark, d)
    return layout.ticks(rel.groupBy("video_id").agg(F.max("end").alias("duration")), "video_id")


@query(f"""{LAID}, t AS (SELECT video_id, max(total) AS total FROM lay GROUP BY video_id), u AS (SELECT video_id, total, unnest(range(0, CAST(ceil(total / 1000) AS BIGINT))) AS tile FROM t)
SELECT video_id, CAST(tile AS INTEGER) AS tile, round(least(1000, total - tile * 1000), 3) AS tile_height FROM u""")
def tiles(spark, d):
    heights = laid(spark, d).groupBy("video_id").agg(F.max("total").alias("total"))
    return layout.tiles(heights, "video_id", 1000).withColumn("tile_height", F.round("tile_height", 3))


@query(f"WITH {SHOTS} SELECT video_id, id, coalesce(lag(id) OVER (PARTITION BY video_id ORDER BY id), 0) AS prev_id, coalesce(lead(id) OVER (PARTITION BY video_id ORDER BY id), 0) AS next_id FROM shots")
def shot_navigation(spark, d):
    return layout.neighbours(shots(spark, d), "video_id").select("video_id", "id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("prev_id", "next_id")])


#: The exact value of a double, in units of 2**-60, is a whole number here.
EXACT = "CAST(x * 1152921504606846976.0 AS HUGEINT) * {scale}"


@query(f"""WITH x AS (SELECT event_id, CAST(event_id % 4000 AS DOUBLE) / 200 AS x FROM events), p AS (SELECT event_id, {EXACT.format(scale=100)} AS p2, {EXACT.format(scale=10)} AS p1, CAST(1152921504606846976 AS HUGEINT) AS u FROM x),
q AS (SELECT event_id, p2 // u AS q2, p2 % u AS r2, p1 // u AS q1, p1 % u AS r1, u FROM p)
SELECT event_id, CAST(q2 + CASE WHEN 2 * r2 > u OR (2 * r2 = u AND q2 % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100 AS hundredths, CAST(q1 + CASE WHEN 2 * r1 > u OR (2 * r1 = u AND q1 % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10 AS tenths FROM q""")
def exact_rounding(spark, d):
    """Steps of 0.005 to hundredths and tenths, by the exact value of the double."""
    from framewright.functions.rounding import round_exact

    x = (F.col("event_id") % 4000).cast("double") / 200
    return table(spark, d, "events").select("event_id", round_exact(x, 2).alias("hundredths"), round_exact(x, 1).alias("tenths"))


# Streams -----------------------------------------------------------------------------------------------------


@query("SELECT event_type, date_trunc('hour', ts) AS bucket, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type, date_trunc('hour', ts)")
def stream_bucket_counts(spark, d):
    from framewright.streaming.buckets import drained_buckets

    out = drained_buckets(spark, f"{d}/events.parquet", "1 hour")
    return out.select("event_type", F.col("bucket").cast("timestamp_ntz").alias("bucket"), "n", F.round("total", 4).alias("total"))


@query(f"""WITH {SHOTS} SELECT e.event_id, s.id FROM ev e JOIN shots s ON s.video_id = e.video_id AND e.t >= s.st AND e.t < s.en WHERE e.event_type = 'click'""")
def stream_current_shot(spark, d):
    from framewright.streaming.buckets import drained, interval_stream, read_stream

    clicks = read_stream(spark, f"{d}/events.parquet").where("event_type = 'click'")
    timed = clicks.select("event_id", F.col("user_id").alias("video_id"), F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").alias("t"))
    return drained(interval_stream(timed, shots(spark, d), "video_id", "t", DAY).select("event_id", "id"), "append")


@query(ORACLE["lag15_pearson"])
def stream_lag15_pearson(spark, d):
    from framewright.streaming.buckets import drained, read_stream
    from framewright.streaming.similarity import lag_stream

    sim = drained(lag_stream(read_stream(spark, f"{d}/embeddings.parquet"), "label", "vec_id", "embedding", 15), "append")
    return sim.select("label", "vec_id", F.round("sim", 6).alias("sim"))


def timed_stream(spark, d, event_type):
    from framewright.streaming.buckets import read_stream

    t = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    held = read_stream(spark, f"{d}/events.parquet").where(F.col("event_type") == event_type)
    return held.select("event_id", F.col("user_id").alias("video_id"), t.alias("t"), "value", "props")


@query(ORACLE["burst_zones"])
def stream_burst_zones(spark, d):
    from framewright.streaming.buckets import drained, ended
    from framewright.streaming.timers import burst_stream

    cuts = ended(timed_stream(spark, d, "click").select("video_id", "t"), "video_id", "t")
    return drained(burst_stream(cuts, "video_id", "t", 36 * HOUR, 3, HOUR, 2 * HOUR), "append")


@query(ORACLE["caption_asof"])
def stream_caption_asof(spark, d):
    from framewright.streaming.buckets import drained, ended
    from framewright.streaming.timers import caption_stream

    length = F.floor(F.col("value") * 1000000).cast("long")
    seg = timed_stream(spark, d, "click").select("video_id", F.col("t").alias("start"), (F.col("t") + length).alias("end"), F.col("props").alias("text"))
    probes = timed_stream(spark, d, "purchase").select("video_id", "event_id", "t")
    found = caption_stream(probes, ended(seg, "video_id", "end"), "video_id", "t", "event_id", HOUR)
    return drained(found, "append").select("video_id", "event_id", "t", "text")


# Report rules ------------------------------------------------------------------------------------------------


@query(f"""WITH {ENERGY} SELECT video_id, id, CASE dominant_type WHEN 'dialogue' THEN '#58a6ff' WHEN 'bgm' THEN '#3fb950' WHEN 'sfx' THEN '#d29922' WHEN 'mixed' THEN '#8b949e' ELSE '#666' END AS colour,
CASE dominant_type WHEN 'dialogue' THEN '💬' WHEN 'bgm' THEN '🎵' WHEN 'sfx' THEN '🔊' WHEN 'mixed' THEN '🔀' ELSE '❓' END AS sign FROM typed""")
def type_lookup(spark, d):
    from framewright.functions.shots import type_colour, type_sign

    return typed_shots(spark, d).select("video_id", "id", type_colour(F.col("dominant_type")).alias("colour"), type_sign(F.col("dominant_type")).alias("sign"))


@query(f"""{HOURLY} SELECT video_id, id, round(greatest(en - 0.05, st), 6) AS last_frame, round(greatest(0, least(st, 100 - 0.1)), 6) AS play_at, CAST(trunc(st * 30) AS BIGINT) AS frame_no FROM rel""")
def frame_times(spark, d):
    from framewright.functions.shots import frame_number, last_frame_time, play_time

    _, rel = relative(spark, d)
    return rel.select("video_id", "id", F.round(last_frame_time(F.col("start"), F.col("end")), 6).alias("last_frame"), F.round(play_time(F.col("start"), F.lit(100.0)), 6).alias("play_at"), frame_number(F.col("start")).alias("frame_no"))


@query("""WITH w AS (SELECT doc_id, text, CASE WHEN lang = 'en' THEN []::VARCHAR[] WHEN lang = 'fr' THEN NULL ELSE [source] END AS said FROM documents)
SELECT doc_id, CASE WHEN len(coalesce(said, [])) > 0 THEN said[1] ELSE lang_free END AS dialogue, substring(text, 1, 200) AS excerpt FROM (SELECT *, 'none' AS lang_free FROM w)""")
def dialogue_fallback(spark, d):
    from framewright.functions.shots import excerpt, first_filled

    said = F.when(F.col("lang") == "en", F.array().cast("array<string>")).when(F.col("lang") == "fr", F.lit(None).cast("array<string>")).otherwise(F.array("source"))
    return table(spark, d, "documents").select("doc_id", F.element_at(first_filled(said, F.array(F.lit("none"))), 1).alias("dialogue"), excerpt(F.col("text")).alias("excerpt"))


BARS = f"""{LAID}, st AS (SELECT video_id, event_type AS stem, value AS amp, row_number() OVER (PARTITION BY video_id, event_type ORDER BY t, event_id) - 1 AS n FROM ev),
bk AS (SELECT video_id, stem, CAST(n // 4 AS BIGINT) AS bucket, sqrt(avg(amp * amp) + 1e-10) AS energy FROM st GROUP BY video_id, stem, n // 4 HAVING count(*) = 4),
p AS (SELECT *, CAST(round_even(100 * energy / max(energy) OVER (PARTITION BY video_id, stem), 0) AS INTEGER) AS pct FROM bk), bound AS (SELECT video_id, max(en) AS e, max(total) AS total FROM lay GROUP BY video_id),
q AS (SELECT DISTINCT video_id, unnest([bucket, bucket + 1]) AS g FROM p), hit AS (SELECT q.video_id, q.g, arg_min(l.y_start + (q.g * 6.0 - l.st) * l.h / nullif(l.en - l.st, 0), (l.st, l.en)) AS y FROM q JOIN lay l ON l.video_id = q.video_id AND q.g * 6.0 >= l.st AND q.g * 6.0 <= l.en GROUP BY q.video_id, q.g),
pos AS (SELECT q.video_id, q.g, CASE WHEN q.g * 6.0 >= b.e THEN b.total ELSE coalesce(h.y, 0) END AS y FROM q JOIN bound b USING (video_id) LEFT JOIN hit h USING (video_id, g))"""


@query(f"""{BARS} SELECT p.video_id, p.stem, p.bucket, round(greatest(0.5, CASE WHEN y.y - x.y = 0 THEN 1 ELSE y.y - x.y END), 3) AS bar_h, round(pct / 100 * 300 * 0.45, 6) AS bar_w
FROM p JOIN pos x ON x.video_id = p.video_id AND x.g = p.bucket JOIN pos y ON y.video_id = p.video_id AND y.g = p.bucket + 1""")
def bar_geometry(spark, d):
    """Buckets of six hours; a bar stands between the positions of its bucket and of the next one."""
    return placed_bars(spark, d).select("video_id", "stem", "bucket", F.round("bar_h", 3).alias("bar_h"), F.round("bar_w", 6).alias("bar_w"))


def placed_bars(spark, d):
    p = energy.bucket_percent(buckets(spark, d), ["video_id", "stem"])
    at = p.select("video_id", F.explode(F.array("bucket", F.col("bucket") + 1)).alias("g")).distinct().withColumn("t", F.col("g") * 6.0)
    y = intervals.position_of_time(at, located(spark, d), "video_id", "t", "g", 24.0)
    low, high = y.select("video_id", F.col("g").alias("bucket"), "y"), y.select("video_id", (F.col("g") - 1).alias("bucket"), F.col("y").alias("y2"))
    placed = p.join(low, ["video_id", "bucket"]).join(high, ["video_id", "bucket"])
    return layout.bars(placed, F.lit(1), "y", "y2", 300)


@query(f"""{BARS}, bars AS (SELECT p.video_id, p.stem, p.bucket, round(x.y, 6) AS y, greatest(0.5, CASE WHEN y.y - x.y = 0 THEN 1 ELSE y.y - x.y END) AS bar_h, b.total
FROM p JOIN pos x ON x.video_id = p.video_id AND x.g = p.bucket JOIN pos y ON y.video_id = p.video_id AND y.g = p.bucket + 1 JOIN bound b ON b.video_id = p.video_id),
tile AS (SELECT video_id, total, k AS tile, k * 1000 AS top, least(1000, total - k * 1000) AS tall FROM (SELECT video_id, total, unnest(generate_series(0, CAST(ceil(total / 1000) AS BIGINT) - 1)) AS k FROM bound))
SELECT a.video_id, a.stem, a.bucket, t.tile, round(a.y - t.top, 3) AS y_in, round(greatest(0, least(floor(t.tall), a.y - t.top + a.bar_h) - greatest(0, a.y - t.top)), 3) AS drawn
FROM bars a JOIN tile t ON t.video_id = a.video_id AND NOT (a.y + 1 < t.top OR a.y > t.top + t.tall)""")
def bar_tiles(spark, d):
    """The bars in tiles of 1000 pixels."""
    totals = laid(spark, d).groupBy("video_id").agg(F.max("total").alias("total"))
    held = placed_bars(spark, d).join(totals, "video_id").withColumn("y", F.round("y", 6))
    cut = layout.bar_tiles(held, "video_id", "y", "total", 1000)
    return cut.select("video_id", "stem", "bucket", F.col("tile").cast("long").alias("tile"), F.round("y_in", 3).alias("y_in"), F.round("drawn", 3).alias("drawn"))


@query(f"""WITH {EV}, sg AS (SELECT DISTINCT video_id, t FROM ev WHERE event_type = 'signup'), sc AS (SELECT video_id, t AS st, lead(t) OVER (PARTITION BY video_id ORDER BY t) AS en FROM sg),
cl AS (SELECT DISTINCT video_id, t FROM ev WHERE event_type = 'click'), lg AS (SELECT * FROM sc WHERE en - st > {3 * DAY}),
ib AS (SELECT l.video_id, l.st AS ofs, c.t FROM lg l JOIN cl c ON c.video_id = l.video_id AND c.t > l.st AND c.t < l.en UNION SELECT video_id, st, st FROM lg UNION SELECT video_id, st, en FROM lg),
pa AS (SELECT video_id, ofs, t AS st, lead(t) OVER (PARTITION BY video_id, ofs ORDER BY t) AS en, count(*) OVER (PARTITION BY video_id, ofs) AS n FROM ib)
SELECT video_id, st AS start, en AS "end" FROM sc WHERE en IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pa WHERE pa.video_id = sc.video_id AND pa.ofs = sc.st AND pa.n > 2)
UNION ALL SELECT video_id, st, en FROM pa WHERE n > 2 AND en IS NOT NULL""")
def long_scene_parts(spark, d):
    """Scenes between signups; those of over three days give way to their parts between clicks, where a click lies inside."""
    scenes = intervals.boundaries_to_intervals(events(spark, d, "signup").select("video_id", "t").distinct(), "video_id", "t", width=CELL).select("video_id", "start", "end")
    long = scenes.where(F.col("end") - F.col("start") > 3 * DAY)
    inner = intervals.point_in_interval(events(spark, d, "click").select("video_id", "t").distinct(), long, "video_id", "t", DAY).where(F.col("t") > F.col("start"))
    ends = long.select("video_id", F.col("start").alias("of_start"), F.explode(F.array("start", "end")).alias("t"))
    bounds = inner.select("video_id", F.col("start").alias("of_start"), "t").unionByName(ends)
    order = W.partitionBy("video_id", "of_start").orderBy("t")
    parts = bounds.select("video_id", "of_start", F.col("t").alias("start"), F.lead("t").over(order).alias("end")).where(F.col("end").isNotNull())
    return intervals.replace_long(scenes, parts, "video_id", 3 * DAY)


ESCAPED = "replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


def escaped(x: str) -> str:
    return ESCAPED.format(x=f"coalesce({x}, '')")


@query(f"""WITH p AS (SELECT d.doc_id, d.lang, d.source, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, md5('<div class="card prompt"><b>#' || doc_id || '</b><p>' || CASE WHEN quality IS NULL OR toxic IS NULL THEN '' ELSE quality || '.0s - ' || toxic || '.0s' END || '</p></div><i>language</i> '
|| {escaped("lang")} || chr(10) || '<i>source</i> ' || {escaped("source")} || {escaped("substring(text, 1, 200)")} || '<pre>' || {escaped("text")} || '</pre>') AS card_md5 FROM p""")
def prompt_report(spark, d):
    from framewright.functions.shots import excerpt
    from framewright.sources.reports import prompt_card

    held = docs_ops.with_times(table(spark, d, "documents").select("doc_id", "lang", "source", "text"), table(spark, d, "labels"), "doc_id", ["quality", "toxic"])
    start, end = (F.col(c).cast("double") for c in ("quality", "toxic"))
    page = prompt_card(F.col("doc_id"), start, end, {"language": F.col("lang"), "source": F.col("source")}, excerpt(F.col("text")), F.col("text"))
    return held.select("doc_id", F.md5(page).alias("card_md5"))


@query(f"""{HOURLY} SELECT video_id, id, '<div class="card ' || CASE WHEN en - st < 12 THEN 'short' WHEN en - st > 240 THEN 'long' ELSE '' END || '"><b>#' || id || '</b><p>' || round(st, 1) || 's - ' || round(en, 1) || 's</p></div>' AS card FROM rel""")
def shot_cards(spark, d):
    from framewright.sources.reports import shot_card

    _, rel = relative(spark, d)
    css = layout.duration_class(F.col("end") - F.col("start"), 12, 240)
    return rel.select("video_id", "id", shot_card(F.col("id"), F.round("start", 1), F.round("end", 1), css).alias("card"))


@query(f"""WITH {ENERGY}, shares AS (SELECT video_id, id, string_agg(stem || ' ' || CAST(round(round(ratio, 4) * 100) AS INTEGER) || '%', ', ' ORDER BY stem) AS shares FROM ratio GROUP BY video_id, id)
SELECT t.video_id, t.id, '<div style="color:' || CASE dominant_type WHEN 'dialogue' THEN '#58a6ff' WHEN 'bgm' THEN '#3fb950' WHEN 'sfx' THEN '#d29922' ELSE '#8b949e' END || '"><div class="card ' || dominant_type || '"><b>#' || t.id || ' '
|| CASE dominant_type WHEN 'dialogue' THEN '💬' WHEN 'bgm' THEN '🎵' WHEN 'sfx' THEN '🔊' ELSE '🔀' END || '</b><p>' || shares || '</p></div></div>' AS card FROM typed t JOIN shares s ON s.video_id = t.video_id AND s.id = t.id""")
def audio_cards(spark, d):
    """The profile's maps of a shot's stems, as rounded there, and the card of the sound report from them."""
    from framewright.sources.contracts import profile_rows
    from framewright.sources.reports import audio_card

    e = energy.stem_ratios(energy.interval_rms(shots(spark, d), samples(spark, d), "video_id", "t", width=DAY), "video_id")
    maps = profile_rows(e.withColumn("centroid", F.lit(0.0)), "video_id")
    w = energy.wide_ratios(e, "video_id")
    held = maps.join(w, ["video_id", "id"])
    kind = energy.dominant_type(F.col("vocals"), F.col("drums"), F.col("bass"), F.col("other"))
    return held.select("video_id", "id", audio_card(F.col("id"), kind, F.col("ratios"), F.lit(None).cast("string")).alias("card"))


@query(f"""WITH rows_ AS ({ORACLE["dialogue_alignment"]}), places AS ({LAID} SELECT video_id, id, y_start, h FROM lay)
SELECT r.video_id, r.id, '<div id="srow-' || r.id || '" style="top:' || CAST(round(round(y_start, 4)) AS BIGINT) || 'px;height:' || CAST(round(round(h, 4)) AS BIGINT) || 'px">'
|| CASE type WHEN 'dialogue' THEN '💬' WHEN 'bgm' THEN '🎵' WHEN 'sfx' THEN '🔊' WHEN 'mixed' THEN '🔀' ELSE '❓' END || ' ' || {escaped("substring(dialogue, 1, 200)")} || '</div>' AS row_html
FROM rows_ r JOIN places p ON p.video_id = r.video_id AND p.id = r.id""")
def timeline_report(spark, d):
    from framewright.sources.reports import timeline_row

    held = dialogue_alignment(spark, d).join(laid(spark, d).select("video_id", "id", "y_start", "h"), ["video_id", "id"])
    page = timeline_row(F.col("id"), F.round("y_start", 4), F.round("h", 4), F.col("type"), F.col("dialogue"))
    return held.select("video_id", "id", page.alias("row_html"))


@query("""SELECT 'shot_' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(3, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') || '_first.jpg' AS name, octet_length(encode(text)) AS bytes, md5(text) AS content_md5 FROM documents WHERE text IS NOT NULL""")
def frame_cache_files(spark, d):
    """Texts as data URLs of a frame cache, and the files that come out of it."""
    from framewright.sources.reports import frame_files

    cache = table(spark, d, "documents").select(F.col("doc_id").alias("id"), txt.data_url(F.encode("text", "UTF-8")).alias("first_frame"), F.lit("").alias("last_frame"))
    return frame_files(cache).select("name", F.octet_length("content").cast("long").alias("bytes"), F.md5("content").alias("content_md5"))
