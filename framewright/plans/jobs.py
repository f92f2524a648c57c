"""The jobs behind the command line: sound profiles, merged prompts, pages, and the pipeline of them all.

Shots are (video_id, id, start, end) in seconds. Each job gives a DataFrame over all videos at once; a page or a profile is one row a video.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.shots import first_filled
from framewright.functions.text import strip
from framewright.operators import documents, energy, intervals, layout
from framewright.plans.detect import SECOND, Settings, detect_shots
from framewright.plans.manifest import Pipeline, Step
from framewright.plans.timeline import timeline_rows
from framewright.sources import contracts, media, reports
from framewright.storage import kept

#: Seconds to a cell of the interval joins.
CELL = 60.0
SEGMENTS = "video_id string, seg_no int, start double, end double, text string"
DETECTORS = ("psd", "coarse", "fine", "slow", "frames", "durations")


def read_shots(spark: SparkSession, path: str) -> DataFrame:
    """Shots of JSON arrays (paths that end in .json), or of the table that `detect` writes, whose times are microseconds."""
    if path.endswith(".json"):
        return contracts.read_shots(spark, path).select("video_id", "id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    return in_seconds(spark.read.parquet(path))


def in_seconds(shots: DataFrame) -> DataFrame:
    return shots.select(F.col("video_id").cast("string").alias("video_id"), F.col("id").cast("int").alias("id"), *[(F.col(c) / SECOND).alias(c) for c in ("start", "end")])


def read_segments(spark: SparkSession, path: str | None) -> DataFrame:
    """Segments of transcripts <video>.json, or of a table (video_id, seg_no, start, end, text); none without a path."""
    if not path:
        return spark.createDataFrame([], SEGMENTS)
    held = contracts.read_segments(spark, path) if path.endswith(".json") else spark.read.parquet(path)
    return held.select(F.col("video_id").cast("string").alias("video_id"), "seg_no", "start", F.coalesce("end", "start").alias("end"), strip(F.col("text")).alias("text"))


def read_stems(spark: SparkSession, folder: str) -> DataFrame:
    """video_id, stem, number, rate, amplitude of the files <folder>/<video>/<stem>.wav."""
    place = F.split("path", "/")
    held = media.samples_of(media.read_wav(spark, f"{folder.rstrip('/')}/*"))
    return held.select(F.element_at(place, -2).alias("video_id"), contracts.video_of(F.col("path")).alias("stem"), "number", "rate", "amplitude")


def stem_names(spark: SparkSession, folder: str) -> list[str]:
    """The known stems that some video below the folder has, in their order; fails where there are none. Reads names only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(f"{folder.rstrip('/')}/*")
    there = {r[0] for r in files.select(contracts.video_of(F.col("path")).alias("s")).where(F.col("s").isin(*energy.STEMS)).distinct().collect()}
    if not there:
        raise FileNotFoundError(f"no stems below {folder}")
    return [s for s in energy.STEMS if s in there]


def sound_profiles(shots: DataFrame, samples: DataFrame, segments: DataFrame, stems: list[str]) -> DataFrame:
    """The profile document of each video from its stems (video_id, stem, number, rate, amplitude).

    A shot has the samples int(start * rate) .. int(end * rate) - 1, which are those whose own end (number + 1) / rate lies in
    (start, end]. The join is open on the right, so that both sides are negated.
    """
    back = shots.select("video_id", "id", (-F.col("end")).alias("start"), (-F.col("start")).alias("end"))
    timed = samples.where(F.col("stem").isin(*stems)).withColumn("t", -(F.col("number") + 1) / F.col("rate"))
    heard = intervals.point_in_interval(timed, back, "video_id", "t", CELL)
    measured = heard.groupBy("video_id", "id", "stem").agg(energy.rms(F.col("amplitude")).alias("energy"))
    placed = heard.withColumn("place", F.col("number") - F.floor(-F.col("end") * F.col("rate")))
    centroids = energy.spectral_centroid(placed, ["video_id", "id", "stem"], "place", "rate")
    dense = shots.select("video_id", "id", F.explode(F.array(*[F.lit(s) for s in stems])).alias("stem"))
    key = ["video_id", "id", "stem"]
    filled = dense.join(measured, key, "left").join(centroids, key, "left").select(*key, F.coalesce("energy", F.lit(0.0)).alias("energy"), F.coalesce("centroid", F.lit(0.0)).alias("centroid"))
    shares = kept(energy.stem_ratios(filled, "video_id"), "job-stems")
    kinds = energy.wide_ratios(shares, "video_id").select("video_id", "id", energy.dominant_type(*[F.col(s) for s in energy.STEMS]).alias("dominant_type"))
    profile = contracts.profile_rows(shares, "video_id").join(kinds, ["video_id", "id"])
    said = intervals.point_in_interval(segments.withColumnsRenamed({"start": "t", "end": "until"}), shots, "video_id", "t", CELL, ["seg_no"])
    return contracts.profile_documents(shots, profile, said.select("video_id", "id", F.col("t").alias("start"), F.col("until").alias("end"), "text"), stems)


def merged_prompts(parts: DataFrame, shots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The prompts of one video's shots from parts (of which the last wins), and what is odd about them (kind, shot_id, field). Fails where a shot has no prompt."""
    roster = shots.select(F.col("id").alias("shot_id"), F.col("start").alias("start_sec"), F.col("end").alias("end_sec"), (F.col("end") - F.col("start")).alias("duration"))
    found = documents.last_wins(parts, "shot_id", "file", "pos")
    documents.require_complete(roster, found, "shot_id")
    extra = documents.extra_ids(roster, found, "shot_id").select(F.lit("extra").alias("kind"), "shot_id", F.lit(None).cast("string").alias("field"))
    again = found.where("n_rows > 1").select(F.lit("duplicate").alias("kind"), "shot_id", F.lit(None).cast("string").alias("field"))
    empty = documents.empty_fields(found, "shot_id").select(F.lit("empty").alias("kind"), "shot_id", "field")
    timed = documents.with_times(found, roster, "shot_id", ["start_sec", "end_sec", "duration"])
    filled = timed.select("shot_id", "start_sec", "end_sec", "duration", *[F.coalesce(f, F.lit("")).alias(f) for f in documents.REQUIRED])
    return filled, extra.unionByName(again).unionByName(empty)


def shot_pages(shots: DataFrame, title: str, older: str | None = None) -> DataFrame:
    """video_id, name, content of the pages of shot cards."""
    length = F.col("end") - F.col("start")
    body = reports.shot_card(F.col("id"), F.col("start"), F.col("end"), layout.duration_class(length))
    return reports.pages(shots, "video_id", title, body, ["id"], F.struct("id", "start", "end"), older)


def profile_shots(profiles: DataFrame) -> DataFrame:
    """The shots of profile documents with their video_id and id."""
    return profiles.select(F.col("episode").alias("video_id"), F.explode("shots").alias("s")).select("video_id", F.col("s.shot_id").alias("id"), "s.*")


def audio_pages(profiles: DataFrame, title: str, older: str | None = None) -> DataFrame:
    said = F.array_join(F.transform("dialogue", lambda d: F.coalesce(d["text"], F.lit(""))), " ")
    body = reports.audio_card(F.col("id"), F.col("dominant_type"), F.coalesce("ratios", F.create_map().cast("map<string,double>")), said)
    return reports.pages(profile_shots(profiles), "video_id", title, body, ["id"], F.struct("id", "dominant_type"), older)


def timeline(shots: DataFrame, profiles: DataFrame | None, segments: DataFrame | None, frames: DataFrame | None) -> DataFrame:
    """The rows of the timeline: times of two digits, frames, type and dialogue (the profile's own, where it has some), and the place of each row."""
    spark = shots.sparkSession
    profile = profile_shots(profiles) if profiles is not None else spark.createDataFrame([], "video_id string, id int, dominant_type string, dialogue array<struct<text:string>>")
    cached = frames if frames is not None else spark.createDataFrame([], "video_id string, id int, first_frame string, last_frame string")
    spoken = (segments if segments is not None else spark.createDataFrame([], SEGMENTS)).select("video_id", F.col("start").alias("t"), F.col("seg_no").alias("event_id"), "text")
    rows = timeline_rows(shots, spoken, profile, cached, width=CELL)
    none = F.array().cast("array<string>")
    own = profile.select("video_id", "id", first_filled(F.transform("dialogue", lambda d: F.coalesce(d["text"], F.lit(""))), none).alias("own"))
    rows = rows.join(own, ["video_id", "id"], "left").withColumn("dialogue", F.when(F.size("own") > 0, F.array_join("own", " ")).otherwise(F.col("dialogue"))).drop("own")
    placed = layout.offsets(rows, "video_id", F.col("dur"))
    return placed.withColumns({c: F.round(c, 2) for c in ("start", "end", "dur")})


def timeline_pages(rows: DataFrame, title: str, older: str | None = None) -> DataFrame:
    body = reports.timeline_row(F.col("id"), F.col("y_start"), F.col("h"), F.col("type"), F.col("dialogue"))
    return reports.pages(rows, "video_id", title, body, ["id"], F.struct("id", "start", "end", "dur", "ff", "lf", "type", "dialogue"), older)


def prompt_pages(prompts: DataFrame, title: str, older: str | None = None) -> DataFrame:
    """The page of one video's prompts."""
    fields = {f: F.col(f) for f in documents.REQUIRED if f != "prompt_text"}
    body = reports.prompt_card(F.col("shot_id"), F.col("start_sec"), F.col("end_sec"), fields, F.lit(""), F.col("prompt_text"))
    return reports.pages(prompts.withColumn("video_id", F.lit("prompts")), "video_id", title, body, ["shot_id"], F.struct("shot_id", "prompt_text"), older)


def folder_version(spark: SparkSession, path: str) -> str:
    """What stands in a folder, by names, sizes and times of its files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    seen = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0))).first()
    return f"{seen[0]}:{seen[1]}"


def run_pipeline(spark: SparkSession, data: str, out: str, stems: str | None = None, transcript: str | None = None, settings: Settings = Settings(), skip: tuple[str, ...] = (), force: bool = False) -> dict[str, DataFrame | None]:
    """Shots, sound profiles and timeline rows of all videos into `out`, each made again only where its inputs changed. Steps: shots, audio, timeline."""
    sources = {n: f"{data.rstrip('/')}/{n}" for n in DETECTORS}
    inputs = {n: (folder_version(spark, p), spark.read.parquet(p)) for n, p in sources.items()} if "shots" not in skip else {}
    if stems:
        inputs["stems"] = (folder_version(spark, stems), read_stems(spark, stems))
    if transcript:
        inputs["segments"] = (folder_version(spark, transcript), read_segments(spark, transcript))
    words = lambda df: read_segments(spark, None) if df is None else df

    def sound(shots: DataFrame, samples: DataFrame, segments: DataFrame | None) -> DataFrame:
        return sound_profiles(in_seconds(shots), samples, words(segments), stem_names(spark, stems))

    steps = [Step("shots", lambda *t, **_: detect_shots(*t, settings), DETECTORS, settings={"settings": repr(settings)})]
    if stems or "audio" in skip:
        steps.append(Step("audio", sound, ("shots", "stems"), ("segments",)))
    steps.append(Step("timeline", lambda shots, profiles, segments: timeline(in_seconds(shots), profiles, segments, None), ("shots",), ("audio", "segments")))
    return Pipeline(spark, out).run(steps, inputs, skip, force)
