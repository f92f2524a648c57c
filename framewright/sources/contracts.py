"""Readers and writers of the JSON contracts: declared schemas, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHOT = "id INT, start_sec DOUBLE, end_sec DOUBLE, duration DOUBLE"
PROFILE = (
    "episode STRING, duration DOUBLE, stems ARRAY<STRING>, type_distribution MAP<STRING,BIGINT>, shots ARRAY<STRUCT<shot_id:INT,start_sec:DOUBLE,end_sec:DOUBLE,duration:DOUBLE,"
    "energies:MAP<STRING,DOUBLE>,ratios:MAP<STRING,DOUBLE>,spectral_centroid:MAP<STRING,DOUBLE>,dominant_type:STRING,dialogue:ARRAY<STRUCT<start:DOUBLE,end:DOUBLE,text:STRING>>>>"
)
TRANSCRIPT = "backend STRING, model STRING, language STRING, duration DOUBLE, source STRING, text STRING, segments ARRAY<STRUCT<start:DOUBLE,end:DOUBLE,text:STRING>>"
FRAMES = "id INT, first_frame STRING, last_frame STRING"
PART = "shot_id INT, subject STRING, action STRING, camera STRING, scene STRING, lighting STRING, style STRING, prompt_text STRING"
PROMPT = PART + ", start_sec DOUBLE, end_sec DOUBLE, duration DOUBLE"
WAVEFORM = "vocals ARRAY<INT>, drums ARRAY<INT>, other ARRAY<INT>"


def _json(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """One JSON document a file or, as the writers below leave rows, one a line."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def video_of(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def read_shots(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Shots of one array a file, which is named after its video, or the lines of write_shots, which name it themselves."""
    if lines:
        return _json(spark, path, SHOT + ", video_id STRING", True)
    return _json(spark, path, SHOT).withColumn("video_id", video_of(F.col("_metadata.file_path")))


def read_profile(spark: SparkSession, path: str | None) -> DataFrame:
    """One row per shot of the audio profile; no rows without one."""
    held = _json(spark, path, PROFILE) if path else spark.createDataFrame([], PROFILE)
    return held.select("episode", F.explode("shots").alias("s")).select("episode", "s.*")


def read_segments(spark: SparkSession, path: str | None) -> DataFrame:
    """video_id (of the file's name), seg_no, start, end, text of transcripts; a missing start counts as 0, missing segments as none."""
    held = _json(spark, path, TRANSCRIPT) if path else spark.createDataFrame([], TRANSCRIPT)
    video = video_of(F.col("_metadata.file_path")) if path else F.lit(None).cast("string")
    rows = held.select(video.alias("video_id"), F.posexplode(F.coalesce("segments", F.array())).alias("seg_no", "s"))
    return rows.select("video_id", "seg_no", F.coalesce("s.start", F.lit(0.0)).alias("start"), F.col("s.end").alias("end"), F.coalesce("s.text", F.lit("")).alias("text"))


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, FRAMES)


def read_prompts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return _json(spark, path, PROMPT, lines)


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt parts of part_*.json files with the file's name and the place in it, by which later ones win."""
    held = spark.read.option("pathGlobFilter", "part_*.json").text(folder, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), "value")
    rows = held.select("file", F.posexplode(F.from_json("value", f"ARRAY<STRUCT<{PART.replace(' INT', ':INT').replace(' STRING', ':STRING')}>>")).alias("pos", "p"))
    return rows.select("p.*", "file", "pos")


def read_waveform(spark: SparkSession, path: str) -> DataFrame:
    """A stored waveform as stem, bucket, pct."""
    held = _json(spark, path, WAVEFORM)
    parts = [held.select(F.lit(s).alias("stem"), F.posexplode(F.coalesce(s, F.array())).alias("bucket", "pct")) for s in ("vocals", "drums", "other")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def write_shots(shots: DataFrame, path: str) -> None:
    """Shots without their frames; a new folder each time, as the input may be read from the old one."""
    shots.drop("first_frame", "last_frame").write.json(path)


def write_transcript(segments: DataFrame, header: dict[str, str], path: str) -> None:
    """One JSON document of a transcript: header fields, the segments in order and their joined text."""
    held = F.array_sort(F.collect_list(F.struct("start", "end", "text")))
    text = F.array_join(F.transform(held, lambda s: s["text"]), " ")
    segments.agg(*[F.lit(v).alias(k) for k, v in header.items()], F.max("end").alias("duration"), held.alias("segments"), text.alias("text")).write.json(path)


def write_frames(cache: DataFrame, path: str) -> None:
    """The frame cache as Parquet, a folder for each video."""
    cache.write.partitionBy("video_id").parquet(path)


def write_prompts(prompts: DataFrame, path: str) -> None:
    prompts.write.option("ignoreNullFields", False).json(path)


def profile_documents(shots: DataFrame, profile: DataFrame, segments: DataFrame, stems: list[str]) -> DataFrame:
    """The audio profile, one row a video, for write_profile: shots (video_id, id, start, end) with their maps and dominant_type of
    `profile` (video_id, id) and the dialogue of `segments` (video_id, id, start, end, text).

    A video lasts to the end of its last shot; its types are counted, the most frequent first. Shots without a profile are mixed
    and have no maps; shots without segments have no dialogue. A row holds one video's shots.
    """
    key = ["video_id", "id"]
    said = segments.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "end", "text"))).alias("dialogue"))
    held = shots.select(*key, "start", "end").join(profile.select(*key, "energies", "ratios", "spectral_centroid", "dominant_type"), key, "left").join(said, key, "left")
    rows = held.withColumn("dominant_type", F.coalesce("dominant_type", F.lit("mixed"))).withColumn("duration", F.col("end") - F.col("start"))
    counts = rows.groupBy("video_id", "dominant_type").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("place"), F.col("dominant_type").alias("key"), F.col("n").alias("value"))))
    types = counts.groupBy("video_id").agg(F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["key"], e["value"]))).alias("type_distribution"))
    dialogue = F.coalesce("dialogue", F.array().cast("array<struct<start:double,end:double,text:string>>"))
    shot = F.struct(
        F.col("id").cast("int").alias("shot_id"), F.col("start").alias("start_sec"), F.col("end").alias("end_sec"), "duration", "energies", "ratios", "spectral_centroid", "dominant_type", dialogue.alias("dialogue")
    )
    # maps have no order, so that rows are sorted by a struct of the number and the rest is carried beside it
    listed = F.transform(F.array_sort(F.collect_list(F.struct("id", F.to_json(shot).alias("shot")))), lambda s: s["shot"])
    videos = rows.groupBy("video_id").agg(F.max_by("end", "id").alias("duration"), listed.alias("shots")).join(types, "video_id")
    kind = PROFILE.partition("shots ")[2]
    return videos.select(
        F.col("video_id").cast("string").alias("episode"), F.col("duration").cast("double").alias("duration"), F.array(*[F.lit(s) for s in stems]).alias("stems"), "type_distribution",
        F.from_json(F.concat(F.lit("["), F.array_join("shots", ","), F.lit("]")), kind).alias("shots"),
    )


def write_profile(documents: DataFrame, path: str) -> None:
    """Each video's profile as a document in a file and folder of its own, which read_profile reads again."""
    documents.write.partitionBy("episode").json(path)


def profile_rows(energies: DataFrame, key: str) -> DataFrame:
    """Fold long energies (key, id, stem, energy, ratio, centroid) into the profile's maps, rounded as it stores them."""
    entry = lambda c, n: F.map_from_entries(F.array_sort(F.collect_list(F.struct("stem", F.round(c, n).alias("v")))))
    return energies.groupBy(key, "id").agg(entry("energy", 4).alias("energies"), entry("ratio", 4).alias("ratios"), entry("centroid", 1).alias("spectral_centroid"))
