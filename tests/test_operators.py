"""Hand cases of the operators: every strict or inclusive comparison at equality, and folds against plain Python."""

from __future__ import annotations

import io
import json
import random
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import arrays, text
from framewright.operators import documents, energy, folds, intervals, layout, series
from framewright.plans.manifest import Pipeline, Step
from framewright.sources import contracts, media, reports


def cuts(spark, times, flags=None):
    return spark.createDataFrame([(1, t, bool(f)) for t, f in zip(times, flags or [0] * len(times))], "v int, t double, p boolean")


def times(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).orderBy(*cols).collect()]


def test_gap_dedupe(spark):
    assert times(folds.gap_dedupe(cuts(spark, [0.1, 0.3, 0.35, 0.8, 1.0, 2.0]), "v", "t", "p", 0.3), "t") == [0.1, 0.8, 2.0]
    assert times(folds.gap_dedupe(cuts(spark, [1.0, 1.2], [0, 1]), "v", "t", "p", 0.3), "t") == [1.2]
    assert times(folds.gap_dedupe(cuts(spark, [1.0, 1.2], [1, 0]), "v", "t", "p", 0.3), "t") == [1.0]


@pytest.mark.parametrize(("given", "found"), [([5000, 6000, 6900], [(4800, 7400)]), ([5000, 6000, 7000], [])])
def test_burst_zones(spark, given, found):
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(given)], "v int, t long, s int")
    assert times(folds.burst_zones(df, "v", "t", "s", 2000, 3, 200, 500), "zs", "ze") == found


def plain_merge(durations, least):
    d = list(durations)
    while len(d) > 1 and any(x < least for x in d):
        i = next(k for k, x in enumerate(d) if x < least)
        j = 1 if i == 0 else i - 1 if i == len(d) - 1 else i - 1 if d[i - 1] <= d[i + 1] else i + 1
        d[min(i, j)] += d[max(i, j)]
        del d[max(i, j)]
    return d


def test_merge_fragments(spark):
    rng = random.Random(1)
    cases = [[10, 50, 50], [30, 10, 30], [30, 10], [10]] + [[rng.randint(1, 40) for _ in range(rng.randint(1, 12))] for _ in range(20)]
    bounds = [(k, sum(c[:i])) for k, c in enumerate(cases) for i in range(len(c) + 1)]
    out = folds.merge_fragments(spark.createDataFrame(bounds, "v int, t long"), "v", "t", 12).orderBy("v", "id").collect()
    for k, c in enumerate(cases):
        assert [r["end"] - r["start"] for r in out if r["v"] == k] == plain_merge(c, 12)


def test_short_shot_is_dropped_and_leaves_a_gap(spark):
    held = intervals.boundaries_to_intervals(spark.createDataFrame([(1, t) for t in (0.0, 1.0, 1.2, 3.0)], "v int, t double"), "v", "t")
    assert times(intervals.number_intervals(held.select("v", "start", "end"), "v", F.lit(0.3)), "id", "start", "end") == [(1, 0.0, 1.0), (2, 1.2, 3.0)]


@pytest.mark.parametrize("width", [None, 7])
def test_point_in_interval_is_half_open(spark, width):
    shots = spark.createDataFrame([(1, 1, 0, 10), (1, 2, 10, 20)], "v int, id int, start long, end long")
    points = spark.createDataFrame([(1, t) for t in (0, 9, 10, 19, 20)], "v int, t long")
    assert times(intervals.point_in_interval(points, shots, "v", "t", width), "t", "id") == [(0, 1), (9, 1), (10, 2), (19, 2)]


@pytest.mark.parametrize("width", [None, 4])
def test_band_is_strict(spark, width):
    a, b = (spark.createDataFrame([(1, t) for t in ts], "v int, t long") for ts in ((1, 3, 7), (4,)))
    assert times(intervals.band(a, b, "v", "t", 3, True, width), "t") == [3]
    assert times(intervals.band(a, b, "v", "t", 3, False, width), "t") == [1, 7]


def test_as_of(spark):
    seg = spark.createDataFrame([(1, 0, 10, "a"), (1, 12, 20, "b")], "v int, start long, end long, text string")
    probes = spark.createDataFrame([(1, i, t) for i, t in enumerate((0, 9, 10, 11, 12, 20))], "v int, pid int, t long")
    assert [r["text"] for r in intervals.as_of(probes, seg, "v", "t", "pid").orderBy("t").collect()] == ["a", "a", None, None, "b", None]


def test_position_and_back(spark):
    shots = spark.createDataFrame([(1, 1, 0.0, 0.5), (1, 2, 0.5, 3.0)], "v int, id int, start double, end double")
    laid = layout.offsets(shots, "v", F.col("end") - F.col("start"))
    assert times(laid, "h") == [280.0, 990.0]
    place = laid.select("v", "start", "end", "y_start", "y_end", "total", F.lit(3.0).alias("last_end"))
    probes = spark.createDataFrame([(1, i, t) for i, t in enumerate((0.0, 0.25, 1.0, 5.0))], "v int, pid int, t double")
    y = intervals.position_of_time(probes, place, "v", "t", "pid")
    assert times(y, "y") == [0.0, 140.0, 478.0, 1270.0]
    back = intervals.time_of_position(y.select("v", "pid", "y"), place, "v", "y", "pid")
    assert times(back, "t") == [0.0, 0.25, 1.0, 3.0]


def test_classify_is_strict(spark):
    row = spark.sql("SELECT 0.5D v, 0.05D d, 0.05D b, 0.4D o")
    assert row.select(energy.dominant_type(F.col("v"), F.col("d"), F.col("b"), F.col("o"))).first()[0] == "mixed"


def test_energy_of_silence_and_of_nothing(spark):
    shots = spark.createDataFrame([(1, 1, 0, 10), (1, 2, 10, 10)], "v int, id int, start long, end long")
    samples = spark.createDataFrame([(1, 5, "vocals", 0.0)], "v int, t long, stem string, amplitude double")
    out = {(r["id"], r["stem"]): r["energy"] for r in energy.interval_rms(shots, samples, "v", "t").collect()}
    assert out[1, "vocals"] == pytest.approx(1e-5) and out[1, "drums"] == 0.0 and out[2, "vocals"] == 0.0


def test_centroid_of_a_tone(spark):
    rows = [("a", i, float(np.sin(2 * np.pi * 1000 * i / 8192))) for i in range(8192)] + [("short", i, 1.0) for i in range(10)]
    out = energy.spectral_centroid(spark.createDataFrame(rows, "k string, number int, amplitude double"), ["k"], "number", 8192)
    assert {r["k"]: r["centroid"] for r in out.collect()} == {"a": 1000.0, "short": 0.0}


def test_similarities(spark):
    row = spark.sql("SELECT array(1D, 2D, 3D) a, array(2D, 4D, 6D) b, array(1D, 1D, 1D) flat")
    out = row.select(arrays.cosine(F.col("a"), F.col("b")), arrays.pearson(F.col("a"), F.col("b")), arrays.pearson(F.col("a"), F.col("flat")), arrays.pearson(F.col("a"), F.col("flat"), 1.0)).first()
    assert out[0] == pytest.approx(1) and out[1] == pytest.approx(1) and out[2] is None and out[3] == 1.0


def test_valley_ties_count_and_sides_need_rows(spark):
    s = spark.createDataFrame([(1, i, v) for i, v in enumerate([9.0, 9.0, 9.0, 1.0, 1.0, 9.0, 9.0, 9.0])], "v int, n int, x double")
    out = series.local_valley(s, ["v"], ["n"], "x", 5.0).where("is_valley")
    assert times(out, "n") == [3, 4]


def test_documents(spark):
    parts = spark.createDataFrame([(1, "a", "part_01", 0), (1, "b", "part_02", 0), (2, "", "part_01", 1)], "shot_id int, scene string, file string, pos int")
    one = documents.last_wins(parts, "shot_id", "file", "pos")
    assert times(one, "shot_id", "scene", "n_rows") == [(1, "b", 2), (2, "", 1)]
    assert times(documents.empty_fields(one, "shot_id", ("scene",)), "shot_id", "field") == [(2, "scene")]
    roster = spark.createDataFrame([(1,), (3,)], "shot_id int")
    with pytest.raises(ValueError, match="3"):
        documents.require_complete(roster, one, "shot_id")
    assert times(documents.extra_ids(roster, one, "shot_id"), "shot_id") == [2]


def test_text_functions(spark):
    row = spark.createDataFrame([("<a&\"b'>", " \t x \n", "clips/ep01.mp4", "bytes=5-", "24000/1001", None)], "h string, s string, p string, r string, f string, e string")
    out = row.select(text.html_escape(F.col("h")), text.strip(F.col("s")), text.path_stem(F.col("p")), text.byte_range(F.col("r"), F.lit(10)), text.frame_rate(F.col("f")), text.html_escape(F.col("e")), text.frame_rate(F.col("e"))).first()
    assert out[0] == "&lt;a&amp;&quot;b&#x27;&gt;" and out[1] == "x" and out[2] == "ep01" and tuple(out[3]) == (5, 9) and out[4] == pytest.approx(23.976, abs=1e-3) and out[5] == "" and out[6] == 30.0


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "shots.json").write_text(json.dumps([{"id": 1, "start_sec": 0.0, "end_sec": 1.5, "duration": 1.5}]))
    assert times(contracts.read_shots(spark, str(tmp_path / "shots.json")), "id", "end_sec", "video_id") == [(1, 1.5, "shots")]
    (tmp_path / "parts").mkdir()
    for n, scene in (("part_01", "x"), ("part_02", "y")):
        (tmp_path / "parts" / f"{n}.json").write_text(json.dumps([{"shot_id": 1, "scene": scene}]))
    parts = contracts.read_parts(spark, str(tmp_path / "parts"))
    assert times(documents.last_wins(parts, "shot_id", "file", "pos"), "shot_id", "scene") == [(1, "y")]
    (tmp_path / "t.json").write_text(json.dumps({"language": "en", "segments": [{"end": 2.0, "text": "hi"}]}))
    assert times(contracts.read_segments(spark, str(tmp_path / "t.json")), "seg_no", "start", "text") == [(0, 0.0, "hi")]
    assert contracts.read_segments(spark, None).count() == 0 and contracts.read_profile(spark, None).count() == 0
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8)
        w.writeframes(np.array([16384, 0, -32768, -32768], "<i2").tobytes())
    assert times(media.samples_of(media.read_wav(spark, str(tmp_path))), "number", "t", "amplitude") == [(0, 0.0, 0.25), (1, 0.125, -1.0)]
    sound, folder = np.random.default_rng(2).integers(-32768, 32768, 50_001).astype("<i2"), tmp_path / "long sound"
    folder.mkdir()
    with wave.open(str(folder / "b 1.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8)
        w.writeframes(sound.tobytes())
    blocks = media.read_wav(spark, str(folder), part_bytes=30_000).orderBy("block_no").collect()
    assert [r["block_no"] for r in blocks] == list(range(7)) and np.allclose(np.concatenate([r["samples"] for r in blocks]), sound / 32768)
    (tmp_path / "frames").mkdir()
    for i in range(2):
        (tmp_path / "frames" / f"f{i:06d}.raw").write_bytes(bytes([255 * i] * 48))
    frames = media.read_frames(spark, str(tmp_path / "frames"), "v", lambda raw: np.frombuffer(raw, np.uint8).reshape(4, 4, 3))
    assert [(r["frame_no"], r["b"], r["hist"][0], r["hist"][511]) for r in frames.orderBy("frame_no").collect()] == [(0, 0.0, 1.0, 0.0), (1, 255.0, 0.0, 1.0)]


def test_reports(spark):
    rows = spark.createDataFrame([(2, "b</x"), (1, "a")], "id int, t string")
    page = reports.report(rows, "T", reports.card(F.col("id").cast("string"), F.col("t"), F.lit("c")), ["id"], F.struct("id", "t")).first()[0]
    assert page.index("<b>1</b>") < page.index("<b>2</b>") and "b&lt;/x" in page and "b<\\/x" in page
    old = spark.createDataFrame([("x; const shots = [1,\n2]; y",)], "s string").select(reports.swap_shots(F.col("s"), F.lit("[9]"))).first()[0]
    assert old == "x; const shots = [9]; y"


def test_manifest_reuses_and_rebuilds(spark, tmp_path):
    built = []

    def double(df):
        built.append(1)
        return df.select((F.col("id") * 2).alias("id"))

    p, steps = Pipeline(spark, str(tmp_path)), [Step("double", double, ("numbers",))]
    for version in ("1", "1", "2"):
        p.run(steps, {"numbers": (version, spark.range(3))})
    assert len(built) == 2
    with pytest.raises(ValueError, match="lacks"):
        p.run(steps, {})


def test_detect_runs_all_passes(spark):
    from framewright.plans.detect import SECOND, detect_shots

    t = lambda s: int(s * SECOND)
    psd = spark.createDataFrame([(1, t(0.05)), (1, t(2.0)), (1, t(6.0))], "video_id int, t long")
    hist = lambda i: [1.0, 0.0] if (i // 20) % 2 == 0 else [0.0, 1.0]
    coarse = spark.createDataFrame([(1, i, t(i / 5), hist(i)) for i in range(60)], "video_id int, frame_no long, t long, hist array<double>")
    sims = [(1, i, t(i / 30), 0.2 if i == 270 else 0.99) for i in range(360)]
    fine = spark.createDataFrame(sims, "video_id int, n long, t long, sim double")
    frames = spark.createDataFrame([(1, i, 1.0, 1.0, 1.0) for i in range(360)], "video_id int, n long, b double, g double, r double")
    durations = spark.createDataFrame([(1, t(12.0))], "video_id int, duration long")
    out = detect_shots(psd, coarse, fine, fine, frames, durations).orderBy("id").collect()
    assert [r["start"] for r in out] == [0, t(2.0), t(3.7), t(6.0), t(7.7), t(9.0)]  # a moved cut takes the first of equal similarities
    assert out[-1]["end"] == t(12.0)


def test_report_cards_and_files(spark, tmp_path):
    row = spark.sql("SELECT 1 id, 0.5D s, 2.0D e, 'sfx' kind, map('vocals', 0.25D, 'other', 0.75D) r, '<hi>' d, CAST(NULL AS DOUBLE) none")
    out = row.select(
        reports.shot_card(F.col("id"), F.col("s"), F.col("e"), F.lit("short")), reports.audio_card(F.col("id"), F.col("kind"), F.col("r"), F.col("d")),
        reports.timeline_row(F.col("id"), F.col("s"), F.col("e"), F.col("kind"), F.col("d")), reports.prompt_card(F.col("id"), F.col("none"), F.col("e"), {"scene": F.col("d")}, F.col("d"), F.col("d")),
    ).first()
    assert "#1" in out[0] and "0.5s - 2.0s" in out[0] and "short" in out[0]
    assert "#d29922" in out[1] and "other 75%, vocals 25%" in out[1] and "&lt;hi&gt;" in out[1]
    assert "srow-1" in out[2] and "🔊" in out[2]
    assert "<i>scene</i> &lt;hi&gt;" in out[3] and "<p></p>" in out[3]
    cache = spark.createDataFrame([(1, "data:image/jpeg;base64,aGk=", ""), (2, None, "data:image/png;base64,eW8=")], "id int, first_frame string, last_frame string")
    files = reports.frame_files(cache)
    assert {r["name"]: bytes(r["content"]) for r in files.collect()} == {"shot_001_first.jpg": b"hi", "shot_002_last.jpg": b"yo"}
    assert sorted(r["written"] for r in reports.write_files(files, str(tmp_path / "out")).collect()) == [True, True]
    assert sorted(r["written"] for r in reports.write_files(files, str(tmp_path / "out")).collect()) == [False, False]
    assert (tmp_path / "out" / "shot_001_first.jpg").read_bytes() == b"hi"


def test_media_table_and_writers(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(b"x")
    (tmp_path / "b.mp4").write_bytes(b"x")
    out = media.media_table(spark, str(tmp_path), lambda p: ("AV1", 2.5, "60/2") if p.endswith("a.mp4") else ("h264", None, ""))
    found = {r["path"][-5:]: (r["codec"], r["duration"], r["fps"], r["t"]) for r in out.withColumn("t", media.needs_transcode(F.col("codec"))).collect()}
    assert found == {"a.mp4": ("av1", 2.5, 30.0, True), "b.mp4": ("h264", 0.0, 30.0, False)}
    segments = spark.createDataFrame([(2.0, 3.0, "b"), (0.0, 1.0, "a")], "start double, end double, text string")
    contracts.write_transcript(segments, {"language": "en"}, str(tmp_path / "t"))
    assert times(contracts.read_segments(spark, str(tmp_path / "t")), "seg_no", "text") == [(0, "a"), (1, "b")]
    rows = spark.createDataFrame([("v", 1, "vocals", 0.123456, 0.5, 10.04), ("v", 1, "bass", 1.0, 0.5, 0.0)], "video_id string, id int, stem string, energy double, ratio double, centroid double")
    folded = contracts.profile_rows(rows, "video_id").first()
    assert folded["energies"] == {"vocals": 0.1235, "bass": 1.0} and folded["spectral_centroid"] == {"vocals": 10.0, "bass": 0.0}


def test_one_long_video(spark):
    """A video of 10^5 rows: lookups spread over cells of its axis and give what a plain scan gives."""
    n = 100_000
    probes = spark.range(n).select(F.lit(1).alias("v"), F.col("id").alias("pid"), (F.col("id") * 7 % n * 10).alias("t"))
    seg = spark.range(n // 50).select(F.lit(1).alias("v"), (F.col("id") * 500).alias("start"), (F.col("id") * 500 + 200 + F.col("id") % 7 * 40).alias("end"), F.col("id").cast("string").alias("text"))
    ends = [i * 500 + 200 + i % 7 * 40 for i in range(n // 50)]
    for width in (None, 1000):
        out = {r["t"]: r["text"] for r in intervals.as_of(probes, seg, "v", "t", "pid", width).collect()}
        for t in range(0, n * 10, 9130):
            i = next((k for k in range(max(0, t // 500 - 1), len(ends)) if ends[k] > t), None)
            assert out[t] == (str(i) if i is not None and i * 500 <= t else None)
    zones = seg.select("v", F.col("start").alias("zs"), F.col("end").alias("ze"))
    assert intervals.in_zone(probes, zones, "v", "t", True, 1000).count() == intervals.in_zone(probes, zones, "v", "t").count()
    assert intervals.in_zone(probes, zones, "v", "t", False, 1000).count() == intervals.in_zone(probes, zones, "v", "t", False).count()
    frames = spark.range(n).select(F.lit(1).alias("v"), F.col("id").alias("n"), (F.col("id") * 31 % 101 / 100).alias("x"))
    best = series.refine_argmin(frames.where("n % 10 = 0").select("v", F.col("n").alias("cand"), F.col("n").alias("at")), frames, "v", "cand", "at", "n", "x", 5).collect()
    assert len(best) == n // 10
    for r in best[::997]:
        assert r["refined"] == min(range(max(0, r["at"] - 5), min(n, r["at"] + 6)), key=lambda k: (k * 31 % 101, k))


def plain_gaps(times, gap):
    out = []
    for t, p in sorted(times):
        if not out or t - out[-1][0] > gap:
            out.append((t, p))
        elif p and not out[-1][1]:
            out[-1] = (t, p)
    return out


def test_folds_in_pieces(spark):
    rng = random.Random(3)
    cut = sorted({(rng.randint(0, 4000), rng.random() < 0.3) for _ in range(700)})
    df = spark.createDataFrame([(1, t, p) for t, p in cut], "v int, t long, p boolean")
    assert times(folds.gap_dedupe(df, "v", "t", "p", 9), "t", "p") == plain_gaps(cut, 9)
    kept = []
    for t, z in cut:
        if not kept or t - kept[-1][0] >= (4 if z else 11):
            kept.append((t, z))
    assert times(folds.zone_min_gap(df, "v", "t", "p", 4, 11), "t", "p") == sorted(kept)


def test_long_scenes_give_way_to_their_parts(spark):
    from framewright.plans.detect import refined_scenes

    scenes = spark.createDataFrame([(1, 0, 10), (1, 10, 30), (1, 30, 60), (1, 60, 64)], "video_id int, start long, end long")
    parts = spark.createDataFrame([(1, 10, 10, 30), (1, 30, 30, 41), (1, 30, 41, 43), (1, 30, 43, 60), (1, 0, 0, 5), (1, 0, 5, 10)], "video_id int, of_start long, start long, end long")
    assert times(intervals.replace_long(scenes, parts, "video_id", 10), "start", "end") == [(0, 10), (10, 30), (30, 41), (41, 43), (43, 60), (60, 64)]
    assert times(refined_scenes(scenes, parts, 10, 5), "id", "start", "end") == [(1, 0, 10), (2, 10, 30), (3, 30, 43), (4, 43, 64)]


def test_command_line(spark, tmp_path, capsys):
    from framewright.__main__ import main
    from tests.conftest import DATA

    main(["queries"])
    assert "long_shots" in capsys.readouterr().out
    main(["query", "long_shots", DATA, str(tmp_path / "out")])
    n = spark.read.parquet(str(tmp_path / "out")).count()
    assert n > 0 and f"long_shots: {n} rows" in capsys.readouterr().out
    spark.createDataFrame([(1, 0, 9_000_000)], "video_id int, start long, end long").write.parquet(str(tmp_path / "in/scenes"))
    spark.createDataFrame([(1, 0, 0, 4_000_000), (1, 0, 4_000_000, 9_000_000)], "video_id int, of_start long, start long, end long").write.parquet(str(tmp_path / "in/parts"))
    main(["detect", str(tmp_path / "in"), str(tmp_path / "shots"), "--stages", "2"])
    assert spark.read.parquet(str(tmp_path / "shots")).count() == 2


def test_lag_of_a_stream_over_several_batches(spark, tmp_path):
    from framewright.streaming.buckets import drained
    from framewright.streaming.similarity import lag_stream

    rng = np.random.default_rng(5)
    rows = [(v, n, None if n == 7 else [1.0, 1.0, 1.0] if n == 9 else rng.random(3).tolist()) for v in ("a", "b") for n in range(20)]
    rows = [r for r in rows if r[0] == "a" or r[1] < 2]  # the second video is shorter than the lag
    for part, few in enumerate((rows[:6], rows[6:8], rows[8:])):
        spark.createDataFrame(few, "v string, n long, h array<double>").coalesce(1).write.parquet(str(tmp_path / f"in/part={part}"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    found = drained(lag_stream(stream, "v", "n", "h", 3, 1.0), "append")
    theirs = series.lag_similarity(stored, ["v"], "n", "h", 3, "pearson", 1.0)
    plain = lambda df: [(r["v"], r["n"], None if r["sim"] is None else round(r["sim"], 9)) for r in df.orderBy("v", "n").collect()]
    held = dict(((v, n), h) for v, n, h in rows)
    want = plain(theirs.where("n <> 7"))
    assert len(want) > 10 and [r for r in plain(found) if r[1] != 7] == want
    assert [r for r in plain(found) if r[1] == 7] == [("a", 7, None)] and held["a", 7] is None


def test_profile_documents(spark, tmp_path):
    shots = spark.createDataFrame([("v", 2, 1.0, 3.0), ("v", 1, 0.0, 1.0), ("v", 3, 3.0, 4.5), ("w", 1, 0.0, 2.0)], "video_id string, id int, start double, end double")
    longs = spark.createDataFrame([("v", 1, "bass", 1.0, 1.0, 9.0), ("v", 2, "vocals", 0.12345, 1.0, 0.0)], "video_id string, id int, stem string, energy double, ratio double, centroid double")
    kinds = spark.createDataFrame([("v", 1, "bgm"), ("v", 2, "mixed")], "video_id string, id int, dominant_type string")
    said = spark.createDataFrame([("v", 2, 2.0, 2.5, 'b "c"'), ("v", 2, 1.0, 1.5, None)], "video_id string, id int, start double, end double, text string")
    made = contracts.profile_documents(shots, contracts.profile_rows(longs, "video_id").join(kinds, ["video_id", "id"]), said, ["vocals", "bass"])
    v = made.where("episode = 'v'").first()
    assert v["duration"] == 4.5 and v["stems"] == ["vocals", "bass"] and v["type_distribution"] == {"mixed": 2, "bgm": 1}
    assert [(s["shot_id"], s["duration"], s["dominant_type"], len(s["dialogue"])) for s in v["shots"]] == [(1, 1.0, "bgm", 0), (2, 2.0, "mixed", 2), (3, 1.5, "mixed", 0)]
    assert v["shots"][1]["energies"] == {"vocals": 0.1235} and [d["text"] for d in v["shots"][1]["dialogue"]] == [None, 'b "c"'] and v["shots"][2]["energies"] is None
    contracts.write_profile(made, str(tmp_path / "p"))
    written = [f.read_text() for f in (tmp_path / "p" / "episode=v").glob("part-*")]
    assert '"type_distribution":{"mixed":2,"bgm":1}' in written[0]  # the most frequent first
    read = contracts.read_profile(spark, str(tmp_path / "p"))
    assert times(read, "episode", "shot_id", "dominant_type") == [("v", 1, "bgm"), ("v", 2, "mixed"), ("v", 3, "mixed"), ("w", 1, "mixed")]
    assert contracts.profile_documents(shots.limit(0), contracts.profile_rows(longs, "video_id").join(kinds, ["video_id", "id"]), said, ["vocals"]).count() == 0


def test_written_rows_are_read_again(spark, tmp_path):
    rows = spark.createDataFrame([("v", 1, 0.0, 1.0, 1.0, "x"), ("v", 2, 1.0, 3.0, 2.0, None)], "video_id string, id int, start_sec double, end_sec double, duration double, first_frame string").coalesce(1)
    contracts.write_shots(rows, str(tmp_path / "s"))
    assert times(contracts.read_shots(spark, str(tmp_path / "s"), lines=True), "video_id", "id", "end_sec") == [("v", 1, 1.0), ("v", 2, 3.0)]
    prompts = spark.createDataFrame([(1, "a"), (2, None)], "shot_id int, subject string").coalesce(1)
    contracts.write_prompts(prompts, str(tmp_path / "q"))
    assert times(contracts.read_prompts(spark, str(tmp_path / "q"), lines=True), "shot_id", "subject") == [(1, "a"), (2, None)]
