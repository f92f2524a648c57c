from __future__ import annotations

import json
import logging
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.__main__ import main
from framewright.functions.arrays import colour_bin
from framewright.operators import layout, series
from framewright.plans import jobs
from framewright.plans.detect import SECOND, detector_shots
from framewright.sources import contracts, media, reports

RATE = 1000
SHOTS = [(1, 0.0, 1.2345), (2, 1.2345, 3.0), (3, 3.0, 9.0)]


@pytest.fixture(scope="module")
def work(tmp_path_factory):
    """Two videos: shots, stems (the second has one only), a transcript of the first and prompts."""
    folder = tmp_path_factory.mktemp("work")
    rng = np.random.default_rng(8)
    (folder / "shots").mkdir(), (folder / "said").mkdir(), (folder / "parts").mkdir()
    for video, stems in (("ep1", ("vocals", "drums", "other")), ("ep2", ("vocals",))):
        (folder / "shots" / f"{video}.json").write_text(json.dumps([{"id": i, "start_sec": a, "end_sec": b, "duration": b - a} for i, a, b in SHOTS]))
        (folder / "stems" / video).mkdir(parents=True)
        for stem in stems:
            sound = rng.integers(-20000, 20000, 5 * RATE).astype("<i2")
            np.save(folder / f"{video}-{stem}.npy", sound)
            with wave.open(str(folder / "stems" / video / f"{stem}.wav"), "wb") as w:
                w.setnchannels(1), w.setsampwidth(2), w.setframerate(RATE)
                w.writeframes(sound.tobytes())
    segments = [{"start": 0.5, "end": 1.0, "text": " one "}, {"start": 1.2345, "end": 2.0, "text": "two"}, {"start": 1.5, "end": 2.0, "text": "<three>"}, {"start": 9.0, "end": 9.5, "text": "late"}]
    (folder / "said" / "ep1.json").write_text(json.dumps({"segments": segments}))
    (folder / "parts" / "part_1.json").write_text(json.dumps([{"shot_id": i, "scene": "x", "prompt_text": f"p{i}"} for i in (1, 2, 3, 7)]))
    (folder / "parts" / "part_2.json").write_text(json.dumps([{"shot_id": 2, "scene": "y", "prompt_text": "q2"}], indent=2))
    return folder


def plain_profile(folder, video):
    """energies and centroids of each shot by slices of whole arrays."""
    out = {}
    for i, start, end in SHOTS:
        for stem in ("vocals", "drums", "bass", "other"):
            path = folder / f"{video}-{stem}.npy"
            x = np.load(path).astype(np.float32) / 32768 if path.exists() else np.zeros(0, np.float32)
            x = x[min(int(start * RATE), len(x)) : min(int(end * RATE), len(x))].astype(np.float64)
            size = np.abs(np.fft.rfft(x[:8192], n=8192)) if len(x[:8192]) >= 256 else np.zeros(1)
            centroid = round(float((np.fft.rfftfreq(8192, 1 / RATE) * size).sum() / size.sum()), 1) if size.sum() >= 1e-10 else 0.0
            out[i, stem] = (round(float(np.sqrt((x**2).mean() + 1e-10)), 4) if len(x) else 0.0, centroid)
    return out


def test_sound_profiles(spark, work, tmp_path):
    main(["audio", str(work / "stems"), "--shots", f"{work}/shots/*.json", "--transcript", f"{work}/said/*.json", str(tmp_path / "p")])
    rows = {(r["episode"], r["shot_id"]): r for r in contracts.read_profile(spark, str(tmp_path / "p")).collect()}
    assert sorted(rows) == [(v, i) for v in ("ep1", "ep2") for i, *_ in SHOTS]
    for video in ("ep1", "ep2"):
        for (i, stem), (energy, centroid) in plain_profile(work, video).items():
            if stem != "bass":
                got = rows[video, i]
                assert got["energies"][stem] == pytest.approx(energy, abs=1.01e-4) and got["spectral_centroid"][stem] == pytest.approx(centroid, abs=0.11)
    assert all("bass" not in r["energies"] for r in rows.values()) and rows["ep2", 1]["dominant_type"] == "dialogue"
    assert [d["text"] for d in rows["ep1", 2]["dialogue"]] == ["two", "<three>"] and rows["ep2", 2]["dialogue"] == []
    with pytest.raises(FileNotFoundError):
        jobs.stem_names(spark, str(work / "shots"))


def test_prompts_are_merged(spark, work, tmp_path, caplog):
    with caplog.at_level(logging.WARNING, "framewright"):
        main(["prompts", str(work / "parts"), "--shots", f"{work}/shots/ep1.json", str(tmp_path / "q")])
    assert "extra: shot 7" in caplog.text and "duplicate: shot 2" in caplog.text and "empty: shot 1 subject" in caplog.text
    rows = {r["shot_id"]: r for r in contracts.read_prompts(spark, str(tmp_path / "q"), lines=True).collect()}
    assert rows[2]["scene"] == "y" and rows[2]["start_sec"] == 1.2345 and rows[2]["subject"] == "" and rows[7]["start_sec"] is None and len(rows) == 4
    more = spark.createDataFrame([("v", 9, 0.0, 1.0)], "video_id string, id int, start double, end double")
    with pytest.raises(ValueError, match="no document"):
        jobs.merged_prompts(contracts.read_parts(spark, str(work / "parts")), more)
    main(["page", "prompts", "--prompts", str(tmp_path / "q"), str(tmp_path / "pages")])
    assert "<pre>q2</pre>" in (tmp_path / "pages" / "prompts.html").read_text()


def test_pages(spark, work, tmp_path):
    (tmp_path / "old.html").write_text("<html><style>b{}</style><script>const shots = [1,\n2]; play();</script></html>")
    main(["page", "shots", "--shots", f"{work}/shots/*.json", "--older", str(tmp_path / "old.html"), str(tmp_path / "a")])
    page = (tmp_path / "a" / "ep2.html").read_text()
    assert "<style>b{}</style>" in page and 'const shots = [{"id":1' in page and "play();" in page and "[1," not in page and page.index("#1") < page.index("#2")
    main(["page", "timeline", "--shots", f"{work}/shots/*.json", "--transcript", f"{work}/said/*.json", "--title", "T", str(tmp_path / "b")])
    page = (tmp_path / "b" / "ep1.html").read_text()
    assert "<title>T ep1</title>" in page and "two &lt;three&gt;" in page and "late" not in page and '"dur":1.23' in page
    main(["audio", str(work / "stems"), "--shots", f"{work}/shots/*.json", str(tmp_path / "p")])
    main(["page", "audio", "--profiles", str(tmp_path / "p"), str(tmp_path / "c")])
    assert "vocals 100%" in (tmp_path / "c" / "ep2.html").read_text()
    with pytest.raises(SystemExit):
        main(["page", "audio", str(tmp_path / "d")])
    assert reports.pages(spark.range(0), "id", "x", F.lit(""), ["id"]).count() == 0


def test_the_profile_s_own_dialogue_comes_first(spark):
    shots = spark.createDataFrame([("v", 1, 0.0, 1.0), ("v", 2, 1.0, 2.0)], "video_id string, id int, start double, end double")
    said = spark.createDataFrame([("v", 0, 0.1, 0.2, "heard"), ("v", 1, 1.1, 1.2, "kept")], jobs.SEGMENTS)
    kind = "episode string, shots array<struct<shot_id:int,dominant_type:string,dialogue:array<struct<text:string>>>>"
    profiles = spark.createDataFrame([("v", [(1, "sfx", [("own",), (None,)]), (2, None, [])])], kind)
    rows = jobs.timeline(shots, profiles, said, None).orderBy("id").collect()
    assert [(r["type"], r["dialogue"]) for r in rows] == [("sfx", "own "), ("mixed", "kept")]
    assert [(r["type"], r["dialogue"]) for r in jobs.timeline(shots, None, None, None).orderBy("id").collect()] == [("mixed", "")] * 2


def test_pipeline_makes_only_what_changed(spark, work, tmp_path, caplog):
    data, t = tmp_path / "in", lambda s: int(s * SECOND)
    tables = {
        "psd": ([("ep1", t(2.0)), ("ep1", t(6.0))], "video_id string, t long"), "durations": ([("ep1", t(9.0))], "video_id string, duration long"),
        "coarse": ([("ep1", i, t(i / 5), [1.0, 0.0]) for i in range(45)], "video_id string, frame_no long, t long, hist array<double>"),
        "fine": ([("ep1", i, t(i / 30), 0.99) for i in range(270)], "video_id string, n long, t long, sim double"),
        "slow": ([("ep1", i, t(i / 30), 0.99) for i in range(270)], "video_id string, n long, t long, sim double"),
        "frames": ([("ep1", i, 1.0, 1.0, 1.0) for i in range(270)], "video_id string, n long, b double, g double, r double"),
    }
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(data / name))
    call = ["pipeline", str(data), str(tmp_path / "out"), "--stems", str(work / "stems"), "--transcript", f"{work}/said/*.json"]
    with caplog.at_level(logging.INFO, "framewright"):
        main(call)
    assert "detect-final: 2 rows" in caplog.text  # every pass says how many rows it had
    log = lambda: sorted(p.name for p in (tmp_path / "out" / "_log").glob("*.json"))
    assert len(log()) == 3
    main(call)
    assert len(log()) == 3
    main([*call, "--coarse", "0.8"])  # other thresholds: all steps after the shots are made again
    assert len(log()) == 6
    held = jobs.run_pipeline(spark, str(data), str(tmp_path / "out"), skip=("shots", "audio"))
    assert [r["start"] for r in held["timeline"].orderBy("id").collect()] == [0.0, 2.0, 6.0] and held["audio"].count() == 1
    assert [r["dialogue"] for r in held["timeline"].orderBy("id").collect()] == ["one two <three>", "", ""]


def test_detection_in_one_stage(spark, tmp_path):
    spark.createDataFrame([(1, 2_000_000), (1, 2_000_000), (1, 2_100_000)], "video_id int, t long").write.parquet(str(tmp_path / "in/psd"))
    spark.createDataFrame([(1, 5_000_000), (2, 1_000_000)], "video_id int, duration long").write.parquet(str(tmp_path / "in/durations"))
    main(["detect", str(tmp_path / "in"), str(tmp_path / "out"), "--stages", "1"])
    rows = [(r["video_id"], r["id"], r["start"], r["end"]) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("video_id", "id").collect()]
    assert rows == [(1, 1, 0, 2_000_000), (1, 2, 2_000_000, 2_100_000), (1, 3, 2_100_000, 5_000_000), (2, 1, 0, 1_000_000)]
    assert detector_shots(*[spark.read.parquet(str(tmp_path / "in" / n)).limit(0) for n in ("psd", "durations")]).count() == 0


def test_transcript_job(spark, tmp_path):
    spark.createDataFrame([(1.0, 2.0, "b"), (0.0, 1.0, "a")], "start double, end double, text string").write.parquet(str(tmp_path / "in"))
    main(["transcript", str(tmp_path / "in"), "--language", "en", str(tmp_path / "t")])
    held = spark.read.json(str(tmp_path / "t")).first()
    assert (held["language"], held["text"], held["duration"], len(held["segments"])) == ("en", "a b", 2.0, 2)


def test_bars_are_cut_at_tiles(spark):
    rng = np.random.default_rng(1)
    rows = [("v", i, float(y), float(h), 250.5) for i, (y, h) in enumerate(zip(rng.integers(0, 2500, 300) / 10, rng.integers(1, 300, 300) / 10, strict=True))] + [("v", 300, 100.0, 5.0, 250.5), ("v", 301, 99.0, 5.0, 250.5), ("v", 302, 250.5, 1.0, 250.5), ("w", 0, 0.0, 1.0, 0.0)]
    bars = spark.createDataFrame(rows, "video string, i int, y double, bar_h double, total double")
    got = sorted((r["i"], r["tile"], round(r["y_in"], 6), round(r["drawn"], 6)) for r in layout.bar_tiles(bars, "video", "y", "total", 100).collect())
    want = []
    for _, i, y, h, total in rows:
        for k in range(int(np.ceil(total / 100))):
            top, tall = k * 100, min(100.0, total - k * 100)
            if not (y + 1 < top or y > top + tall):
                want.append((i, k, round(y - top, 6), round(max(0.0, min(np.floor(tall), y - top + h) - max(0.0, y - top)), 6)))
    assert got == sorted(want)


def test_histogram_in_tables_is_that_of_images(spark):
    pixels = np.random.default_rng(4).integers(0, 256, (500, 3))
    rows = spark.createDataFrame([(1, *map(int, p)) for p in pixels], "f int, r int, g int, b int")
    found = series.histogram_shares(rows, ["f"], colour_bin(F.col("r"), F.col("g"), F.col("b"))).collect()
    image = media.histogram(pixels)
    assert len(found) == (image > 0).sum() and all(image[r["bin"]] == pytest.approx(r["share"], abs=1e-6) for r in found)
