"""Seekable frames, the committing sink, plug-ins in SQL, and racing runs of a pipeline."""

from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.plans.detect import refined_scenes
from framewright.plans.manifest import Pipeline, Step, put_if_absent
from framewright.sources import files, frames, plugins
from tests.test_scale import tuples


def write_y4m(path, n, width=6, height=5, colour="420jpeg", down=(2, 2), fps="30:1"):
    """n frames; frame k has the luma 16 + k all over."""
    chroma = bytes([128]) * (2 * -(-width // down[0]) * -(-height // down[1]))
    path.write_bytes(f"YUV4MPEG2 W{width} H{height} F{fps} Ip C{colour}\n".encode() + b"".join(b"FRAME\n" + bytes([16 + k]) * (width * height) + chroma for k in range(n)))


@pytest.fixture(scope="module")
def clips(tmp_path_factory):
    folder = tmp_path_factory.mktemp("clips")
    write_y4m(folder / "a.y4m", 100)
    write_y4m(folder / "b.y4m", 40, 8, 4, "444", (1, 1), "25:1")
    return str(folder)


def test_frames_are_read(spark, clips):
    out = frames.read_video(spark, clips, 1000)
    held = {(r["video_id"], r["frame_no"]): r for r in out.collect()}
    assert len(held) == 140 and held["b", 30]["t"] == pytest.approx(30 / 25) and held["a", 3]["t"] == pytest.approx(0.1)
    assert held["a", 50]["r"] == pytest.approx(round(1.164 * 50)) and sum(held["a", 50]["hist"]) == pytest.approx(1)


@pytest.mark.parametrize("where,want", [("frame_no BETWEEN 10 AND 12", [("a", n) for n in (10, 11, 12)] + [("b", n) for n in (10, 11, 12)]), ("video_id = 'b' AND t > 1.5", [("b", 38), ("b", 39)]), ("frame_no IN (3, 99)", [("a", 3), ("a", 99), ("b", 3)]), ("frame_no > 200", [])])
def test_filters_become_seeks(spark, clips, where, want):
    assert tuples(frames.read_video(spark, clips).where(where), "video_id", "frame_no") == want


def test_a_filter_plans_only_its_ranges(clips):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    def planned(*filters):
        reader = frames.FrameReader({"path": clips, "partBytes": "200"})
        assert list(reader.pushFilters(list(filters))) == list(filters)  # rows are still checked
        return reader, [(p.clip.video_id, p.first, p.end) for p in reader.partitions()]

    _, all_ = planned()
    assert len(all_) > 30 and sum(b - a for _, a, b in all_) == 140
    reader, few = planned(EqualTo(("video_id",), "a"), GreaterThanOrEqual(("frame_no",), 20), LessThan(("frame_no",), 25))
    assert {v for v, _, _ in few} == {"a"} and sum(b - a for _, a, b in few) <= 6 and min(a for _, a, _ in few) == 20
    opened = []
    real = frames.open_input

    class Seen:
        def __init__(self, path):
            self.f = real(path)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()

        def seek(self, *at):
            return self.f.seek(*at)

        def tell(self):
            return self.f.tell()

        def read(self, n):
            opened.append((self.f.tell(), n))
            return self.f.read(n)

    frames.open_input = Seen
    try:
        parts = reader.partitions()
        opened.clear()
        rows = [r for p in parts for r in reader.read(p)]
    finally:
        frames.open_input = real
    size = parts[0].clip.size + 6
    assert [r[1] for r in rows][:5] == [20, 21, 22, 23, 24] and min(at for at, _ in opened) == parts[0].clip.start + 20 * size and sum(n for _, n in opened) <= 6 * size


def test_frames_that_cannot_be_sought_are_refused(tmp_path):
    (tmp_path / "x.y4m").write_bytes(b"no video")
    write_y4m(tmp_path / "deep.y4m", 2, colour="420p10")
    for name in ("x.y4m", "deep.y4m"):
        with pytest.raises(ValueError):
            frames.read_header(str(tmp_path / name))


# Sink --------------------------------------------------------------------------------------------------------


def names(folder):
    return sorted(p.name for p in folder.iterdir() if p.is_file())


def test_files_are_committed(spark, tmp_path):
    rows = spark.createDataFrame([(f"f{i}", bytes([i])) for i in range(20)] + [("f1", b"\1"), ("none", None)], "name string, content binary").repartition(4)
    out = tmp_path / "out"
    files.save_files(rows, str(out))
    assert names(out) == sorted([f"f{i}" for i in range(20)] + ["none"]) and (out / "f7").read_bytes() == b"\7" and (out / "none").read_bytes() == b""
    files.save_files(spark.createDataFrame([("f7", b"other"), ("g", b"new")], "name string, content binary"), str(out))
    assert (out / "f7").read_bytes() == b"\7" and (out / "g").read_bytes() == b"new"
    files.save_files(spark.createDataFrame([("f7", b"other")], "name string, content binary"), str(out), overwrite=True)
    assert (out / "f7").read_bytes() == b"other" and not list((out / "_aside").iterdir())


def test_a_writer_that_dies_leaves_nothing(spark, tmp_path):
    out = tmp_path / "out"

    def dies(batches):
        for batch in batches:
            yield batch.slice(0, 1)
            raise RuntimeError("lost half way")

    rows = spark.createDataFrame([(f"f{i}", b"x" * 1000) for i in range(50)], "name string, content binary").repartition(3)
    with pytest.raises(Exception, match="lost half way"):
        files.save_files(rows.mapInArrow(dies, "name string, content binary"), str(out))
    assert not out.exists() or names(out) == []
    files.save_files(rows, str(out))
    assert len(names(out)) == 50 and all(len(p.read_bytes()) == 1000 for p in out.iterdir() if p.is_file())


def test_what_an_attempt_left_does_not_count(tmp_path):
    writer = files.FilesWriter(str(tmp_path), False)
    good = writer.write(iter([{"name": "a", "content": b"whole"}]))
    with pytest.raises(RuntimeError):
        def half():
            yield {"name": "a", "content": b"wh"}
            raise RuntimeError
        writer.write(half())
    assert names(tmp_path) == []
    writer.commit([good, None])
    assert names(tmp_path) == ["a"] and (tmp_path / "a").read_bytes() == b"whole" and not list((tmp_path / "_aside").iterdir())
    with pytest.raises(ValueError):
        writer.write(iter([{"name": "../b", "content": b""}]))


# Plug-ins ----------------------------------------------------------------------------------------------------


class Jumps:
    """Cuts where the value changes by more than 5."""

    def __init__(self):
        self.last = None

    def take(self, row):
        changed = self.last is not None and abs(row["x"] - self.last) > 5
        self.last = row["x"]
        return [row["t"]] if changed else []

    def close(self):
        return []


class Speaker:
    """A segment for each two blocks, and one for what is left."""

    def __init__(self):
        self.words = []

    def take(self, row):
        self.words.append(row["word"])
        if len(self.words) == 2:
            said, self.words = " ".join(self.words), []
            return [(row["block_no"] - 1, row["block_no"], f" {said} ")]
        return []

    def close(self):
        return [(9, 9, " "), *[(8, 9, w) for w in self.words]]


def test_plugins_in_sql(spark):
    xs = [(v, t, 0.0 if (t // k) % 2 == 0 else 9.0) for v, k in (("a", 10), ("b", 25)) for t in range(60)]
    spark.createDataFrame(xs, "video_id string, t long, x double").repartition(5).createOrReplaceTempView("plug_frames")
    plugins.register_plugins(spark, cuts_of=plugins.detector(Jumps), parts_of=plugins.ranged_detector(Jumps), speech_of=plugins.speech(Speaker))
    cuts = spark.sql("SELECT * FROM cuts_of(TABLE(plug_frames))")
    assert tuples(cuts, "video_id", "t") == [("a", t) for t in (10, 20, 30, 40, 50)] + [("b", t) for t in (25, 50)]
    scenes = spark.createDataFrame([("a", 0, 4), ("a", 4, 60), ("b", 0, 20), ("b", 20, 60)], "video_id string, start long, end long")
    scenes.where("end - start > 30").createOrReplaceTempView("plug_long")
    parts = spark.sql("SELECT * FROM parts_of(TABLE(SELECT f.video_id, l.start, l.end, f.t, f.x FROM plug_frames f JOIN plug_long l ON f.video_id = l.video_id AND f.t >= l.start AND f.t < l.end))")
    assert tuples(parts.where("video_id = 'b'"), "of_start", "start", "end") == [(20, 20, 25), (20, 25, 50), (20, 50, 60)]
    shots = refined_scenes(scenes, parts, 30, 6)
    assert tuples(shots.where("video_id = 'b'"), "id", "start", "end") == [(1, 0, 25), (2, 25, 50), (3, 50, 60)]  # 20-25 was merged
    spark.createDataFrame([("a", i, w) for i, w in enumerate("one two three".split())] + [("b", 0, "x")], "video_id string, block_no long, word string").createOrReplaceTempView("plug_blocks")
    assert tuples(spark.sql("SELECT * FROM speech_of(TABLE(plug_blocks))"), "video_id", "start", "text") == [("a", 0, "one two"), ("a", 8, "three"), ("b", 8, "x")]
    with pytest.raises(Exception, match="lacks"):
        spark.sql("SELECT * FROM cuts_of(TABLE(SELECT 1 AS video_id))").collect()


# Manifest ----------------------------------------------------------------------------------------------------


def test_only_one_puts_an_entry(spark, tmp_path):
    won = []
    racers = [threading.Thread(target=lambda k=k: won.append(put_if_absent(spark, str(tmp_path / "log/1.json"), f"{k}" * 1000))) for k in range(8)]
    for r in racers:
        r.start()
    for r in racers:
        r.join()
    assert sorted(won) == [False] * 7 + [True] and len(set((tmp_path / "log/1.json").read_text())) == 1 and names(tmp_path / "log") == ["1.json"]


def test_racing_runs_agree(spark, tmp_path):
    """Two runs make the same step at once: both build it, one entry holds, both read the same table; a third reads it too."""
    both, built = threading.Barrier(2), []

    def slow(df):
        built.append(1)
        both.wait(60)
        return df.select((F.col("id") * 2).alias("id"), F.lit(len(built)).alias("by"))

    steps, held, inputs = [Step("double", slow, ("numbers",))], [], {"numbers": ("1", spark.range(3))}
    runs = [threading.Thread(target=lambda: held.append(Pipeline(spark, str(tmp_path)).run(steps, inputs)["double"])) for _ in range(2)]
    for r in runs:
        r.start()
    for r in runs:
        r.join()
    assert len(built) == 2 and len(held) == 2 and held[0].inputFiles() == held[1].inputFiles()
    log = Pipeline(spark, str(tmp_path))
    assert log.known().count() == 1 and log.latest()["double"][1] in held[0].inputFiles()[0]
    again = log.run(steps, inputs)["double"]
    assert len(built) == 2 and again.inputFiles() == held[0].inputFiles()


def test_numbers_not_clocks_decide(spark, tmp_path):
    log = Pipeline(spark, str(tmp_path))
    for k, mark in enumerate("abc"):
        log.commit("s", mark, f"/p{k}", k)
    assert log.latest() == {"s": ("c", "/p2")} and log.commit("s", "b", "/late", 0) == ("b", "/p1") and log.known().count() == 3
    assert np.array_equal(sorted(r["version"] for r in log.known().collect()), [1, 2, 3])


def test_detect_takes_thresholds(spark, tmp_path, monkeypatch):
    from framewright import __main__ as job
    from framewright.plans.detect import SECOND, Settings

    seen = []
    monkeypatch.setattr(job, "detect_shots", lambda *tables: (seen.append(tables[-1]), spark.range(1))[1])
    for name in ("psd", "coarse", "fine", "slow", "frames", "durations"):
        spark.range(1).write.parquet(str(tmp_path / "in" / name))
    job.main(["detect", str(tmp_path / "in"), str(tmp_path / "a")])
    job.main(["detect", str(tmp_path / "in"), str(tmp_path / "b"), "--coarse", "0.8", "--gap-inside", "0.25", "--lag", "9", "--fps", "25"])
    assert seen[0] == Settings() and seen[1] == Settings(coarse=0.8, gap_inside=SECOND // 4, lag=9, fps=25.0)
