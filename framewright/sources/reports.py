"""Reading parts of, and writing, HTML reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.layout_text import field_lines
from framewright.functions.shots import excerpt, type_colour, type_sign
from framewright.functions.text import frame_name, from_data_url, html_escape, script_safe


def html_block(html: Column, tag: str) -> Column:
    """The content of a page's first element of that name, or the empty string."""
    return F.regexp_extract(html, rf"(?s)<{tag}>(.*?)</{tag}>", 1)


def swap_shots(script: Column, json: Column) -> Column:
    """A script with its `const shots = [...]` replaced."""
    old = F.regexp_extract(script, r"(?s)const shots = \[.*?\];", 0)
    return F.when(old == "", script).otherwise(F.replace(script, old, F.concat(F.lit("const shots = "), json, F.lit(";"))))


def frame_files(cache: DataFrame) -> DataFrame:
    """name, content of the cached frames that are not empty."""
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("url")) for k in ("first_frame", "last_frame")]))
    rows = cache.select("id", both.alias("f")).where(F.coalesce("f.url", F.lit("")) != "")
    return rows.select(frame_name(F.col("id"), F.col("f.kind")).alias("name"), from_data_url(F.col("f.url")).alias("content"))


def _page(title: Column, body: Column, order: list[str], script: Column | None, older: str | None) -> Column:
    """An aggregate: the page of a group's rows in order. An older page lends its style, and its script with the shots replaced."""
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, body.alias("__b")))), lambda s: s["__b"]), "\n")
    data = F.lit("") if script is None else script_safe(F.to_json(F.array_sort(F.collect_list(script))))
    style, code = F.lit(""), F.concat(F.lit("const rows = "), data, F.lit(";"))
    if older is not None:
        style = F.concat(F.lit("<style>"), html_block(F.lit(older), "style"), F.lit("</style>"))
        code = swap_shots(html_block(F.lit(older), "script"), data)
    head = F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), html_escape(title), F.lit("</title>"), style, F.lit("</head><body>\n"))
    return F.concat(head, line, F.lit("\n<script>"), code, F.lit("</script></body></html>"))


def report(rows: DataFrame, title: str, body: Column, order: list[str], script: Column | None = None, older: str | None = None) -> DataFrame:
    """One page of text from row fragments, for write.text: a report holds one video's shots, so that its rows fit one task."""
    return rows.agg(_page(F.lit(title), body, order, script, older).alias("value"))


def pages(rows: DataFrame, key: str, title: str, body: Column, order: list[str], script: Column | None = None, older: str | None = None) -> DataFrame:
    """The pages of all videos for the sinks of files: key, name, content. A page holds one video's shots."""
    named = F.concat(F.lit(f"{title} "), F.max(F.col(key).cast("string")))
    made = rows.groupBy(key).agg(_page(named, body, order, script, older).alias("__page"))
    return made.select(key, F.concat(F.col(key).cast("string"), F.lit(".html")).alias("name"), F.encode("__page", "UTF-8").alias("content"))


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Write files (name, content) below a folder all executors share, unless they are there; one row a file: name, written. A file appears whole, by a move; `files.save_files` commits all at once."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            new = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                there = fs.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound
                if not there:
                    aside = f"{root}/_aside-{uuid.uuid4().hex}"
                    with fs.open_output_stream(aside) as f:
                        f.write(content)
                    fs.move(aside, f"{root}/{name}")
                new.append(not there)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.bool_())], names=["name", "written"])

    return files.select("name", "content").mapInArrow(write, "name string, written boolean")


def card(label: Column, text: Column, css: Column) -> Column:
    return F.concat(F.lit('<div class="card '), css, F.lit('"><b>'), html_escape(label), F.lit("</b><p>"), html_escape(text), F.lit("</p></div>"))


def shot_card(id_: Column, start: Column, end: Column, css: Column) -> Column:
    """A card of the shot reports: number, times, short or long."""
    return card(F.concat(F.lit("#"), id_.cast("string")), F.format_string("%.1fs - %.1fs", start, end), css)


def audio_card(id_: Column, kind: Column, ratios: Column, dialogue: Column) -> Column:
    """A card of the sound report: type, whole percentages of the stems, dialogue."""
    shares = F.array_join(F.transform(F.array_sort(F.map_entries(ratios)), lambda e: F.format_string("%s %.0f%%", e["key"], e["value"] * 100)), ", ")
    text = F.concat_ws(" | ", shares, F.nullif(dialogue, F.lit("")))
    return F.concat(F.lit('<div style="color:'), type_colour(kind), F.lit('">'), card(F.concat(F.lit("#"), id_.cast("string"), F.lit(" "), type_sign(kind)), text, kind), F.lit("</div>"))


def timeline_row(id_: Column, y_start: Column, height: Column, kind: Column, dialogue: Column) -> Column:
    """A row of the timeline: its place, and the first 200 characters of what is said."""
    place = F.format_string('<div id="srow-%d" style="top:%.0fpx;height:%.0fpx">', id_.cast("int"), y_start, height)
    return F.concat(place, type_sign(kind), F.lit(" "), html_escape(excerpt(dialogue)), F.lit("</div>"))


def prompt_card(id_: Column, start: Column, end: Column, fields: dict[str, Column], dialogue: Column, prompt: Column) -> Column:
    """A card of the prompt review; prompts without a shot have no times."""
    times = F.coalesce(F.format_string("%.1fs - %.1fs", start, end), F.lit(""))
    times = F.when(start.isNull() | end.isNull(), "").otherwise(times)
    return F.concat(card(F.concat(F.lit("#"), id_.cast("string")), times, F.lit("prompt")), field_lines(fields), html_escape(dialogue), F.lit("<pre>"), html_escape(prompt), F.lit("</pre>"))
