"""Text and encoding functions of the reports, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What HTML escapes, the ampersand first.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]


def html_escape(text: Column) -> Column:
    """Escaped for HTML; null becomes the empty string."""
    out = F.coalesce(text, F.lit(""))
    for raw, safe in ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def script_safe(json: Column) -> Column:
    """JSON that may stand inside a script element."""
    return F.replace(json, F.lit("</"), F.lit("<\\/"))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end (trim takes spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def data_url(raw: Column, media: str = "image/jpeg") -> Column:
    """Spark breaks base64 into lines; data URLs have none."""
    return F.concat(F.lit(f"data:{media};base64,"), F.regexp_replace(F.base64(raw), r"\s", ""))


def from_data_url(url: Column) -> Column:
    """The bytes of an image data URL; anything else is an error."""
    body = F.regexp_extract(url, r"(?s)^data:image/\w+;base64,(.*)", 1)
    return F.when(url.rlike(r"(?s)^data:image/\w+;base64,"), F.unbase64(body)).otherwise(F.raise_error(F.lit("not an image data URL")))


def byte_range(header: Column, size: Column) -> Column:
    """`bytes=a-b` as struct(first, last), clamped to the size; a missing start counts as 0."""
    first = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(header, r"bytes=(\d*)-(\d*)", 1), F.lit("")), F.lit("999999999999")).cast("long"), F.lit(0))
    last = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(header, r"bytes=(\d*)-(\d*)", 2), F.lit("")), F.lit("999999999999")).cast("long"), size - 1)
    return F.struct(first.alias("first"), F.least(last, size - 1).alias("last"))


def path_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def kind_prefix(kind: Column) -> Column:
    return F.substring_index(kind, "_", 1)


def frame_name(shot: Column, kind: Column) -> Column:
    return F.format_string("shot_%03d_%s.jpg", shot, kind_prefix(kind))


def frame_rate(fraction: Column, default: float = 30.0) -> Column:
    """`num/den` as a number; the default where it is empty or divides by zero."""
    part = lambda n: F.try_element_at(F.split(fraction, "/"), F.lit(n)).try_cast("double")
    return F.coalesce(F.try_divide(part(1), F.coalesce(part(2), F.lit(1.0))), F.lit(default))
