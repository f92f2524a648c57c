"""Small rules of the reports: lookups by type, frame and play times, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Colours and signs of shot types, and those of any other type.
COLOURS = {"dialogue": "#58a6ff", "bgm": "#3fb950", "sfx": "#d29922", "mixed": "#8b949e"}
SIGNS = {"dialogue": "💬", "bgm": "🎵", "sfx": "🔊", "mixed": "🔀"}
OTHER_COLOUR, OTHER_SIGN = "#666", "❓"


def lookup(key: Column, values: dict[str, str], other: str) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(other))


def type_colour(kind: Column) -> Column:
    return lookup(kind, COLOURS, OTHER_COLOUR)


def type_sign(kind: Column) -> Column:
    return lookup(kind, SIGNS, OTHER_SIGN)


def last_frame_time(start: Column, end: Column, back: float = 0.05) -> Column:
    return F.greatest(end - F.lit(back), start)


def play_time(t: Column, duration: Column, back: float = 0.1) -> Column:
    return F.greatest(F.lit(0.0), F.least(t, duration - F.lit(back)))


def frame_number(t: Column, fps: float = 30.0) -> Column:
    """Towards zero, as times are not negative."""
    return (t * F.lit(fps)).cast("long")


def first_filled(a: Column, b: Column) -> Column:
    """The first array that has elements; an empty one counts as missing."""
    return F.when(F.size(F.coalesce(a, F.array())) > 0, a).otherwise(b)


def excerpt(text: Column, most: int = 200) -> Column:
    return F.substring(text, 1, most)
