"""Merging and checking of annotation documents (prompts) that come in parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

#: The fields that a prompt should have.
REQUIRED = ("subject", "action", "camera", "scene", "lighting", "style", "prompt_text")


def last_wins(parts: DataFrame, key: str, *order: str) -> DataFrame:
    """The row of each key that comes last in the order (of files, then of places in them), with the number of rows it had."""
    fields = [c for c in parts.columns if c != key]
    last = F.max_by(F.struct(*fields), F.struct(*order))
    return parts.groupBy(key).agg(last.alias("__r"), F.count(F.lit(1)).alias("n_rows")).select(key, "__r.*", "n_rows")


def missing_ids(roster: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return roster.select(key).distinct().join(found.select(key), key, "left_anti")


def extra_ids(roster: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return missing_ids(found, roster, key)


def require_complete(roster: DataFrame, found: DataFrame, key: str) -> None:
    """Fail where an id of the roster has no document."""
    lost = missing_ids(roster, found, key).orderBy(key).limit(20).collect()
    if lost:
        raise ValueError(f"no document for {key} {[r[0] for r in lost]}")


def empty_fields(docs: DataFrame, key: str, fields: tuple[str, ...] = REQUIRED) -> DataFrame:
    """key, field for each field that is null or empty: a warning, not a failure."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    return docs.select(key, pairs.alias("p")).where(F.coalesce("p.value", F.lit("")) == "").select(key, "p.field")


def with_times(prompts: DataFrame, shots: DataFrame, key: str, times: list[str]) -> DataFrame:
    """Prompts with their shots' times; prompts without a shot stay, with null times."""
    return prompts.join(shots.select(key, *times), key, "left")


def lacking(roster: DataFrame, cache: DataFrame, key: str, field: str) -> DataFrame:
    """The ids that have no cached value yet."""
    return roster.join(cache.where(F.coalesce(field, F.lit("")) != "").select(key), key, "left_anti")


def text_filter(docs: DataFrame, text: str, query: str) -> DataFrame:
    """Documents that contain the trimmed query, whatever its case; an empty query keeps all."""
    wanted = query.strip().lower()
    return docs.where(F.lower(text).contains(wanted)) if wanted else docs


def ordered_text(rows: DataFrame, keys: list[str], order: list[str], text: Column, between: str, out: str) -> DataFrame:
    """The texts of each key joined in order; one array per key, as long as the text that it makes."""
    held = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(held, lambda s: s["__t"]), between).alias(out))
