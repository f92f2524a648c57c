"""Text fragments of report cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.text import html_escape


def field_lines(fields: dict[str, Column]) -> Column:
    """Label and escaped value of each field, one a line."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"<i>{label}</i> "), html_escape(value)) for label, value in fields.items()])
