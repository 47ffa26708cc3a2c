"""Casts that never fail: text of nested values, lengths of lists, numbers where there are any."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(value: Column, kind: str, cut: int = 500) -> Column:
    """Nested values as JSON, others as text, cut; '' for null."""
    nested = kind.startswith(("array", "struct", "map"))
    return F.substring(F.coalesce(F.to_json(value) if nested else value.cast("string"), F.lit("")), 1, cut)


def as_count(value: Column, kind: str) -> Column:
    """The length of a list, or a number; 0 where there is neither."""
    if kind.startswith("array"):
        return F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)).cast("long")
    return F.coalesce(value.try_cast("long"), F.lit(0).cast("long"))


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 text, with marks in place of what is none."""
    return F.make_valid_utf8(content.cast("string"))
