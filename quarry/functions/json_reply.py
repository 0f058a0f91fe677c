"""M5: parse a model's JSON reply (outermost ``{...}`` across lines) with defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import col_


def json_span(reply) -> Column:
    """Greedy outermost ``{...}`` span ('' when there is none)."""
    return F.regexp_extract(F.coalesce(col_(reply), F.lit("")), r"(?s)\{.*\}", 0)


def parsed(reply) -> Column:
    """A VARIANT of the JSON span, null when absent or not valid JSON."""
    span = json_span(reply)
    return F.when(span != "", F.try_parse_json(span))


def field(variant: Column, path: str, type_: str) -> Column:
    return F.try_variant_get(variant, path, type_)
