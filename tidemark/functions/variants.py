"""Typed reads of JSON kept as VARIANT, so that a value's JSON type stays known."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let


def kind(value: Column) -> Column:
    """STRING, BOOLEAN, BIGINT, DOUBLE, DECIMAL, VOID, OBJECT or ARRAY; null where there is no value."""
    return F.regexp_extract(F.schema_of_variant(value), r"\A[A-Z]+", 0)


def at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def text(value: Column, path: str) -> Column:
    """A string value; null for all other types."""
    return let(at(value, path), lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string")))


def truthy(value: Column) -> Column:
    """Neither absent nor null, false, zero, or an empty string, array or object."""
    as_text = F.try_variant_get(value, "$", "string")
    plain = F.when(kind(value) == "BOOLEAN", as_text == "true").when(kind(value).isin("BIGINT", "DOUBLE", "DECIMAL"), F.try_variant_get(value, "$", "double") != 0)
    return F.coalesce(plain, ~F.coalesce(F.to_json(value), F.lit("null")).isin('""', "[]", "{}", "null"), F.lit(False))


def spelled(value: Column) -> Column:
    """How a truthy value reads as text (true as True), else an empty text."""
    as_text = F.when(kind(value) == "BOOLEAN", F.lit("True")).otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
    return F.when(truthy(value), as_text).otherwise("")
