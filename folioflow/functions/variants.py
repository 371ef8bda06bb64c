"""Typed access to loosely typed JSON objects, by fields held as VARIANT."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_fields(record: Column, names: Iterable[str]) -> Column:
    """Parse JSON text once into a struct with one VARIANT per named field.

    A text that is no JSON object gives nulls, and so does an absent field.
    """
    return F.from_json(record, ", ".join(f"{name} variant" for name in names))


def text_of(field: Column) -> Column:
    """The value of a JSON string, null for any other type (numbers do not become text)."""
    return F.when(F.schema_of_variant(field) == "STRING", F.try_variant_get(field, "$", "string"))


def texts_of(field: Column) -> Column:
    """The string elements of a JSON array; an empty array for any other type."""
    items = F.filter(F.try_variant_get(field, "$", "array<variant>"), lambda v: F.schema_of_variant(v) == "STRING")
    texts = F.transform(items, lambda v: F.try_variant_get(v, "$", "string"))
    return F.coalesce(texts, F.array().cast("array<string>"))
