"""Array functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def size_or_zero(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def non_null_field(c: Column, field: str) -> Column:
    """The non-null values of one field of an array of structs."""
    return F.filter(F.transform(c, lambda s: s[field]), lambda v: v.isNotNull())


def has_non_null_field(c: Column, field: str) -> Column:
    return F.coalesce(F.exists(c, lambda s: s[field].isNotNull()), F.lit(False))


def labels_where(rules: Sequence[tuple[str, Column]]) -> Column:
    """The labels of the conditions that hold, in rule order; never null."""
    return F.array_compact(
        F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(label)) for label, cond in rules])
    )


def parse_list_text(c: Column) -> Column:
    """Text of a list to an array: bad text gives an empty array, null stays null."""
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    parsed = F.from_json(c, "array<string>", options)
    return F.when(c.isNotNull(), F.coalesce(parsed, empty_strings()))


def list_text(c: Column) -> Column:
    """An array as JSON text, the inverse of `parse_list_text` for CSV sinks."""
    return F.to_json(c)
