"""JSON kernels: typed arrays, and array-or-scalar values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def double_array(json_col: Column, path: str) -> Column:
    """The array at ``path`` as ARRAY<DOUBLE>; NULL when absent or not an array."""
    return F.from_json(F.get_json_object(json_col, path), "array<double>")


def double_array_or_nulls(json_col: Column, path: str, like: Column) -> Column:
    """As :func:`double_array`, with an array of NULLs as long as ``like`` instead of NULL."""
    return F.coalesce(
        double_array(json_col, path),
        F.array_repeat(F.lit(None).cast("double"), F.size(like)),
    )


def text_array(json_text: Column) -> Column:
    """JSON text as ARRAY<STRING>; a scalar gives NULL, which is how it is told apart."""
    return F.from_json(json_text, "array<string>")


def unquoted(json_text: Column) -> Column:
    """A scalar's text without the quotes around it."""
    return F.regexp_replace(json_text, '^"|"$', "")
