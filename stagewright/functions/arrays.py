"""Expressions over arrays and delimited lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def array_length(values: str | Column, legacy_null_size: bool = False) -> Column:
    """Number of elements, nulls included. A null array gives NULL, or -1 in legacy mode."""
    length = F.array_size(_col(values))
    return F.coalesce(length, F.lit(-1)) if legacy_null_size else length


def item_count(text: str | Column, pattern: str = ",", legacy_null_size: bool = False) -> Column:
    """Number of items in a delimited list; ``pattern`` is a regular expression.

    Empty text is one item and trailing separators count.
    """
    return array_length(F.split(_col(text), pattern), legacy_null_size)


def sorted_down(values: str | Column) -> Column:
    """The array in descending order, nulls last."""
    return F.sort_array(_col(values), asc=False)


def array_has(values: str | Column, wanted: object) -> Column:
    """Whether the array holds the value; NULL if it does not but holds a null."""
    return F.array_contains(_col(values), wanted)
