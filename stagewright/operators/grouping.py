"""Distinct rows and distinct values per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct over the given columns, or all.

    Copies of a row are merged before the shuffle, which hashes all columns, so neither many
    copies nor many different rows of one member make a hot task.
    """
    return (df.select(*columns) if columns else df).distinct()


def unique_values(df: DataFrame, key: str, value: str, name: str = "values") -> DataFrame:
    """One row per key with the array of its distinct non-null values, in no set order.

    Distinct pairs first: that shuffle spreads a hot key over its values and drops repeats on
    the map side, so the array step sees each value of a key once. A key without any value
    keeps an empty array.
    """
    pairs = df.select(F.col(key), F.col(value).alias(name)).distinct()
    return pairs.groupBy(key).agg(F.collect_list(name).alias(name))
