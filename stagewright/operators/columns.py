"""Column-level operators: narrow, no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewright import LOAD_DATE
from stagewright.functions import time_parts


def stamp_load_date(
    df: DataFrame, load_date: dt.date | None = None, column: str = LOAD_DATE
) -> DataFrame:
    """Add the ingest date: the given date, so that a rerun stamps the same one, else today."""
    stamp = F.current_date() if load_date is None else F.lit(load_date).cast("date")
    return df.withColumn(column, stamp)


def flatten_struct(
    df: DataFrame, struct: str, fields: Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Lift struct fields to top-level columns; a mapping gives {new column: field}."""
    names = fields if isinstance(fields, Mapping) else {name: name for name in fields}
    return df.withColumns({new: F.col(struct)[field] for new, field in names.items()})


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; a name that is absent is ignored."""
    return df.drop(*columns)


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename: {output column: input column or expression}."""
    return df.select(
        *(
            (F.col(source) if isinstance(source, str) else source).alias(name)
            for name, source in columns.items()
        )
    )


def constant_columns(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Add constants; a Column (a typed null, say) is used as it is."""
    return df.withColumns(
        {
            name: value if isinstance(value, Column) else F.lit(value)
            for name, value in constants.items()
        }
    )


def with_time_parts(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Add ``<prefix>date/hour/minute/second`` of a timestamp, date or text column."""
    text = isinstance(df.schema[column].dataType, T.StringType)
    parts = time_parts(column, text=text)
    return df.withColumns({f"{prefix}{name}": part for name, part in parts.items()})


def preview(df: DataFrame, rows: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows, as a DataFrame. With an order it is a per-task top-k, not a full sort.

    Each preview that is shown is one more job, so no load previews by itself.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
