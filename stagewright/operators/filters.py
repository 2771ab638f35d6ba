"""Predicates in a form that reaches the scan."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _falls_on(df: DataFrame, column: str, date: dt.date | None) -> Column:
    """Compare by calendar day without wrapping a stored date or timestamp in a function."""
    value, kind = F.col(column), df.schema[column].dataType
    day = F.current_date() if date is None else F.lit(date).cast("date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (value >= day.cast(kind)) & (value < F.date_add(day, 1).cast(kind))
    if isinstance(kind, T.StringType):
        # By the cast alone: '2021-7-25', blanks around it or a time after it are the same day.
        return value.try_cast("date") == day
    return value == day


def on_date(df: DataFrame, column: str, date: dt.date | None = None) -> DataFrame:
    """Rows of one day, by default today.

    On a partition column this prunes partitions, on others row groups. A text column counts by
    the date that it casts to.
    """
    return df.where(_falls_on(df, column, date))


def on_date_or_missing(df: DataFrame, column: str, date: dt.date | None = None) -> DataFrame:
    """Rows of one day or without a day.

    After a left outer join this must stay above the join: a partner of another day drops the
    row, it does not turn it into an unmatched one. ``joins.left_join_dated`` does both at once.
    """
    return df.where(_falls_on(df, column, date) | F.col(column).isNull())


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of the columns is null."""
    return df.where(reduce(and_, (F.col(name).isNotNull() for name in columns)))
