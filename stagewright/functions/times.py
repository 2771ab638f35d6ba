"""Calendar date and clock parts of a point in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_parts(value: str | Column, text: bool = False) -> dict[str, Column]:
    """Date, hour, minute and second (whole seconds) by name.

    Set ``text`` where the column is a string: text that is no timestamp then gives NULLs.
    """
    moment = F.col(value) if isinstance(value, str) else value
    if text:
        moment = moment.try_cast("timestamp_ntz")
    return {
        "date": moment.cast("date"),
        "hour": F.hour(moment),
        "minute": F.minute(moment),
        "second": F.second(moment),
    }
