"""Typing of text columns without failing the whole load on one bad value."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number_text(body: str) -> str:
    """Pattern of a signed number between blanks and control characters, as a cast takes it."""
    blank = r"[\x00-\x20\x7f]*"
    return rf"^{blank}[+-]?{body}{blank}$"


# At most 18 digits after leading zeros are always a bigint.
_SHORT_DIGITS, _DIGITS, _FRACTION = "0*[0-9]{1,18}", "[0-9]+", r"\.[0-9]*"

_LIMITS = {"tinyint": 2**7, "smallint": 2**15, "int": 2**31}
_OTHER_NAMES = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint"}


def _is_whole(to: str) -> bool:
    return to == "bigint" or to in _LIMITS


def safe_cast(value: str | Column, to: str, truncate: bool = False) -> Column:
    """Cast, giving NULL where the value does not fit, whatever the session's ANSI mode.

    What is to be a whole number is sorted out by pattern, if it is text, and by its range, since
    each failure inside ``try_cast`` raises and catches an exception: on columns with many bad values
    that takes twenty times as long. Values of other types are cast as they are, so 12.0 and true
    become 12 and 1.

    ``truncate=True`` also accepts decimal text for whole-number types and drops the fraction
    ("12.7" becomes 12), as a non-ANSI cast does.
    """
    column = F.col(value) if isinstance(value, str) else value
    to = _OTHER_NAMES.get(to, to)
    if not _is_whole(to):
        return column.try_cast(to)
    if isinstance(value, str) and re.fullmatch(r"\w+", value, re.ASCII):
        return F.expr(_whole_sql(f"`{value}`", to, truncate))
    # A constant once the column's type is known, so the other branch leaves the plan.
    is_text = F.typeof(column) == "string"
    return F.when(is_text, _whole_from_text(column, to, truncate)).otherwise(_whole_in_range(column, to))


def _whole_in_range(column: Column, to: str) -> Column:
    """A typed value as a whole number; the edges of the range, which a double may round, are left to the cast."""
    limit = float(_LIMITS.get(to, 2**63))
    number = column.try_cast("double")
    return F.when(number.between(-limit - 1, limit), column).try_cast(to)


def _whole_from_text(column: Column, to: str, truncate: bool) -> Column:
    text, digits = column.cast("string"), _DIGITS if to == "bigint" else _SHORT_DIGITS
    if truncate:
        valid = text.rlike(_number_text(f"{digits}({_FRACTION})?"))
        whole = F.when(valid, F.substring_index(text, ".", 1)).try_cast("bigint")
        number = F.coalesce(whole, F.when(text.rlike(_number_text(_FRACTION)), F.lit(0)))
    else:
        number = F.when(text.rlike(_number_text(digits)), text).try_cast("bigint")
    if to == "bigint":
        return number
    limit = _LIMITS[to]
    return F.when(number.between(-limit, limit - 1), number).try_cast(to)


def _whole_sql(name: str, to: str, truncate: bool) -> str:
    """The same for a column's name, as one text: a driver builds that many times faster."""
    digits = _DIGITS if to == "bigint" else _SHORT_DIGITS

    def like(body: str, then: str) -> str:
        return f"case when rlike({name}, r'{_number_text(body)}') then {then} end"

    if truncate:
        whole = like(f"{digits}({_FRACTION})?", f"substring_index({name}, '.', 1)")
        number = f"coalesce(try_cast({whole} as bigint), {like(_FRACTION, '0')})"
    else:
        number = f"try_cast({like(digits, f'cast({name} as string)')} as bigint)"
    if to != "bigint":
        limit = _LIMITS[to]
        number = f"try_cast(case when {number} between {-limit} and {limit - 1} then {number} end as {to})"
    limit = float(_LIMITS.get(to, 2**63))
    inside = f"try_cast({name} as double) between {-limit - 1:.1f}D and {limit:.1f}D"
    typed = f"try_cast(case when {inside} then {name} end as {to})"
    return f"case when typeof({name}) = 'string' then {number} else {typed} end"


def key_cast(value: str, to: str, truncate: bool = False) -> Column:
    """The cast of a text column that is a join key: as ``safe_cast``, for mostly sound text.

    ``truncate=True`` lets "12.0" and "12.7" meet 12, as a non-ANSI comparison does. Without it a
    pattern over every key costs more there than a few exceptions do, so only what shows at
    once, a first character above the digits or a decimal point, is sorted out beforehand.
    """
    text = F.col(value)
    if truncate:
        return safe_cast(text, to, truncate=True)
    if _is_whole(_OTHER_NAMES.get(to, to)):
        # Beside blanks a cast also ignores the one control character above the digits.
        starts_well = (text < ":") | text.startswith("\x7f")
        text = F.when(starts_well & ~text.contains("."), text)
    return text.try_cast(to)
