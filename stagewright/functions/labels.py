"""Tiering and null markers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for "no value", and the company tiers.
NULL_MARKER = "@NULL@"
COMPANY_TIERS = {"FamilyCo": "Premium", "OldCo": "Legacy"}
DEFAULT_TIER = "Standard"


def tier(
    value: str | Column,
    tiers: Mapping[str, str] = COMPANY_TIERS,
    default: str = DEFAULT_TIER,
) -> Column:
    """The tier of the first equal value, else the default (also for NULL)."""
    column = F.col(value) if isinstance(value, str) else value
    chain = F
    for match, name in tiers.items():
        chain = chain.when(column == match, name)
    return F.lit(default) if chain is F else chain.otherwise(default)


def null_marker(as_text: bool = False, to: str = "decimal(18,2)") -> Column:
    """A "no value" constant: a typed NULL, or the marker text."""
    return F.lit(NULL_MARKER) if as_text else F.lit(None).cast(to)


def to_null(value: str | Column, marker: str = NULL_MARKER) -> Column:
    """Read marker text back as a real NULL."""
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(marker))
