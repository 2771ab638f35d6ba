"""Array profile and tier classification."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewright.functions import array_has, array_length, sorted_down, tier
from stagewright.functions.labels import COMPANY_TIERS, DEFAULT_TIER
from stagewright.operators import project

# Fixed value: the description whose presence is flagged.
WANTED_DESCRIPTION = "Movies"


def array_profile(
    df: DataFrame,
    key: str,
    values: str,
    wanted: str = WANTED_DESCRIPTION,
    legacy_null_size: bool = False,
) -> DataFrame:
    """Per row: the array, the array in descending order, its length, and a membership flag."""
    return project(
        df,
        {
            key: key,
            "unique_values": values,
            "ordered_values": sorted_down(values),
            "value_count": array_length(values, legacy_null_size),
            "has_wanted": array_has(values, wanted),
        },
    )


def company_tiers(
    df: DataFrame,
    company: str = "company",
    person: str = "employee",
    field: str = "firstName",
    tiers: Mapping[str, str] = COMPANY_TIERS,
    default: str = DEFAULT_TIER,
) -> DataFrame:
    """Company, a field of the employee struct, and the company's tier."""
    return project(
        df,
        {
            "company": company,
            "first_name": F.col(person)[field],
            "tier": tier(company, tiers, default),
        },
    )
