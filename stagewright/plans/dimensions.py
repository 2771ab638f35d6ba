"""Dimension loads. The grain is a distinct row, not a member: a member may have several."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from stagewright import LOAD_DATE
from stagewright.functions import safe_cast
from stagewright.operators import add_key, distinct_join, distinct_rows, on_date, present, project


def _registration(members: DataFrame, truncate: bool) -> DataFrame:
    return project(
        members,
        {
            "member_id": "member_id",
            "country_code": safe_cast("country_code", "smallint", truncate),
            "registration_id": safe_cast("registration_id", "int", truncate),
            "registration_date": "registration_date",
            "loyalty_id": "loyalty_id",
            "channel": "channel",
            "gender": "gender",
            "member_city": "member_city",
            LOAD_DATE: LOAD_DATE,
        },
    )


# What identifies a member or a child from one day to the next.
MEMBER_KEY = ("member_id",)
CHILD_KEY = ("member_id", "child_id")


def member_dim(
    members: DataFrame,
    addresses: DataFrame,
    key: str = "fresh",
    truncate: bool = False,
    key_columns: Sequence[str] = MEMBER_KEY,
    registry: str | None = None,
) -> DataFrame:
    """Registrations with their address: 13 columns, for every staged date.

    A stable key, or one from a registry's folder, depends on ``key_columns`` only, so rows of one
    member on several days share it: what is unique then is the key with the load date, as long as
    the member has one registration a day and one address.
    """
    address = addresses.select("consumer_id", "street", "city", "state")
    registration = _registration(members, truncate)
    rows = distinct_join(registration, address, "member_id", "consumer_id", truncate)
    order = [name for name in rows.columns if name != LOAD_DATE]
    return add_key(rows.select(*order, LOAD_DATE), "member_key", key, key_columns, registry)


def member_dim_daily(
    members: DataFrame,
    load_date: dt.date | None = None,
    key: str = "fresh",
    truncate: bool = False,
    key_columns: Sequence[str] = MEMBER_KEY,
    registry: str | None = None,
) -> DataFrame:
    """Registrations of one load date, by default today, without addresses: 10 columns."""
    today = on_date(members, LOAD_DATE, load_date)
    rows = distinct_rows(_registration(today, truncate))
    return add_key(rows, "member_key", key, key_columns, registry)


def child_dim(
    members: DataFrame,
    load_date: dt.date,
    key: str = "fresh",
    key_columns: Sequence[str] = CHILD_KEY,
    registry: str | None = None,
) -> DataFrame:
    """Children of the members of one load date: 7 columns."""
    children = present(on_date(members, LOAD_DATE, load_date), "child_id")
    columns = ["member_id", "country_code", "child_id", "child_number", "child_gender", LOAD_DATE]
    return add_key(distinct_rows(children, columns), "child_key", key, key_columns, registry)
