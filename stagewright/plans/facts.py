"""The retail transaction fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewright import LOAD_DATE
from stagewright.functions import item_count, null_marker, safe_cast
from stagewright.operators import (
    add_key,
    left_join_dated,
    left_join_heavy,
    left_join_keys,
    on_date,
    on_date_or_missing,
    project,
    with_time_parts,
)

# Unknown members and amounts.
UNKNOWN_KEY = -1
UNKNOWN_KEY_TEXT = "-1"
NO_AMOUNT = 0

_TRANSACTION = [
    "txn_id",
    "points_value",
    "retail_value",
    "external_reference",
    "activity_ts",
    "mobile_uid",
    "mobile_os",
    "receipt_status",
    "msg_code",
    LOAD_DATE,
]


def txn_fact(
    transactions: DataFrame,
    receipts: DataFrame,
    members: DataFrame,
    load_date: dt.date,
    marker_text: bool = False,
    legacy_null_size: bool = False,
    truncate: bool = False,
    one_pass: bool = False,
) -> DataFrame:
    """One day's transactions with their receipts and members: 24 columns.

    A transaction stays if its receipt is of the day or undated, or if it has none at all; one
    whose receipts are all of other days is dropped. The member is looked up by the receipt's
    loyalty id; rows without one are spread over the tasks. A member with several dimension rows
    gives several fact rows, which are alike, so the key is a fresh one.

    Receipts staged by date are read twice, the day's in full and the key of all. ``one_pass``
    is for receipts that a query computes, where the second reading would compute them again: it
    writes them aside once, at once, joins all of them, then filters; a transaction with very many
    receipts is split there as well.
    """
    day = on_date(transactions, LOAD_DATE, load_date).select(*_TRANSACTION)
    receipt = receipts.select(
        F.col("txn_id").alias("receipt_txn_id"),
        "loyalty_id",
        "products",
        "base_points",
        F.col(LOAD_DATE).alias("receipt_date"),
    )
    if one_pass:
        joined = left_join_heavy(day, receipt, "txn_id", "receipt_txn_id", truncate=truncate)
        matched, rest = on_date_or_missing(joined, "receipt_date", load_date), None
    else:
        matched, rest = left_join_dated(
            day, receipt, "txn_id", "receipt_txn_id", load_date, "receipt_date", truncate
        )
    rows = left_join_keys(
        matched,
        members.select("member_id"),
        "loyalty_id",
        "member_id",
        spread_nulls_by=["txn_id", "products", "base_points"],
        truncate=truncate,
    )
    if rest is not None:
        rows = rows.unionByName(rest, allowMissingColumns=True)
    rows = with_time_parts(rows, "activity_ts", "txn_")
    fact = project(
        rows,
        {
            "txn_id": F.col("txn_id").cast("string"),
            "item_qty": item_count("products", legacy_null_size=legacy_null_size),
            "loyalty_points": "points_value",
            "gross_standard": F.lit(NO_AMOUNT),
            "gross_local": "retail_value",
            "currency_key": F.lit(UNKNOWN_KEY),
            "txn_type_key": "external_reference",
            "txn_ts": "activity_ts",
            "txn_date": "txn_date",
            "txn_hour": "txn_hour",
            "txn_minute": "txn_minute",
            "txn_second": "txn_second",
            "channel_key": F.lit(UNKNOWN_KEY_TEXT),
            "member_id": "member_id",
            "ext_dec_1": null_marker(marker_text),
            "ext_dec_2": null_marker(marker_text),
            "ext_dec_3": "base_points",
            "ext_char_1": "mobile_uid",
            "ext_char_2": "mobile_os",
            "ext_char_3": "products",
            "ext_char_4": "receipt_status",
            "ext_char_5": safe_cast("msg_code", "bigint", truncate),
            LOAD_DATE: LOAD_DATE,
        },
    )
    return add_key(fact, "txn_key")
