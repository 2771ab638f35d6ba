"""Joins and distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright import operators as ops
from stagewright.functions import safe_cast
from workload import inputs
from workload.registry import query


@query(f"""
SELECT m.member_id, m.channel, a.consumer_id, a.city
FROM ({inputs.MEMBERS_SQL}) m JOIN ({inputs.ADDRESSES_SQL}) a
  ON TRY_CAST(m.member_id AS BIGINT) = a.consumer_id""")
def inner_join_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with their address: a text key against a bigint one."""
    return ops.inner_join(
        inputs.members(spark, sf_dir).select("member_id", "channel"),
        inputs.flat_addresses(spark, sf_dir).select("consumer_id", "city"),
        "member_id",
        "consumer_id",
    )


def _text_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts as a delimited drop gives them: the key is text."""
    return inputs.receipts(spark, sf_dir).select(
        F.col("txn_id").cast("string").alias("receipt_txn_id"), "loyalty_id", "products"
    )


@query(f"""
SELECT t.txn_id, t.retail_value, r.loyalty_id, r.products
FROM ({inputs.TRANSACTIONS_SQL}) t LEFT JOIN ({inputs.RECEIPTS_SQL}) r ON t.txn_id = r.txn_id""")
def left_join_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with its receipt, if any: a bigint key against a text one."""
    return ops.left_join(
        inputs.transactions(spark, sf_dir).select("txn_id", "retail_value"),
        _text_receipts(spark, sf_dir),
        "txn_id",
        "receipt_txn_id",
    ).drop("receipt_txn_id")


@query(f"""
SELECT t.txn_id, r.loyalty_id, c.c_custkey AS member_id, c.c_name AS member_name
FROM ({inputs.TRANSACTIONS_SQL}) t LEFT JOIN ({inputs.RECEIPTS_SQL}) r ON t.txn_id = r.txn_id
LEFT JOIN customer c ON r.loyalty_id = c.c_custkey""")
def left_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second left join on the nullable side of the first; rows without that key are spread."""
    receipts = inputs.receipts(spark, sf_dir).select(
        F.col("txn_id").alias("receipt_txn_id"), "loyalty_id"
    )
    members = ops.project(
        inputs.table(spark, sf_dir, "customer"),
        {"member_id": "c_custkey", "member_name": "c_name"},
    )
    transactions = inputs.transactions(spark, sf_dir).select("txn_id")
    with_receipt = ops.left_join(transactions, receipts, "txn_id", "receipt_txn_id")
    return ops.left_join(
        with_receipt, members, "loyalty_id", "member_id", spread_nulls_by=["txn_id"]
    ).drop("receipt_txn_id")


@query("SELECT c.*, n_name FROM customer c JOIN nation ON c_nationkey = n_nationkey")
def join_star_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of one side and one of the other."""
    return ops.star_join(
        inputs.table(spark, sf_dir, "customer"),
        inputs.table(spark, sf_dir, "nation"),
        "c_nationkey",
        "n_nationkey",
        "n_name",
    )


@query("""
SELECT returned AS return_flag, supplier AS supplier_id FROM (
  SELECT DISTINCT l_returnflag AS returned, l_suppkey AS supplier FROM lineitem) d""")
def distinct_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows in a nested query, renamed by the outer one."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    pairs = ops.project(lines, {"returned": "l_returnflag", "supplier": "l_suppkey"})
    return ops.project(
        ops.distinct_rows(pairs), {"return_flag": "returned", "supplier_id": "supplier"}
    )


@query(f"""
SELECT DISTINCT member_id, TRY_CAST(country_code AS SMALLINT) AS country_code,
       TRY_CAST(registration_id AS INTEGER) AS registration_id, channel, load_date
FROM ({inputs.MEMBERS_SQL}) WHERE load_date = DATE '2021-07-25'
  AND registration_id NOT LIKE '%.%'
UNION ALL
SELECT DISTINCT member_id, TRY_CAST(country_code AS SMALLINT), CAST(NULL AS INTEGER), channel,
       load_date
FROM ({inputs.MEMBERS_SQL}) WHERE load_date = DATE '2021-07-25' AND registration_id LIKE '%.%'""")
def distinct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct typed rows of one load date."""
    today = ops.on_date(inputs.staged_members(spark, sf_dir), "load_date", inputs.EXTRACT_DAY)
    typed = today.select(
        "member_id",
        safe_cast("country_code", "smallint").alias("country_code"),
        safe_cast("registration_id", "int").alias("registration_id"),
        "channel",
        "load_date",
    )
    return ops.distinct_rows(typed)


@query(f"""
SELECT DISTINCT m.member_id, m.channel, a.city
FROM ({inputs.MEMBERS_SQL}) m JOIN ({inputs.ADDRESSES_SQL}) a
  ON TRY_CAST(m.member_id AS BIGINT) = a.consumer_id""")
def distinct_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows of a join."""
    return ops.distinct_join(
        inputs.members(spark, sf_dir).select("member_id", "channel"),
        inputs.flat_addresses(spark, sf_dir).select("consumer_id", "city"),
        "member_id",
        "consumer_id",
    )


@query("""
SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem
WHERE l_shipdate >= DATE '1998-10-03' AND l_shipdate < DATE '1998-10-04'
  AND l_linenumber IS NOT NULL""")
def distinct_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows over a date and a not-null filter."""
    lines = ops.on_date(inputs.table(spark, sf_dir, "lineitem"), "l_shipdate", inputs.CHILD_DAY)
    columns = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return ops.distinct_rows(ops.present(lines, "l_linenumber"), columns)
