"""The test tables in the shape of the loads' inputs.

Every function maps whole tables. The SQL twins are kept next to them, so that a change of one
shows in the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from stagewright.session import scratch_path
from stagewright.sinks import stage
from stagewright.sources import read_staged

# The period of the transaction load: receipts rarely fall on the day of their order, so a
# "load date" is the first day of a year.
LOAD_PERIOD = dt.date(1998, 1, 1)
# The day of the member extract, and of the child rows.
EXTRACT_DAY = dt.date(2021, 7, 25)
CHILD_DAY = dt.date(1998, 10, 3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day as text in several spellings, or as text that is no date."""
    day, turn = F.col("ts").cast("date"), F.pmod("event_id", F.lit(5))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(turn == 0, day.cast("string"))
        .when(turn == 1, F.concat_ws("-", F.year(day), F.month(day), F.day(day)))
        .when(turn == 2, F.concat(F.lit(" "), day.cast("string")))
        .when(turn == 3, F.concat(day.cast("string"), F.lit(" 10:00:00")))
        .otherwise(F.concat(F.lit("on "), day.cast("string")))
        .alias("day_text"),
    )


def transactions(
    spark: SparkSession, sf_dir: str, period: dt.date | None = None
) -> DataFrame:
    """All transactions, or those of the year that a period names, by a range the scan can use."""
    orders = table(spark, sf_dir, "orders")
    if period is not None:
        first, after = (F.lit(dt.datetime(period.year + n, 1, 1)).cast("timestamp_ntz") for n in (0, 1))
        orders = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < after))
    return orders.select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("points_value"),
        F.col("o_totalprice").alias("retail_value"),
        F.col("o_orderpriority").alias("external_reference"),
        F.col("o_orderdate").alias("activity_ts"),
        F.col("o_custkey").cast("string").alias("mobile_uid"),
        F.col("o_orderstatus").alias("mobile_os"),
        F.col("o_orderpriority").alias("receipt_status"),
        # Text that is a number for some rows only.
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("msg_code"),
        F.trunc(F.col("o_orderdate").cast("date"), "year").alias("load_date"),
    )


TRANSACTIONS_SQL = """
  SELECT o_orderkey AS txn_id, o_custkey AS points_value, o_totalprice AS retail_value,
         o_orderpriority AS external_reference, o_orderdate AS activity_ts,
         CAST(o_custkey AS VARCHAR) AS mobile_uid, o_orderstatus AS mobile_os,
         o_orderpriority AS receipt_status,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS msg_code,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS load_date
  FROM orders"""


# What parts words: blanks, and what a delimited file would have to quote. A comma joins them.
_BETWEEN = r'[\x09-\x0D ,|"\\]+'


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One receipt per line, several per order and of several years.

    Its products are the words of a whole text that goes with the supplier; most have none.
    """
    words = table(spark, sf_dir, "benchmark").select(
        "item_id", F.regexp_replace("text", _BETWEEN, ",").alias("products")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(words, F.col("l_suppkey") == F.col("item_id"), "left")
        .select(
            F.col("l_orderkey").alias("txn_id"),
            F.col("l_suppkey").alias("loyalty_id"),
            "products",
            F.col("l_quantity").alias("base_points"),
            F.trunc(F.col("l_shipdate").cast("date"), "year").alias("load_date"),
        )
    )


RECEIPTS_SQL = f"""
  SELECT l_orderkey AS txn_id, l_suppkey AS loyalty_id,
         regexp_replace(text, '{_BETWEEN}', ',', 'g') AS products, l_quantity AS base_points,
         CAST(date_trunc('year', l_shipdate) AS DATE) AS load_date
  FROM lineitem LEFT JOIN benchmark ON l_suppkey = item_id"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member extract, all text but the date; each row occurs twice, as in a repeated drop."""
    customer = table(spark, sf_dir, "customer")
    extract = customer.select(
        F.col("c_custkey").cast("string").alias("member_id"),
        # Neither fits its type for some rows: text, and decimals.
        F.when(F.col("c_mktsegment") == "MACHINERY", "unknown")
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("country_code"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.col("c_custkey"), F.lit(".7")))
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("registration_id"),
        F.col("c_mktsegment").alias("registration_date"),
        F.concat(F.lit("L"), F.col("c_custkey")).alias("loyalty_id"),
        F.col("c_mktsegment").alias("channel"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
        F.col("c_name").alias("member_city"),
        F.date_add(F.lit(dt.date(2021, 7, 20)), F.col("c_nationkey")).alias("load_date"),
    )
    return extract.unionAll(extract)


def staged_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member extract staged by date, so that a day's filter reads one folder."""
    root = scratch_path(spark, "members")
    stage(members(spark, sf_dir), root, "members", rebalance=True)
    return read_staged(spark, root, "members")


MEMBERS_SQL = """
  SELECT CAST(c_custkey AS VARCHAR) AS member_id,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'unknown'
              ELSE CAST(c_nationkey AS VARCHAR) END AS country_code,
         CASE WHEN c_mktsegment = 'BUILDING' THEN concat(c_custkey, '.7')
              ELSE CAST(c_custkey AS VARCHAR) END AS registration_id,
         c_mktsegment AS registration_date, concat('L', c_custkey) AS loyalty_id,
         c_mktsegment AS channel, substr(c_mktsegment, 1, 1) AS gender, c_name AS member_city,
         DATE '2021-07-20' + c_nationkey AS load_date
  FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer)"""


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows from lines; returned lines have no child id. The date column stays a stored
    timestamp, so the day's filter reaches the scan."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("member_id"),
        F.col("l_suppkey").alias("country_code"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("child_id"),
        F.col("l_linenumber").alias("child_number"),
        F.col("l_linestatus").alias("child_gender"),
        F.col("l_shipdate").alias("load_date"),
    )


CHILDREN_SQL = """
  SELECT l_orderkey AS member_id, l_suppkey AS country_code,
         CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS child_id,
         l_linenumber AS child_number, l_linestatus AS child_gender,
         CAST(l_shipdate AS DATE) AS load_date
  FROM lineitem"""


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address documents with a nested address."""
    customer = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("doc-"), F.col("c_custkey")).alias("_id"),
            F.col("c_custkey").alias("consumer_id"),
            F.struct(
                F.col("c_name").alias("street"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
            ).alias("address"),
        )
    )


ADDRESS_SCHEMA = (
    "_id string, consumer_id bigint, address struct<street: string, city: string, state: string>"
)

ADDRESSES_SQL = """
  SELECT c_custkey AS consumer_id, c_name AS street, n_name AS city, r_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey"""


def flat_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("consumer_id", "address.*")
