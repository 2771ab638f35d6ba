"""Projections, column operations, constants and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright import operators as ops
from workload import inputs
from workload.registry import query


@query(inputs.ADDRESSES_SQL)
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address fields lifted to columns."""
    documents = inputs.addresses(spark, sf_dir)
    flat = ops.flatten_struct(documents, "address", ["street", "city", "state"])
    return flat.select("consumer_id", "street", "city", "state")


@query(inputs.ADDRESSES_SQL)
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested column and the document id dropped after the lift."""
    documents = inputs.addresses(spark, sf_dir)
    flat = ops.flatten_struct(documents, "address", ["street", "city", "state"])
    return ops.drop_columns(flat, "address", "_id")


@query("""
SELECT c_custkey AS consumer_id, n_name AS city
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def struct_field_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct field in a select."""
    documents = inputs.addresses(spark, sf_dir)
    return ops.project(documents, {"consumer_id": "consumer_id", "city": "address.city"})


@query("SELECT c_custkey, c_name, DATE '2021-07-25' AS load_date FROM customer")
def stamp_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row stamped with the ingest date."""
    customer = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return ops.stamp_load_date(customer, inputs.EXTRACT_DAY)


@query("SELECT c_custkey, c_name FROM customer")
def stamp_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stamped with the current date pass the filter for today."""
    customer = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return ops.on_date(ops.stamp_load_date(customer), "load_date").drop("load_date")


@query("""
SELECT o_orderkey AS txn_id, o_totalprice AS gross_local, o_orderpriority AS txn_type_key
FROM orders""")
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen columns under new names."""
    return ops.project(
        inputs.table(spark, sf_dir, "orders"),
        {"txn_id": "o_orderkey", "gross_local": "o_totalprice", "txn_type_key": "o_orderpriority"},
    )


@query("""
SELECT o_orderkey, 0 AS gross_standard, -1 AS currency_key, '-1' AS channel_key,
       '@NULL@' AS ext_dec_1
FROM orders""")
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant keys, amount and marker on every row."""
    return ops.constant_columns(
        inputs.table(spark, sf_dir, "orders").select("o_orderkey"),
        {"gross_standard": 0, "currency_key": -1, "channel_key": "-1", "ext_dec_1": "@NULL@"},
    )


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows by key."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ops.preview(orders, 5, ["o_orderkey"])


@query(f"SELECT * FROM ({inputs.MEMBERS_SQL}) WHERE load_date = DATE '2021-07-25'")
def filter_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of one load date."""
    return ops.on_date(inputs.staged_members(spark, sf_dir), "load_date", inputs.EXTRACT_DAY)


@query("""
SELECT event_id FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events) AND event_id % 5 < 4""")
def filter_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first day by a date that is text, however it is spelled."""
    first = inputs.table(spark, sf_dir, "events").agg(F.min("ts").cast("date")).first()[0]
    return ops.on_date(inputs.text_dates(spark, sf_dir), "day_text", first).select("event_id")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_shipdate >= DATE '1998-10-03' AND l_shipdate < DATE '1998-10-04'""")
def filter_fixed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one day of a timestamp column."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    return ops.on_date(lines, "l_shipdate", inputs.CHILD_DAY).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(f"""
SELECT * FROM ({inputs.CHILDREN_SQL})
WHERE load_date = DATE '1998-10-03' AND child_id IS NOT NULL""")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's children that have an id."""
    children = ops.on_date(inputs.children(spark, sf_dir), "load_date", inputs.CHILD_DAY)
    return ops.present(children, "child_id").withColumn(
        "load_date", F.col("load_date").cast("date")
    )


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by ship year; returned ones carry no date."""
    return inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.when(
            F.col("l_returnflag") != "R", F.trunc(F.col("l_shipdate").cast("date"), "year")
        ).alias("line_date"),
    )


_DATED_LINES_SQL = """
SELECT o_orderkey, l_partkey, line_date
FROM orders LEFT JOIN (
  SELECT l_orderkey, l_partkey,
         CASE WHEN l_returnflag <> 'R'
              THEN CAST(date_trunc('year', l_shipdate) AS DATE) END AS line_date
  FROM lineitem) ON o_orderkey = l_orderkey
WHERE line_date = DATE '1998-01-01' OR line_date IS NULL"""


@query(_DATED_LINES_SQL)
def filter_date_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join, then keep partners of the year, undated ones and orders without any line."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey")
    lines = _dated_lines(spark, sf_dir)
    joined = ops.left_join(orders, lines, "o_orderkey", "l_orderkey", hot_right=True)
    return ops.on_date_or_missing(joined, "line_date", dt.date(1998, 1, 1)).drop("l_orderkey")


@query(f"SELECT o_orderkey, l_partkey FROM ({_DATED_LINES_SQL})")
def left_join_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by the join that ships only the key of partners of other dates."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey")
    matched, unmatched = ops.left_join_dated(
        orders,
        _dated_lines(spark, sf_dir),
        "o_orderkey",
        "l_orderkey",
        dt.date(1998, 1, 1),
        "line_date",
    )
    rows = matched.unionByName(unmatched, allowMissingColumns=True)
    return rows.select("o_orderkey", "l_partkey")
