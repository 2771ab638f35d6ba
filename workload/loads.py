"""The whole loads, and the two stages end to end. Fresh keys are left out of compared rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewright import operators as ops
from stagewright import plans
from stagewright.session import scratch_path
from stagewright.sinks import stage
from stagewright.sources import read_staged
from workload import inputs
from workload.registry import query

_TYPED_MEMBERS_SQL = f"""
  SELECT DISTINCT member_id, TRY_CAST(country_code AS SMALLINT) AS country_code,
         CASE WHEN registration_id NOT LIKE '%.%'
              THEN TRY_CAST(registration_id AS INTEGER) END AS registration_id,
         registration_date, loyalty_id, channel, gender, member_city, load_date
  FROM ({inputs.MEMBERS_SQL})"""


@query(f"""
SELECT m.*, a.street, a.city, a.state
FROM ({_TYPED_MEMBERS_SQL}) m JOIN ({inputs.ADDRESSES_SQL}) a
  ON TRY_CAST(m.member_id AS BIGINT) = a.consumer_id""")
def load_member_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration dimension with address."""
    dim = plans.member_dim(inputs.members(spark, sf_dir), inputs.flat_addresses(spark, sf_dir))
    return dim.drop("member_key")


@query(f"SELECT * FROM ({_TYPED_MEMBERS_SQL}) WHERE load_date = DATE '2021-07-25'")
def load_member_dim_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration dimension of one load date."""
    dim = plans.member_dim_daily(inputs.staged_members(spark, sf_dir), inputs.EXTRACT_DAY)
    return dim.drop("member_key")


_CHILD_SQL = f"""
SELECT DISTINCT member_id, country_code, child_id, child_number, child_gender, load_date
FROM ({inputs.CHILDREN_SQL})
WHERE load_date = DATE '1998-10-03' AND child_id IS NOT NULL"""


@query(_CHILD_SQL)
def load_child_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child dimension of one day."""
    dim = plans.child_dim(inputs.children(spark, sf_dir), inputs.CHILD_DAY)
    return dim.drop("child_key").withColumn("load_date", F.col("load_date").cast("date"))


FACT_SQL = f"""
SELECT CAST(t.txn_id AS VARCHAR) AS txn_id,
       CAST(len(string_split(r.products, ',')) AS INTEGER) AS item_qty,
       t.points_value AS loyalty_points, 0 AS gross_standard, t.retail_value AS gross_local,
       -1 AS currency_key, t.external_reference AS txn_type_key, t.activity_ts AS txn_ts,
       CAST(t.activity_ts AS DATE) AS txn_date,
       CAST(hour(t.activity_ts) AS INTEGER) AS txn_hour,
       CAST(minute(t.activity_ts) AS INTEGER) AS txn_minute,
       CAST(second(t.activity_ts) AS INTEGER) AS txn_second,
       '-1' AS channel_key, c.c_custkey AS member_id,
       CAST(NULL AS DECIMAL(18, 2)) AS ext_dec_1, CAST(NULL AS DECIMAL(18, 2)) AS ext_dec_2,
       r.base_points AS ext_dec_3, t.mobile_uid AS ext_char_1, t.mobile_os AS ext_char_2,
       r.products AS ext_char_3, t.receipt_status AS ext_char_4,
       TRY_CAST(t.msg_code AS BIGINT) AS ext_char_5, t.load_date AS load_date
FROM ({inputs.TRANSACTIONS_SQL}) t
LEFT JOIN ({inputs.RECEIPTS_SQL}) r ON t.txn_id = r.txn_id
LEFT JOIN customer c ON r.loyalty_id = c.c_custkey
WHERE t.load_date = DATE '1998-01-01'
  AND (r.load_date = DATE '1998-01-01' OR r.load_date IS NULL)"""


@query(FACT_SQL)
def load_txn_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail transaction fact of one period: the flagship."""
    members = ops.project(inputs.table(spark, sf_dir, "customer"), {"member_id": "c_custkey"})
    fact = plans.txn_fact(
        inputs.transactions(spark, sf_dir, inputs.LOAD_PERIOD),
        inputs.receipts(spark, sf_dir),
        members,
        inputs.LOAD_PERIOD,
    )
    return fact.drop("txn_key")


@query(FACT_SQL)
def load_txn_fact_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact from inputs that are staged by period first, as the two stages do it."""
    root = scratch_path(spark, "staging")
    for name in ("transactions", "receipts"):
        stage(getattr(inputs, name)(spark, sf_dir), root, name, rebalance=True)
    members = ops.project(inputs.table(spark, sf_dir, "customer"), {"member_id": "c_custkey"})
    fact = plans.txn_fact(
        read_staged(spark, root, "transactions"),
        read_staged(spark, root, "receipts"),
        members,
        inputs.LOAD_PERIOD,
    )
    return fact.drop("txn_key")


@query(f"""
SELECT DISTINCT member_id, child_id, load_date FROM ({inputs.CHILDREN_SQL})
WHERE load_date = DATE '1998-10-03' AND child_id IS NOT NULL""")
def load_by_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loading query given as text over a named view."""
    text = """
      SELECT DISTINCT member_id, child_id, CAST(load_date AS DATE) AS load_date
      FROM child_rows
      WHERE load_date >= :load_date AND load_date < :load_date + INTERVAL 1 DAY
        AND child_id IS NOT NULL"""
    views = {"child_rows": inputs.children(spark, sf_dir)}
    return plans.sql_load(spark, text, views, inputs.CHILD_DAY)


FIRST_DAY = inputs.EXTRACT_DAY - dt.timedelta(days=1)


def _drop_sources(spark: SparkSession, sf_dir: str) -> list[dict]:
    """Write the inputs as the files a source system would leave, and describe them."""
    root = scratch_path(spark, "drops")
    members = inputs.members(spark, sf_dir).drop("load_date")
    children = inputs.children(spark, sf_dir).drop("load_date")
    transactions = inputs.transactions(spark, sf_dir).drop("load_date")
    receipts = inputs.receipts(spark, sf_dir).drop("load_date")

    members.write.csv(f"{root}/members", sep="|", header=True)
    children.write.csv(f"{root}/children", sep="|", header=True)
    transactions.write.json(f"{root}/transactions")
    # Two daily drops; small receipts came a day before the others.
    later = F.col("base_points") >= 10
    for day, part in (("24", ~later), ("25", later)):
        receipts.where(part).write.csv(f"{root}/receipts_GBR_{day}_07_2021.csv", sep="|")
    inputs.addresses(spark, sf_dir).write.json(f"{root}/addresses")
    conversations = inputs.table(spark, sf_dir, "conversations")
    conversations.write.json(f"{root}/conversations")
    return [
        {
            "name": "transactions",
            "kind": "documents",
            "path": f"{root}/transactions",
            "schema": transactions.schema,
        },
        {
            "name": "receipts",
            "kind": "delimited",
            "path": root,
            "drop": "receipts",
            "country": "GBR",
            "header": False,
            "columns": receipts.columns,
        },
        {
            "name": "conversations",
            "kind": "documents",
            "path": f"{root}/conversations",
            "schema": conversations.schema,
        },
        {
            "name": "addresses",
            "kind": "documents",
            "path": f"{root}/addresses",
            "schema": inputs.ADDRESS_SCHEMA,
            "flatten": {"address": ["street", "city", "state"]},
            "drop_columns": ["address", "_id"],
        },
        {"name": "members", "kind": "delimited", "path": f"{root}/members"},
        {"name": "children", "kind": "delimited", "path": f"{root}/children"},
    ]


def _ingest_two_days(spark: SparkSession, sf_dir: str, staging: str) -> list[dict]:
    """The receipts of the first day, then every source of the second."""
    sources = _drop_sources(spark, sf_dir)
    receipts = [spec for spec in sources if spec["name"] == "receipts"]
    plans.ingest(spark, receipts, staging, FIRST_DAY, overwrite="dynamic")
    return plans.ingest(
        spark, sources, staging, inputs.EXTRACT_DAY, overwrite="dynamic", parallel=3
    )


# Columns that are checked, and how a table of the same contents is had from the test tables.
# Amounts are compared with two decimals, as engines write doubles differently.
_AMOUNTS = {"retail_value", "base_points"}
_STAGED = {
    "transactions": (
        ["txn_id", "points_value", "retail_value", "external_reference", "activity_ts"]
        + ["mobile_uid", "mobile_os", "receipt_status", "msg_code"],
        f"SELECT * EXCLUDE load_date, DATE '2021-07-25' AS load_date FROM ({inputs.TRANSACTIONS_SQL})",
    ),
    "receipts": (
        ["txn_id", "loyalty_id", "products", "base_points"],
        f"""SELECT * EXCLUDE load_date, CASE WHEN base_points >= 10 THEN DATE '2021-07-25'
            ELSE DATE '2021-07-24' END AS load_date FROM ({inputs.RECEIPTS_SQL})""",
    ),
    "conversations": (
        ["conv_id", "turn", "role", "text"],
        "SELECT *, DATE '2021-07-25' AS load_date FROM conversations",
    ),
    "addresses": (
        ["consumer_id", "street", "city", "state"],
        f"SELECT *, DATE '2021-07-25' AS load_date FROM ({inputs.ADDRESSES_SQL})",
    ),
    "members": (
        ["member_id", "country_code", "registration_id", "registration_date", "loyalty_id"]
        + ["channel", "gender", "member_city"],
        f"SELECT * EXCLUDE load_date, DATE '2021-07-25' AS load_date FROM ({inputs.MEMBERS_SQL})",
    ),
    "children": (
        ["member_id", "country_code", "child_id", "child_number", "child_gender"],
        f"SELECT * EXCLUDE load_date, DATE '2021-07-25' AS load_date FROM ({inputs.CHILDREN_SQL})",
    ),
}
_LOADED = {
    "member_dim": (
        ["member_id", "country_code", "registration_id", "city"],
        f"""SELECT m.* EXCLUDE load_date, a.city, DATE '2021-07-25' AS load_date
            FROM (SELECT DISTINCT * EXCLUDE load_date, NULL AS load_date FROM ({_TYPED_MEMBERS_SQL})) m
            JOIN ({inputs.ADDRESSES_SQL}) a ON CAST(m.member_id AS BIGINT) = a.consumer_id""",
    ),
    "child_dim": (
        ["member_id", "country_code", "child_id", "child_number", "child_gender"],
        f"""SELECT DISTINCT * EXCLUDE load_date, DATE '2021-07-25' AS load_date
            FROM ({inputs.CHILDREN_SQL}) WHERE child_id IS NOT NULL""",
    ),
}
_LOADED_FACT = f"""
  SELECT t.txn_id, CAST(len(string_split(r.products, ',')) AS INTEGER) AS item_qty,
         c.c_custkey AS member_id, DATE '2021-07-25' AS load_date
  FROM orders o JOIN ({inputs.TRANSACTIONS_SQL}) t ON o.o_orderkey = t.txn_id
  LEFT JOIN ({_STAGED["receipts"][1]}) r ON t.txn_id = r.txn_id
  LEFT JOIN customer c ON r.loyalty_id = c.c_custkey
  WHERE r.load_date = DATE '2021-07-25' OR r.load_date IS NULL"""
for _name in ("txn_fact", "txn_fact_by_text"):
    _LOADED[_name] = (["txn_id", "item_qty", "member_id"], _LOADED_FACT)


def _contents_sql(tables: dict[str, tuple[list[str], str]]) -> str:
    parts = []
    for name, (columns, rows) in tables.items():
        for column in columns:
            value = f"CAST({column} AS DECIMAL(18, 2))" if column in _AMOUNTS else column
            digest = f"substr(md5(coalesce(CAST({value} AS VARCHAR), '~')), 1, 8)"
            parts.append(f"""
  SELECT '{name}' AS name, load_date, '{column}' AS column_name, count(*) AS n_rows,
         CAST(sum(CAST('0x' || {digest} AS BIGINT)) AS BIGINT) AS digest
  FROM ({rows}) GROUP BY load_date""")
    return " UNION ALL ".join(parts)


def _contents(tables: dict[str, DataFrame], columns: dict[str, tuple[list[str], str]]) -> DataFrame:
    """Per table, date and column: the rows, and a sum over hashes of the column's values.

    A hash costs more than a place in an aggregate, so equal values are counted first and hashed once.
    """
    parts = []
    for name, df in tables.items():
        for column in columns[name][0]:
            value = F.col(column)
            if column in _AMOUNTS:
                value = value.cast("double").cast("decimal(18,2)")
            elif df.schema[column].dataType in (T.FloatType(), T.DoubleType()):
                # Grouping takes -0.0 for 0.0, which are two texts.
                value = value.cast("string")
            counts = df.groupBy("load_date", value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            text = F.coalesce(F.col("value").cast("string"), F.lit("~")).cast("binary")
            number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
            sums = counts.groupBy("load_date").agg(
                F.sum("n").alias("n_rows"), F.sum(F.col("n") * number).alias("digest")
            )
            labels = F.lit(name).alias("name"), F.lit(column).alias("column_name")
            parts.append(sums.select(labels[0], "load_date", "n_rows", labels[1], "digest"))
    return reduce(DataFrame.unionByName, parts)


@query(_contents_sql(_STAGED))
def ingest_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage one: every source read, stamped and staged; the contents per source and date."""
    staging = scratch_path(spark, "staging")
    results = _ingest_two_days(spark, sf_dir, staging)
    staged = {r["name"]: read_staged(spark, staging, r["name"]) for r in results}
    return _contents(staged, _STAGED)


@query(_contents_sql(_LOADED))
def load_all_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages: the staged sources loaded into Spark tables; the contents of each table."""
    staging = scratch_path(spark, "staging")
    tables = scratch_path(spark, "tables")
    _ingest_two_days(spark, sf_dir, staging)
    suffix = tables.rsplit("-", 1)[1]
    targets = [
        {
            "name": "member_dim",
            "table": f"member_dim_{suffix}",
            "sources": ["members", "addresses"],
            "build": lambda views, day: plans.member_dim(views["members"], views["addresses"]),
        },
        {
            "name": "child_dim",
            "table": f"child_dim_{suffix}",
            "day_sources": "children",
            "build": lambda views, day: plans.child_dim(views["children"], day),
        },
        {
            "name": "txn_fact",
            "table": f"txn_fact_{suffix}",
            "day_sources": "transactions",
            "sources": "receipts",
            "targets": "member_dim",
            "build": lambda views, day: plans.txn_fact(
                views["transactions"], views["receipts"], views["member_dim"], day
            ),
        },
        {
            "name": "txn_fact_by_text",
            "table": f"txn_fact_by_text_{suffix}",
            "day_sources": "transactions",
            "sources": "receipts",
            "targets": ["member_dim"],
            "query": """
              SELECT t.txn_id, size(split(r.products, ',')) AS item_qty, m.member_id, t.load_date
              FROM transactions t
              LEFT JOIN receipts r ON t.txn_id = try_cast(r.txn_id AS BIGINT)
              LEFT JOIN member_dim m ON r.loyalty_id = m.member_id
              WHERE t.load_date = :load_date
                AND (r.load_date = :load_date OR r.load_date IS NULL)""",
        },
    ]
    warehouse = {"kind": "spark", "path": tables}
    plans.load(spark, targets, staging, warehouse, inputs.EXTRACT_DAY, parallel=3)
    loaded = {spec["name"]: spark.table(spec["table"]) for spec in targets}
    return _contents(loaded, _LOADED)
