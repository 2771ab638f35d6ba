"""Expressions: casts, counts, time parts, tiers, markers, arrays, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright.functions import item_count as count_items
from stagewright.functions import null_marker as marker
from stagewright.functions import safe_cast as cast
from stagewright.functions import to_null
from stagewright.operators import add_key, project, unique_values, with_time_parts
from stagewright.plans import array_profile as profile_arrays
from stagewright.plans import company_tiers, member_dim, txn_fact
from stagewright.session import scratch_path
from workload import inputs
from workload.registry import query


@query("""
SELECT p_partkey,
       TRY_CAST(trim(replace(p_brand, 'Brand#', '')) AS SMALLINT) AS brand_number,
       TRY_CAST(p_type AS INTEGER) AS type_number,
       TRY_CAST(CAST(p_partkey * 7 AS VARCHAR) AS SMALLINT) AS small_key,
       TRY_CAST(trunc(p_retailprice) AS INTEGER) AS whole_price,
       CAST(NULL AS INTEGER) AS strict_price,
       CAST(p_size AS VARCHAR) AS size_text,
       TRY_CAST(concat(p_partkey, p_size) AS BIGINT) AS long_key,
       TRY_CAST(trunc(p_retailprice) AS INTEGER) AS from_double,
       TRY_CAST(trunc(CAST(p_retailprice AS DECIMAL(12, 2))) AS BIGINT) AS from_decimal,
       TRY_CAST(p_size > 25 AS INTEGER) AS from_boolean,
       TRY_CAST(p_partkey * 40 AS SMALLINT) AS from_bigint
FROM part""")
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to smallint, integer and bigint; text that does not fit becomes NULL."""
    values = inputs.table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "replace(p_brand, 'Brand#', '') as brand",
        "p_type",
        "cast(p_partkey * 7 as string) as small_text",
        "cast(p_retailprice as decimal(12, 2)) as price",
        "cast(cast(p_retailprice as decimal(12, 2)) as string) as price_text",
        "p_size",
        "concat(p_partkey, p_size) as long_text",
        "p_retailprice",
        "p_size > 25 as large",
        "p_partkey * 40 as beyond",
    )
    return values.select(
        "p_partkey",
        cast("brand", "smallint").alias("brand_number"),
        cast("p_type", "int").alias("type_number"),
        cast("small_text", "smallint").alias("small_key"),
        cast("price_text", "int", truncate=True).alias("whole_price"),
        cast("price_text", "int").alias("strict_price"),
        cast("p_size", "string").alias("size_text"),
        cast("long_text", "bigint").alias("long_key"),
        cast("p_retailprice", "int").alias("from_double"),
        cast("price", "bigint").alias("from_decimal"),
        cast("large", "int").alias("from_boolean"),
        cast("beyond", "smallint").alias("from_bigint"),
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS at_date, CAST(hour(ts) AS INTEGER) AS at_hour,
       CAST(minute(ts) AS INTEGER) AS at_minute, CAST(second(ts) AS INTEGER) AS at_second
FROM events""")
def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date, hour, minute and second of each event."""
    events = inputs.table(spark, sf_dir, "events").select("event_id", "ts")
    return with_time_parts(events, "ts", "at_").drop("ts")


@query("""
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS item_qty FROM documents""")
def item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of each text, parted by blanks."""
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", count_items("text", " ").alias("item_qty")
    )


@query("""
SELECT event_type AS company, concat('E', event_id) AS first_name,
       CASE WHEN event_type = 'purchase' THEN 'Premium' WHEN event_type = 'view' THEN 'Legacy'
            ELSE 'Standard' END AS tier
FROM events""")
def tier_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier by company name, with a field of the employee struct."""
    employees = inputs.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("company"),
        F.struct(F.concat(F.lit("E"), "event_id").alias("firstName")).alias("employee"),
    )
    return company_tiers(employees, tiers={"purchase": "Premium", "view": "Legacy"})


@query("""
SELECT o_orderkey, CAST(NULL AS DECIMAL(18, 2)) AS real_null, '@NULL@' AS marker,
       CASE WHEN o_orderstatus = 'P' THEN '@NULL@' ELSE o_orderstatus END AS stored,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS read_back
FROM orders""")
def null_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The "no value" constant as NULL and as text, and the text read back as NULL."""
    status = F.col("o_orderstatus")
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        marker().alias("real_null"),
        marker(as_text=True).alias("marker"),
        F.when(status == "P", marker(as_text=True)).otherwise(status).alias("stored"),
    ).withColumn("read_back", to_null("stored"))


def _event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_values(inputs.table(spark, sf_dir, "events"), "user_id", "event_type")


@query("""
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS unique_values,
       CAST(count(DISTINCT event_type) AS INTEGER) AS value_count
FROM events GROUP BY user_id""")
def unique_values_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event types per user. The array has no set order, so it is sorted into text."""
    return _event_types(spark, sf_dir).select(
        "user_id",
        F.array_join(F.sort_array("values"), ",").alias("unique_values"),
        F.array_size("values").alias("value_count"),
    )


@query("""
SELECT user_id, array_to_string(list_sort(u), ',') AS unique_values,
       array_to_string(list_sort(u, 'DESC', 'NULLS LAST'), ',') AS ordered_values,
       CAST(len(u) AS INTEGER) AS value_count, list_contains(u, 'purchase') AS has_wanted
FROM (SELECT user_id, list(DISTINCT event_type) AS u FROM events GROUP BY user_id)""")
def array_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: the event types, in descending order, their number, a membership flag."""
    profile = profile_arrays(_event_types(spark, sf_dir), "user_id", "values", "purchase")
    return profile.withColumns(
        {
            "unique_values": F.array_join(F.sort_array("unique_values"), ","),
            "ordered_values": F.array_join("ordered_values", ","),
        }
    )


@query(f"""
SELECT count(*) AS n_rows, count(*) AS n_keys
FROM ({inputs.TRANSACTIONS_SQL}) t
LEFT JOIN ({inputs.RECEIPTS_SQL}) r ON t.txn_id = r.txn_id
WHERE t.load_date = DATE '1998-01-01'
  AND (r.load_date = DATE '1998-01-01' OR r.load_date IS NULL)""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh keys of the fact: as many as rows. The values differ from run to run."""
    fact = txn_fact(
        inputs.transactions(spark, sf_dir, inputs.LOAD_PERIOD),
        inputs.receipts(spark, sf_dir),
        project(inputs.table(spark, sf_dir, "customer"), {"member_id": "c_custkey"}),
        inputs.LOAD_PERIOD,
    )
    return _key_counts(fact, "txn_key")


@query("""
SELECT count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def surrogate_key_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable keys of the member dimension: one for each member."""
    dim = member_dim(
        inputs.members(spark, sf_dir), inputs.flat_addresses(spark, sf_dir), key="stable"
    )
    return _key_counts(dim, "member_key")


_FIRST_MEMBERS = "o_orderdate < DATE '1995-03-01'"


@query(f"""
WITH first AS (SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE {_FIRST_MEMBERS}),
every AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT 'first' AS load, count(*) AS n_rows, (SELECT n FROM first) AS n_keys, CAST(1 AS BIGINT) AS least,
       (SELECT n FROM first) AS most, CAST(0 AS BIGINT) AS changed
FROM orders WHERE {_FIRST_MEMBERS}
UNION ALL
SELECT 'second', count(*), (SELECT n FROM every), CAST(1 AS BIGINT), (SELECT n FROM every), CAST(0 AS BIGINT)
FROM orders""")
def surrogate_key_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a registry in two loads: dense, and those of the first load's members as before."""
    path = scratch_path(spark, "registry")
    orders = inputs.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    loads = {"first": orders.where(_FIRST_MEMBERS), "second": orders}
    keyed = {name: add_key(rows, "member_key", "registry", ["o_custkey"], path) for name, rows in loads.items()}
    before = keyed["first"].select("o_custkey", F.col("member_key").alias("before")).distinct()
    parts = [
        rows.join(before, "o_custkey", "left").agg(
            F.lit(name).alias("load"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(F.col("member_key")).alias("n_keys"),
            F.min("member_key").alias("least"),
            F.max("member_key").alias("most"),
            F.count_if(F.col("before") != F.col("member_key")).alias("changed"),
        )
        for name, rows in keyed.items()
    ]
    return parts[0].unionAll(parts[1])


def _key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col(key)).alias("n_keys")
    )
