"""Writers; the written rows are read back for the comparison."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright.operators import stamp_load_date
from stagewright.session import scratch_path
from stagewright.sinks import stage, write_table
from stagewright.sinks.warehouse import definition
from stagewright.sources import read_staged, read_table
from workload import inputs
from workload.registry import query


def _stage_two_days(spark: SparkSession, sf_dir: str, overwrite: str) -> DataFrame:
    """All orders in two batches, the earlier orders staged one day before the later ones."""
    root = scratch_path(spark, "stage")
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate"
    )
    recent = F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))
    for day, part in ((24, ~recent), (25, recent)):
        batch = stamp_load_date(orders.where(part), dt.date(2021, 7, day)).drop("o_orderdate")
        stage(batch, root, "orders", overwrite)
    return read_staged(spark, root, "orders")


@query("""
SELECT o_orderkey, o_totalprice, DATE '2021-07-25' AS load_date
FROM orders WHERE o_orderdate >= DATE '1998-01-01'""")
def stage_static_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static overwrite: only the last batch survives."""
    return _stage_two_days(spark, sf_dir, "static")


@query("""
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate >= DATE '1998-01-01' THEN DATE '2021-07-25'
            ELSE DATE '2021-07-24' END AS load_date
FROM orders""")
def stage_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dynamic overwrite: each batch replaces its own day only."""
    return _stage_two_days(spark, sf_dir, "dynamic")


@query("""
SELECT o_orderkey, o_totalprice, DATE '2021-07-25' AS load_date
FROM orders WHERE o_orderdate >= DATE '1998-01-01'""")
def stage_empty_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged on two days, then the first of them again without rows: the other day stays."""
    root = scratch_path(spark, "stage")
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    recent = F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))
    for day, part in ((24, ~recent), (25, recent), (24, F.lit(False))):
        date = dt.date(2021, 7, day)
        batch = stamp_load_date(orders.where(part), date).drop("o_orderdate")
        stage(batch, root, "orders", "dynamic", dates=[date])
    return read_staged(spark, root, "orders")


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def warehouse_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice holds the second write."""
    path = scratch_path(spark, "warehouse")
    warehouse = {"kind": "spark", "path": path}
    table = f"supplier_{path.rsplit('-', 1)[1]}"
    supplier = inputs.table(spark, sf_dir, "supplier")
    write_table(supplier, table, warehouse)
    write_table(supplier.select("s_suppkey", "s_name", "s_nationkey"), table, warehouse)
    return read_table(spark, table, warehouse)


@query("""
SELECT o_orderkey, o_totalprice, o_orderstatus, 'orc' AS provider, 'o_orderstatus' AS partitioned_by
FROM orders WHERE o_orderdate >= DATE '1998-01-01'""")
def warehouse_definition_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external, partitioned ORC table of older orders whose rows the later orders replace."""
    path = scratch_path(spark, "warehouse")
    table = f"orders_{path.rsplit('-', 1)[1]}"
    orders = inputs.table(spark, sf_dir, "orders")
    recent = F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    old = orders.where(~recent).select(*columns)
    old.write.format("orc").partitionBy("o_orderstatus").option("path", path).saveAsTable(table)
    write_table(orders.where(recent).select(*columns), table, {"kind": "spark"}, unique="o_orderkey")
    now = definition(spark, table)
    return read_table(spark, table, {"kind": "spark"}).select(
        *columns,
        F.lit(now["provider"]).alias("provider"),
        F.lit(",".join(now["partition_columns"])).alias("partitioned_by"),
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def coalesced_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as a set number of files."""
    path = scratch_path(spark, "warehouse")
    warehouse = {"kind": "spark", "path": path}
    table = f"orders_{path.rsplit('-', 1)[1]}"
    orders = inputs.table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    write_table(orders.select(*columns), table, warehouse, num_files=4)
    return read_table(spark, table, warehouse)
