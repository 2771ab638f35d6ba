"""Every registered query against its SQL."""

import bench
import pytest
from __spark_entry__ import entry, oracle_sql, queries
from workload import ORACLES, QUERIES
from workload.compare import connect, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    ok, detail = same(queries()[name](spark, sf_dir), con, oracle_sql()[name])
    assert ok, detail


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_benchmark_runs_registered_queries():
    assert set(bench.HEADLINE) <= set(queries())


def test_flagship_counts(spark, sf_dir):
    assert entry(spark).count() == 113
    assert queries()["load_txn_fact"](spark, "/root/testdata/sf0.01").count() == 1388


def _scans(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", ["filter_load_date", "load_member_dim_daily", "distinct_daily"])
def test_daily_queries_prune_dates(spark, sf_dir, name):
    assert "PartitionFilters: [isnotnull(load_date" in _scans(queries()[name](spark, sf_dir))


def test_the_fact_reads_the_periods_orders_only(spark, sf_dir):
    plan = _scans(queries()["load_txn_fact"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in plan
    assert "LessThan(o_orderdate,1999-01-01" in plan
