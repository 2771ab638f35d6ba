"""What the two stages spare: sorting a single day, shuffling the day twice, hashing equal values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stagewright import plans
from stagewright.session import scratch_path
from stagewright.sinks import stage
from stagewright.sources import read_staged
from workload import inputs, loads

DAY, OTHER = dt.date(2021, 7, 25), dt.date(2021, 7, 24)


def test_ingest_writes_a_day_without_sorting_by_date(spark, monkeypatch):
    drop, root = scratch_path(spark, "drop"), scratch_path(spark, "staged")
    spark.range(4).select("id", F.lit("x").alias("v")).write.csv(drop, sep="|", header=True)
    sources = [{"name": "d", "kind": "delimited", "path": drop, "rejects": True}]

    def refused(*_):
        raise AssertionError("a write by partitions sorts every task's rows")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refused)
    results = plans.ingest(spark, sources, root, DAY, overwrite="dynamic")
    assert (results[0]["rows"], results[0]["rejects"]) == (4, 0)
    assert read_staged(spark, root, "d").count() == 4


def test_a_day_takes_all_rows_and_counts_when_empty(spark):
    root = scratch_path(spark, "staged")
    mixed = spark.range(6).withColumn("load_date", F.when(F.col("id") > 2, F.lit(OTHER)))
    assert stage(mixed, root, "s", "dynamic", day=DAY) == 6
    back = read_staged(spark, root, "s")
    assert back.columns == ["id", "load_date"]
    assert {(r.load_date, r["count"]) for r in back.groupBy("load_date").count().collect()} == {(DAY, 6)}
    assert stage(mixed, root, "s", "dynamic", rebalance=True, day=OTHER) == 6
    assert stage(mixed.limit(0), root, "s", "dynamic", day=DAY) == 0
    assert read_staged(spark, root, "s", DAY).count() == 0
    assert read_staged(spark, root, "s").count() == 6
    assert stage(mixed, root, "s", "static", day=DAY) == 6
    assert {r.load_date for r in read_staged(spark, root, "s").collect()} == {DAY}


def test_fact_of_a_recorded_day_shuffles_it_once(spark, sf_dir):
    root = scratch_path(spark, "staged")
    for name in ("transactions", "receipts"):
        stage(getattr(inputs, name)(spark, sf_dir), root, name, rebalance=True)
    members = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member_id"))
    off = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in off:
        spark.conf.set(key, "-1")
    try:
        period = inputs.LOAD_PERIOD
        day = read_staged(spark, root, "transactions", period)
        fact = plans.txn_fact(day, read_staged(spark, root, "receipts"), members, period)
        fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for key in off:
            spark.conf.unset(key)
    assert "ReusedExchange" in plan


def test_contents_hash_each_value_once(spark):
    rows = [(DAY, 0.0, "a"), (DAY, -0.0, "~"), (DAY, None, None), (DAY, 0.0, "a"), (OTHER, float("nan"), ""), (None, 1.5, "a")]
    df = spark.createDataFrame(rows, "load_date date, d double, s string")
    got = loads._contents({"t": df}, {"t": (["d", "s"], "")})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # Per column: one aggregate by value, and above it the one that hashes.
    assert plan.count("Aggregate [") == 4
    number = "cast(conv(substring(md5(cast(coalesce(cast({0} as string), '~') as binary)), 1, 8), 16, 10) as bigint)"
    wanted = [
        ("t", r.load_date, r.n, c, r[c])
        for r in df.groupBy("load_date").agg(F.count(F.lit(1)).alias("n"), *(F.expr(f"sum({number.format(c)})").alias(c) for c in "ds")).collect()
        for c in "ds"
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)
