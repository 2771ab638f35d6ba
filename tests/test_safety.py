"""Loads that must not lose or change what is there: replaces, views, keys, names, split reads."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from stagewright import operators as ops
from stagewright import plans
from stagewright.functions import item_count, safe_cast
from stagewright.plans.stages import LoadError
from stagewright.session import scratch_path
from stagewright.sinks import write_table
from stagewright.sources import jdbc, read_table
from workload import inputs
from workload.sources import jdbc_options

DAYS = [dt.date(2021, 7, 25), dt.date(2021, 7, 26)]


def failing(spark):
    return spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id"))


@pytest.mark.parametrize("kind", ["managed", "external", "jdbc"])
def test_failed_replace_leaves_the_old_table(spark, kind):
    table = f"safe_{uuid.uuid4().hex}"
    if kind == "jdbc":
        warehouse = {"kind": "jdbc", "options": jdbc_options(spark)}
    elif kind == "external":
        warehouse = {"kind": "spark", "path": scratch_path(spark, "tables")}
    else:
        warehouse = {"kind": "spark"}
    assert write_table(spark.range(10), table, warehouse) == 10
    with pytest.raises(Exception, match="broken"):
        write_table(failing(spark), table, warehouse)
    assert read_table(spark, table, warehouse).count() == 10
    twice = spark.range(4).union(spark.range(4))
    with pytest.raises(RuntimeError, match="share a id"):
        write_table(twice, table, warehouse, unique="id")
    assert read_table(spark, table, warehouse).count() == 10
    assert write_table(spark.range(3), table, warehouse, unique="id") == 3
    assert read_table(spark, table, warehouse).count() == 3
    if kind != "jdbc":
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]


def test_two_days_by_sql_text_with_tables_named_like_views(spark):
    staging, suffix = scratch_path(spark, "staging"), uuid.uuid4().hex
    dim, fact = f"dim_{suffix}", f"fact_{suffix}"
    mine = spark.range(7)
    mine.createOrReplaceTempView("members")
    for day in DAYS:
        rows = spark.createDataFrame([(1, "a"), (2, "b")][: 1 + DAYS.index(day)], "id int, x string")
        rows.withColumn("load_date", F.lit(day)).write.mode("append").partitionBy("load_date").parquet(f"{staging}/members")
    targets = [
        {"name": dim, "table": dim, "sources": "members", "query": "select distinct id from members where load_date = :load_date"},
        {"name": fact, "table": fact, "targets": dim, "day_sources": "members", "query": f"select m.* from members m join {dim} d on m.id = d.id"},
    ]
    for n, day in enumerate(DAYS, 1):
        done = plans.load(spark, targets, staging, {"kind": "spark"}, day)
        assert [r["rows"] for r in done] == [n, n]
        assert read_table(spark, fact, {"kind": "spark"}).count() == n
    assert spark.table("members").count() == 7
    assert spark.catalog.dropTempView("members")
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name in (dim, fact)]


@pytest.mark.parametrize("to", ["smallint", "int", "bigint"])
def test_typed_values_cast_as_they_are(spark, to):
    values = [
        (12.0, "double"),
        (3.0, "float"),
        (1.0e10, "double"),
        (True, "boolean"),
        (70000, "int"),
        (None, "double"),
    ]
    for value, kind in values:
        df = spark.createDataFrame([(value,)], f"v {kind}")
        got = df.select(safe_cast("v", to).alias("x"), F.col("v").try_cast(to).alias("y")).first()
        assert got.x == got.y, (value, kind)
    exact = spark.sql("select cast(12.00 as decimal(10,2)) as v")
    assert exact.select(safe_cast("v", to)).first()[0] == 12


def test_one_member_on_two_days_has_one_key(spark):
    rows = [("m", "1", "2", "r", "L", "c", "g", "x", day) for day in DAYS]
    columns = "member_id string, country_code string, registration_id string, registration_date string, loyalty_id string, channel string, gender string, member_city string, load_date date"
    members = spark.createDataFrame(rows, columns)
    addresses = spark.createDataFrame([("m", "s", "c", "t")], "consumer_id string, street string, city string, state string")
    dim = plans.member_dim(members, addresses, key="stable").collect()
    assert len(dim) == 2 and len({r.member_key for r in dim}) == 1
    other = plans.member_dim(members, addresses, key="stable", key_columns=["member_id", "load_date"])
    assert other.select("member_key").distinct().count() == 2
    daily = plans.member_dim_daily(members, DAYS[0], key="stable").first()
    assert daily.member_key == dim[0].member_key


def test_names_given_twice_are_refused(spark):
    with pytest.raises(ValueError, match="sources share a name: a"):
        plans.ingest(spark, [{"name": "a"}, {"name": "a"}], "/none", DAYS[0])
    with pytest.raises(ValueError, match="targets share a name: a"):
        plans.load(spark, [{"name": "a", "table": "t"}, {"name": "a", "table": "u"}], "/none", {"kind": "spark"}, DAYS[0])


def test_key_join_counts_before_the_shuffle_and_repeats_rows(spark, monkeypatch):
    monkeypatch.setattr("stagewright.operators.joins.COPY_BLOCK", 4)
    left = spark.createDataFrame([(1, 7), (2, 8), (3, None), (4, 9)], "id int, k bigint")
    hot = spark.range(999).select(F.lit(7).cast("bigint").alias("member_id"))
    right = hot.union(spark.createDataFrame([(8,), (None,)], "member_id bigint"))
    got = ops.left_join_keys(left, right, "k", "member_id", ["id"])
    assert got.columns == ["id", "k", "member_id"]
    counts = {(r.id, r.member_id): r["count"] for r in got.groupBy("id", "member_id").count().collect()}
    assert counts == {(1, 7): 999, (2, 8): 1, (3, None): 1, (4, None): 1}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_split_reads_ask_once_per_level(monkeypatch):
    clusters, width = [10_000_000 * i for i in range(1000)], 50
    keys = [c + i for c in clusters for i in range(width)]
    asked = []

    def rows(spark, url, query, options):
        asked.append(query)
        if query.startswith("select min("):
            return [(keys[0], keys[-1])]
        import duckdb
        import pandas as pd

        keyed = pd.DataFrame({"k": keys})  # noqa: F841  read by the query
        return duckdb.sql(query).fetchall()

    monkeypatch.setattr(jdbc, "_rows", rows)
    cuts = jdbc.even_cuts(None, "", "keyed", "k", 2000)
    assert len(asked) <= 12
    edges = [keys[0], *cuts, keys[-1] + 1]
    sizes = [sum(a <= k < b for k in keys) for a, b in zip(edges[:3], edges[1:4])]
    assert max(sizes) <= 2 * len(keys) / 2000


def test_tables_of_a_jdbc_warehouse_are_split(spark):
    warehouse = {"kind": "jdbc", "options": jdbc_options(spark)}
    table = f"wide_{uuid.uuid4().hex}"
    write_table(spark.range(1000), table, warehouse)
    seen = {}

    def build(views, day):
        seen["parts"] = views["w"].rdd.getNumPartitions()
        return views["w"]

    spec = {"name": "t", "table": f"copy_{uuid.uuid4().hex}", "build": build}
    wide = {"table": table, "split_column": '"id"', "partitions": 4}
    done = plans.load(spark, [spec | {"tables": {"w": wide}}], "/none", warehouse, DAYS[0])
    assert done[0]["rows"] == 1000 and seen["parts"] >= 4


def test_failed_target_is_reported_and_left_whole(spark):
    table, staging = f"kept_{uuid.uuid4().hex}", scratch_path(spark, "staging")
    write_table(spark.range(3), table, {"kind": "spark"})
    target = {"name": "t", "table": table, "build": lambda views, day: failing(spark)}
    with pytest.raises(LoadError, match="broken"):
        plans.load(spark, [target], staging, {"kind": "spark"}, DAYS[0])
    assert spark.table(table).count() == 3


def test_receipts_have_many_products_and_several_dates(spark, sf_dir):
    receipts = inputs.receipts(spark, sf_dir)
    assert receipts.filter(item_count("products") > 2).count() > 0
    assert receipts.filter("products is null").count() > 0
    dates = receipts.groupBy("txn_id").agg(F.count_distinct("load_date").alias("n"))
    assert dates.filter("n > 1").count() > 0


def test_history_of_receipts_is_filtered_at_its_scan(spark, tmp_path):
    day = spark.range(20).select(F.col("id").alias("k"), F.lit(DAYS[0]).alias("d"))
    day.write.parquet(str(tmp_path / "day"))
    spark.range(20000).select((F.col("id") % 5000).alias("rk"), F.lit(DAYS[1]).alias("rd")).write.parquet(str(tmp_path / "all"))
    before = {}
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }.items():
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    try:
        left = spark.read.parquet(str(tmp_path / "day")).where(F.col("d") == DAYS[0])
        matched, rest = ops.left_join_dated(left, spark.read.parquet(str(tmp_path / "all")), "k", "rk", DAYS[0], "rd")
        plan = rest._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        assert rest.count() == 0 and matched.count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_decimal_key_text_meets_whole_numbers_on_request(spark):
    left = spark.createDataFrame([(12,), (13,)], "k bigint")
    right = spark.createDataFrame([("12.0",), ("13",), ("x",)], "t string")
    assert ops.inner_join(left, right, "k", "t").count() == 1
    assert ops.inner_join(left, right, "k", "t", truncate=True).count() == 2
    keys = ops.left_join_keys(left, right, "k", "t", truncate=True)
    assert keys.where("t is not null").count() == 2
