"""Readers and writers, round trip."""

import datetime as dt
import uuid
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from stagewright.operators import on_date, stamp_load_date
from stagewright.plans.stages import as_list
from stagewright.session import scratch_path
from stagewright.sinks import stage, write_table
from stagewright.sources import (
    dated_path,
    key_bounds,
    read_delimited,
    read_documents,
    read_jdbc,
    read_query,
    read_staged,
    read_table,
)
from stagewright.sources.jdbc import even_cuts
from workload.sources import jdbc_options

FIRST, SECOND = dt.date(2021, 7, 24), dt.date(2021, 7, 25)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def database(spark):
    return {"kind": "jdbc", "options": jdbc_options(spark)}


def test_delimited_with_header_is_all_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id|name\n1|a\n2|\n")
    df = read_delimited(spark, str(tmp_path / "f.csv"))
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert rows(df) == [("1", "a"), ("2", None)]


def test_delimited_without_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1,a\n2,b\n")
    path = str(tmp_path / "f.csv")
    assert read_delimited(spark, path, ",", header=False).columns == ["_c0", "_c1"]
    named = read_delimited(spark, path, ",", header=False, columns=["id", "name"])
    assert named.columns == ["id", "name"] and named.count() == 2


def test_delimited_with_schema(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id|n\n1|2\nx|3\n")
    df = read_delimited(spark, str(tmp_path / "f.csv"), schema="id int, n bigint")
    assert rows(df) == sorted([(1, 2), (None, 3)], key=repr)


def test_delimited_through_another_format(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert read_delimited(spark, str(tmp_path / "p"), format="parquet").count() == 3


def test_documents_inferred_and_declared(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"b": 1, "a": {"x": "y"}}\n{"b": 2}\n')
    path = str(tmp_path / "d.json")
    assert read_documents(spark, path).columns == ["a", "b"]
    declared = read_documents(spark, path, "b int, a struct<x: string>")
    assert rows(declared.select("b", "a.x")) == [(1, "y"), (2, None)]


def test_dated_path():
    day = dt.date(2017, 10, 14)
    assert dated_path("/d/", "receipts_delta", day, "GBR") == "/d/receipts_delta_GBR_14_10_2017.csv"
    assert dated_path("/d", "receipts", day) == "/d/receipts_*_14_10_2017.csv"


def test_dated_path_of_all_countries(spark, tmp_path):
    for name in ("r_GBR_14_10_2017.csv", "r_FRA_14_10_2017.csv", "r_GBR_15_10_2017.csv"):
        (tmp_path / name).write_text(f"name\n{name}\n")
    df = read_delimited(spark, dated_path(str(tmp_path), "r", dt.date(2017, 10, 14)))
    assert df.count() == 2


def test_rows_outside_fixed_bounds_are_read(spark, database):
    table = f"t_{uuid.uuid4().hex}"
    write_table(spark.range(300), table, database)
    options = database["options"]
    df = read_jdbc(
        spark, table=table, split_column='"id"', partitions=2, bounds=(1, 100), **options
    )
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(sizes) == [50, 250]
    assert key_bounds(spark, options["url"], table, '"id"') == (0, 300)
    asked = read_jdbc(spark, table=table, split_column='"id"', partitions=2, **options)
    sizes = [r["count"] for r in asked.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(sizes) == [150, 150]


def test_jdbc_filter_and_columns_are_pushed(spark, database):
    table = f"t_{uuid.uuid4().hex}"
    write_table(spark.range(9).withColumn("x", F.col("id") * 2), table, database)
    df = read_jdbc(spark, table=table, **database["options"]).where("id > 4").select("id")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert "GreaterThan(id,4)" in text and "ReadSchema: struct<id:bigint>" in text
    assert df.count() == 4


def test_even_cuts_of_dense_and_sparse_keys(spark, database):
    table = f"t_{uuid.uuid4().hex}"
    dense = spark.range(5000, 6000)
    sparse = spark.range(0, 10**12, 10**10)
    no_key = spark.range(3).select(F.lit(None).cast("bigint").alias("id"))
    keys = dense.unionAll(sparse).unionAll(no_key)
    write_table(keys, table, database)
    options = database["options"]
    cuts = even_cuts(spark, table=table, column='"id"', partitions=4, **options)
    assert cuts == sorted(set(cuts))
    df = read_jdbc(spark, table=table, split_column='"id"', partitions=4, even=True, **options)
    assert rows(df) == rows(keys)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 350


def test_split_warehouse_reads(spark, database):
    table = f"t_{uuid.uuid4().hex}"
    keyed = spark.range(0, 400, 1, 4).select(F.xxhash64("id").alias("key"), "id")
    write_table(keyed, table, database)
    back = read_table(spark, table, database, '"key"', 4)
    assert rows(back) == rows(keyed) and back.rdd.getNumPartitions() >= 4
    sizes = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 150
    query = f'select "key" from {table} where "id" < 100'
    part = read_query(spark, query, database, '"key"', 4)
    assert rows(part) == rows(keyed.where("id < 100").select("key"))


@pytest.mark.parametrize("keys", [[], [7], [7] * 50, [-5, -4, 0, 9], [-(2**63), 2**63 - 1]])
def test_even_cuts_of_few_keys(spark, database, keys):
    table = f"t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(k,) for k in keys], "id bigint")
    write_table(df, table, database)
    options = database["options"]
    back = read_jdbc(spark, table=table, split_column='"id"', partitions=4, even=True, **options)
    assert rows(back) == rows(df)
    back = read_jdbc(spark, table=table, split_column='"id"', partitions=4, **options)
    assert rows(back) == rows(df)


def test_jdbc_overwrite_and_reads(spark, database):
    table = f"t_{uuid.uuid4().hex}"
    assert write_table(spark.range(10), table, database) == 10
    assert write_table(spark.range(4), table, database, num_files=2) == 4
    assert rows(read_table(spark, table, database)) == [(0,), (1,), (2,), (3,)]
    query = f'select max("id") as "top" from {table}'
    assert read_query(spark, query, database).first().top == 3


def test_jdbc_truncate_keeps_types(spark, database):
    table = f"t_{uuid.uuid4().hex}"
    write_table(spark.range(3), table, database)
    kept = {"kind": "jdbc", "options": {**database["options"], "truncate": "true"}}
    write_table(spark.range(2).select(F.col("id").cast("int")), table, kept)
    assert read_table(spark, table, database).dtypes == [("id", "bigint")]
    assert read_table(spark, table, database).count() == 2


def test_spark_table_overwrite_and_files(spark):
    path = scratch_path(spark, "tables")
    warehouse = {"kind": "spark", "path": path}
    table = f"t_{uuid.uuid4().hex}"
    assert write_table(spark.range(0, 100, 1, 8), table, warehouse) == 100
    assert write_table(spark.range(0, 50, 1, 8), table, warehouse, num_files=3) == 50
    df = read_table(spark, table, warehouse)
    assert df.count() == 50 and len(df.inputFiles()) == 3
    assert read_query(spark, f"select count(*) as n from {table}", warehouse).first().n == 50
    managed = f"t_{uuid.uuid4().hex}"
    write_table(spark.range(2), managed, {"kind": "spark"})
    assert spark.table(managed).count() == 2


def _batch(spark, date, *ids):
    return stamp_load_date(spark.createDataFrame([(i,) for i in ids], "id int"), date)


def test_static_and_dynamic_staging(spark):
    for mode, dates in (("static", {SECOND}), ("dynamic", {FIRST, SECOND})):
        root = scratch_path(spark, "staging")
        assert stage(_batch(spark, FIRST, 1, 2), root, "s", mode) == 2
        assert stage(_batch(spark, SECOND, 3), root, "s", mode) == 1
        back = read_staged(spark, root, "s")
        assert back.dtypes == [("id", "int"), ("load_date", "date")]
        assert {r.load_date for r in back.collect()} == dates
    with pytest.raises(ValueError):
        stage(_batch(spark, FIRST, 1), root, "s", "append")


def test_rerun_of_a_day_replaces_it(spark):
    root = scratch_path(spark, "staging")
    stage(_batch(spark, FIRST, 1, 2), root, "s", "dynamic")
    stage(_batch(spark, SECOND, 3, 4), root, "s", "dynamic")
    stage(_batch(spark, SECOND, 3, 4), root, "s", "dynamic")
    assert rows(read_staged(spark, root, "s")) == [
        (1, FIRST),
        (2, FIRST),
        (3, SECOND),
        (4, SECOND),
    ]


def test_staged_day_lists_its_folder_only(spark):
    root = scratch_path(spark, "staging")
    stage(_batch(spark, FIRST, 1).unionAll(_batch(spark, SECOND, 2)), root, "s")
    df = read_staged(spark, root, "s", SECOND)
    assert df.dtypes == [("id", "int"), ("load_date", "date")]
    assert rows(df) == [(2, SECOND)]
    assert all("load_date=2021-07-25" in name for name in df.inputFiles())
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_staged(spark, root, "s", dt.date(2021, 7, 26))


def test_filter_on_staged_dates_prunes_folders(spark):
    root = scratch_path(spark, "staging")
    stage(_batch(spark, FIRST, 1).unionAll(_batch(spark, SECOND, 2)), root, "s")
    df = on_date(read_staged(spark, root, "s"), "load_date", SECOND)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    text = df._jdf.queryExecution().explainString(mode)
    assert "PartitionFilters: [isnotnull(load_date" in text and "DataFilters: []" in text
    assert rows(df) == [(2, SECOND)]


def test_rebalance_writes_few_files_per_date(spark):
    days = spark.range(0, 800, 1, 8).select(
        "id", F.date_add(F.lit(FIRST), (F.col("id") % 4).cast("int")).alias("load_date")
    )
    files = {}
    for rebalance in (False, True):
        root = scratch_path(spark, "staging")
        assert stage(days, root, "s", rebalance=rebalance) == 800
        back = read_staged(spark, root, "s")
        assert rows(back) == rows(days)
        files[rebalance] = len(back.inputFiles())
    assert files == {False: 32, True: 4}


def _session(master, shared):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_path_is_fresh_and_shared():
    cluster = _session("spark://host:7077", "hdfs://shared/")
    one, two = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert one != two and one.startswith("hdfs://shared/x-")
    assert scratch_path(_session("local[8]", "/shared"), "x").startswith("/shared/x-")
    assert scratch_path(_session("local[8]", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_session("spark://host:7077", None), "x")


def test_one_name_or_a_list():
    assert as_list("a") == ["a"] and as_list(["a", "b"]) == ["a", "b"] and as_list(None) == []
