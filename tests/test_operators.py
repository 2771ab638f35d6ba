"""Operators on small tables, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from stagewright import operators as ops

DAY, OTHER = dt.date(2021, 7, 25), dt.date(2021, 7, 24)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_stamp_defaults_to_today(spark):
    stamped = ops.stamp_load_date(spark.range(1))
    today = spark.sql("select current_date()").first()[0]
    assert stamped.first().load_date == today
    assert ops.stamp_load_date(spark.range(1), DAY).first().load_date == DAY


def test_flatten_document_without_address(spark):
    schema = "id int, address struct<street: string, city: string>"
    documents = spark.createDataFrame([(1, ("s", "c")), (2, None)], schema)
    flat = ops.drop_columns(
        ops.flatten_struct(documents, "address", ["street", "city"]), "address", "_id"
    )
    assert rows(flat) == [(1, "s", "c"), (2, None, None)]
    renamed = ops.flatten_struct(documents, "address", {"Street": "street"})
    assert renamed.columns == ["id", "address", "Street"]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_on_date_by_type(spark, kind):
    texts = ["2021-07-24 23:59:59", "2021-07-25", "2021-07-25 10:11:12", "2021-07-26", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").cast(kind).alias("d"))
    assert ops.on_date(df, "d", DAY).count() == 2
    assert ops.on_date_or_missing(df, "d", DAY).count() == 3


def test_on_date_ignores_text_that_is_no_date(spark):
    df = spark.createDataFrame([("abc",), ("2021-07-25",)], "d string")
    assert rows(ops.on_date(df, "d", DAY)) == [("2021-07-25",)]


def test_text_dates_count_by_what_they_cast_to(spark, tmp_path):
    texts = ["2021-07-24", "2021-07-25", "2021-07-25x", "2021-07-251", "2021-07-25 01:02:03", None]
    texts += ["2021-7-25", " 2021-07-25"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    df.write.parquet(str(tmp_path / "t"))
    day = ops.on_date(spark.read.parquet(str(tmp_path / "t")), "d", DAY)
    assert {r.d for r in day.collect()} == {texts[1], texts[4], texts[6], texts[7]}
    today = ops.on_date(ops.stamp_load_date(spark.range(2)), "load_date")
    as_text = ops.stamp_load_date(spark.range(2)).withColumn("t", F.col("load_date").cast("string"))
    assert today.count() == ops.on_date(as_text, "t").count() == 2


def test_filters_reach_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = ops.present(ops.on_date(lines, "l_shipdate", DAY), "l_linenumber")
    text = plan(day.select("l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "IsNotNull(l_linenumber)" in text
    assert "l_comment" not in text and "ReadSchema: struct<l_orderkey:bigint,l_linenumber" in text


@pytest.mark.parametrize("join", [ops.inner_join, ops.left_join])
@pytest.mark.parametrize("text_side", ["left", "right"])
def test_mixed_key_types(spark, join, text_side):
    numbers = [(7, "n7"), (8, "n8")]
    texts = [("abc", "t"), ("7", "t7")]
    left, right = (texts, numbers) if text_side == "left" else (numbers, texts)
    kinds = ("string", "bigint") if text_side == "left" else ("bigint", "string")
    joined = join(
        spark.createDataFrame(left, f"lk {kinds[0]}, l string"),
        spark.createDataFrame(right, f"rk {kinds[1]}, r string"),
        "lk",
        "rk",
    )
    matched = {(l, r) for _, l, _, r in rows(joined) if r is not None}
    assert matched == ({("t7", "n7")} if text_side == "left" else {("n7", "t7")})
    assert joined.count() == (1 if join is ops.inner_join else 2)


def _broadcast_off(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    return {key: "-1" for key in keys}


@pytest.fixture(params=["broadcast", "sort-merge"])
def strategy(spark, request):
    if request.param == "broadcast":
        yield request.param
        return
    for key, value in _broadcast_off(spark).items():
        spark.conf.set(key, value)
    yield request.param
    for key in _broadcast_off(spark):
        spark.conf.unset(key)


def _random_sides(seed):
    rng = random.Random(seed)

    def pick_key(hot):
        return hot if rng.random() < 0.33 else rng.choice([None, *range(12)])

    left = [(pick_key(3), i) for i in range(80)]
    right = [(pick_key(5), 1000 + i, rng.choice([DAY, OTHER, None])) for i in range(80)]
    return left, right


@pytest.mark.parametrize("seed", range(4))
def test_left_join_dated_is_join_then_filter(spark, strategy, seed):
    left, right = _random_sides(seed)
    expected = []
    for key, i in left:
        partners = [r for r in right if key is not None and r[0] == key]
        if not partners:
            expected.append((key, i, None))
        expected += [(key, i, r[1]) for r in partners if r[2] in (DAY, None)]

    left_df = spark.createDataFrame(left, "lk bigint, i int")
    right_df = spark.createDataFrame(right, "rk bigint, j int, d date")
    matched, unmatched = ops.left_join_dated(left_df, right_df, "lk", "rk", DAY, "d")
    both = matched.unionByName(unmatched, allowMissingColumns=True).select("lk", "i", "j")
    assert rows(both) == sorted(expected, key=repr)

    plainly = ops.left_join(left_df, right_df, "lk", "rk")
    kept = ops.on_date_or_missing(plainly, "d", DAY).select("lk", "i", "j")
    assert rows(kept) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_left_join_forms_give_the_same_rows(spark, strategy, seed):
    left, right = _random_sides(seed)
    left_df = spark.createDataFrame(left, "lk bigint, i int")
    right_df = spark.createDataFrame(right, "rk bigint, j int, d date")
    plain = ops.left_join(left_df, right_df, "lk", "rk")
    spread = ops.left_join(left_df, right_df, "lk", "rk", spread_nulls_by=["i"])
    split = ops.left_join(left_df, right_df, "lk", "rk", hot_right=True)
    assert spread.columns == split.columns == plain.columns
    assert rows(spread) == rows(plain) and rows(split) == rows(plain)
    assert split.dtypes == plain.dtypes


def test_null_keys_go_to_many_partitions(spark):
    for key, value in _broadcast_off(spark).items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.createDataFrame([(None, i) for i in range(1000)], "lk bigint, id int")
        right = spark.createDataFrame([(i,) for i in range(10)], "rk bigint")
        spread = ops.left_join(left, right, "lk", "rk", spread_nulls_by=["id"])
        plain = ops.left_join(left, right, "lk", "rk")
        parts = [
            len({r.p for r in df.select("rk", F.spark_partition_id().alias("p")).collect()})
            for df in (spread, plain)
        ]
        assert parts[0] > 1 and parts[1] == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        for key in _broadcast_off(spark):
            spark.conf.unset(key)


@pytest.fixture
def skew_shows(spark):
    """Thresholds low enough for test data to count as skewed."""
    conf = {
        **_broadcast_off(spark),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_hot_keys_are_split(spark, skew_shows):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint")
    many = spark.range(0, 30000, 1, 8).select(
        hot.alias("lk"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    few = spark.range(0, 30000, 1, 8).select(F.col("id").alias("rk"), F.lit("y").alias("y"))
    dated = many.select(F.col("lk").alias("rk"), "x", F.lit(DAY).alias("d"))
    one = few.select(F.col("rk").alias("lk"))
    left_hot = {
        "left": ops.left_join(many, few, "lk", "rk", spread_nulls_by=["x"]),
        "left, hot right": ops.left_join(one, dated, "lk", "rk", hot_right=True),
        "inner": ops.inner_join(many, few, "lk", "rk"),
        "dated, hot partner": ops.left_join_dated(one, dated, "lk", "rk", DAY, "d")[0],
        "dated, hot left": ops.left_join_dated(
            many, few.withColumn("d", F.lit(OTHER)), "lk", "rk", DAY, "d"
        )[1],
        "distinct": ops.distinct_join(
            many.withColumn("n", F.monotonically_increasing_id()), few, "lk", "rk"
        ),
    }
    unsplit = [name for name, df in left_hot.items() if "skew=true" not in _final_plan(df)]
    assert not unsplit


@pytest.mark.parametrize("seed", range(3))
def test_distinct_join_is_distinct_of_join(spark, strategy, seed):
    left, right = _random_sides(seed)
    left = [(None if k is None else str(k), i // 40) for k, i in left] + [("05", 1), ("x", 0)]
    right = [(k, j // 1040) for k, j, _ in right]
    expected = {
        (k, i, j)
        for k, i in left
        for rk, j in right
        if k is not None and k.isdigit() and rk is not None and int(k) == rk
    }
    joined = ops.distinct_join(
        spark.createDataFrame(left, "lk string, i int"),
        spark.createDataFrame(right, "rk bigint, j int"),
        "lk",
        "rk",
    )
    assert joined.columns == ["lk", "i", "j"]
    assert rows(joined) == sorted(expected, key=repr)


def test_distinct_join_with_text_keys_that_mean_one_number(spark):
    joined = ops.distinct_join(
        spark.createDataFrame([(1, "a")], "lk bigint, i string"),
        spark.createDataFrame([("1", "b"), ("01", "b")], "rk string, j string"),
        "lk",
        "rk",
    )
    assert rows(joined) == [(1, "a", "b")]


def test_star_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "c", "d")], "j int, y string, z string")
    joined = ops.star_join(left, right, "k", "j", "y")
    assert joined.columns == ["k", "x", "y"] and rows(joined) == [(1, "a", "c")]


def test_unique_values(spark):
    data = [("a", "x"), ("a", "x"), ("a", None), ("b", None), (None, "y")]
    df = ops.unique_values(spark.createDataFrame(data, "k string, v string"), "k", "v")
    assert rows(df) == sorted([("a", ["x"]), ("b", []), (None, ["y"])], key=repr)


def test_stable_keys_repeat_and_duplicates_show(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    first = ops.add_key(df, "key", "stable")
    again = ops.add_key(df.repartition(5), "key", "stable")
    assert rows(first) == rows(again)
    assert ops.duplicate_keys(first, "key").count() == 0
    twice = ops.duplicate_keys(first.unionAll(first), "key")
    assert {r["rows"] for r in twice.collect()} == {2} and twice.count() == 50
    with pytest.raises(ValueError):
        ops.add_key(df, "key", "other")


def test_preview(spark):
    df = spark.range(100)
    assert ops.preview(df, 5).count() == 5
    assert rows(ops.preview(df, 2, ["id"])) == [(0,), (1,)]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_time_parts_by_type(spark, kind):
    df = spark.createDataFrame([("2021-07-25 13:14:15.5",), (None,)], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").cast(kind).alias("t"))
    first, second = ops.with_time_parts(df, "t", "p_").collect()
    clock = (0, 0, 0) if kind == "date" else (13, 14, 15)
    assert (first.p_date, first.p_hour, first.p_minute, first.p_second) == (DAY, *clock)
    assert [second[name] for name in ("p_date", "p_hour", "p_minute", "p_second")] == [None] * 4


def test_a_date_equals_the_day_of_a_timestamp_with_time(spark):
    moments = spark.sql("select timestamp_ntz'2021-07-25 23:59:59.999999' as d")
    assert ops.on_date(moments, "d", DAY).count() == 1
    assert ops.on_date(moments, "d", OTHER).count() == 0
