"""Expressions on literal rows, in both ANSI modes."""

import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from stagewright import functions as fn


@pytest.fixture(params=["true", "false"], autouse=True)
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, to, strict, truncated",
    [
        ("abc", "bigint", None, None),
        ("70000", "smallint", None, None),
        ("12", "int", 12, 12),
        (" 12 ", "int", 12, 12),
        ("12.7", "int", None, 12),
        ("-12.7", "int", None, -12),
        ("12.99999999999", "int", None, 12),
        (".5", "int", None, 0),
        ("12.", "int", None, 12),
        ("1.2.3", "int", None, None),
        ("1e3", "int", None, None),
        ("99999999999.5", "int", None, None),
        ("", "int", None, None),
        ("-", "int", None, None),
        (None, "int", None, None),
        ("+5", "int", 5, 5),
        ("\t5\x00", "int", 5, 5),
        ("5 5", "int", None, None),
        ("0000000000000000000000007", "smallint", 7, 7),
        ("32767", "smallint", 32767, 32767),
        ("-32768", "smallint", -32768, -32768),
        ("-32769", "short", None, None),
        ("2147483647", "int", 2147483647, 2147483647),
        ("2147483648", "integer", None, None),
        ("1234567890123456789012", "int", None, None),
        ("9223372036854775807", "bigint", 2**63 - 1, 2**63 - 1),
        ("-9223372036854775808", "long", -(2**63), -(2**63)),
        ("9223372036854775808", "bigint", None, None),
        ("-9223372036854775808.9", "bigint", None, -(2**63)),
        ("abc", "date", None, None),
        ("1.5", "decimal(3,1)", decimal.Decimal("1.5"), decimal.Decimal("1.5")),
    ],
)
def test_safe_cast(spark, text, to, strict, truncated):
    assert one(spark, text, "string", fn.safe_cast("v", to)) == strict
    assert one(spark, text, "string", fn.safe_cast("v", to, truncate=True)) == truncated


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(alphabet="0123456789+-. ex\t\n\x00\x1f\x7f\u00a0\u0661", max_size=7)))
def test_casts_accept_what_try_cast_does(texts):
    spark = SparkSession.getActiveSession()
    digits = ["99", "999999", "9999999999", "9999999999999999999", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in [*texts, *digits]], "v string")
    for to in ("tinyint", "smallint", "int", "bigint"):
        with_ansi = F.expr(f"try_cast(v as {to})")
        for cast in (fn.safe_cast, fn.key_cast):
            assert df.where(~cast("v", to).eqNullSafe(with_ansi)).collect() == []


def test_cast_to_string(spark):
    assert one(spark, 7, "bigint", fn.safe_cast("v", "string")) == "7"


@pytest.mark.parametrize(
    "text, count, legacy",
    [(None, None, -1), ("", 1, 1), ("a", 1, 1), ("a,b,,", 4, 4), (",", 2, 2)],
)
def test_item_count(spark, text, count, legacy):
    assert one(spark, text, "string", fn.item_count("v")) == count
    assert one(spark, text, "string", fn.item_count("v", legacy_null_size=True)) == legacy


def test_item_count_by_other_separator(spark):
    assert one(spark, "a|b", "string", fn.item_count("v", r"\|")) == 2


def test_arrays_with_nulls(spark):
    kind, values = "array<string>", ["a", None, "c"]
    assert one(spark, values, kind, fn.sorted_down("v")) == ["c", "a", None]
    assert one(spark, values, kind, fn.array_length("v")) == 3
    assert one(spark, values, kind, fn.array_has("v", "z")) is None
    assert one(spark, values, kind, fn.array_has("v", "a")) is True
    assert one(spark, ["a"], kind, fn.array_has("v", "z")) is False


def test_null_array(spark):
    kind = "array<string>"
    assert one(spark, None, kind, fn.sorted_down("v")) is None
    assert one(spark, None, kind, fn.array_length("v")) is None
    assert one(spark, None, kind, fn.array_length("v", legacy_null_size=True)) == -1
    assert one(spark, None, kind, fn.array_has("v", "z")) is None


def test_time_parts_of_text(spark):
    parts = fn.time_parts("v", text=True)
    assert [one(spark, "abc", "string", part) for part in parts.values()] == [None] * 4
    stamp = "2021-07-25 13:14:15.9"
    day, *clock = (one(spark, stamp, "string", part) for part in parts.values())
    assert str(day) == "2021-07-25" and clock == [13, 14, 15]


@pytest.mark.parametrize(
    "company, tier",
    [("FamilyCo", "Premium"), ("OldCo", "Legacy"), ("Other", "Standard"), (None, "Standard")],
)
def test_tier(spark, company, tier):
    assert one(spark, company, "string", fn.tier("v")) == tier


def test_tier_without_cases(spark):
    assert one(spark, "x", "string", fn.tier("v", {}, "all")) == "all"


def test_null_marker(spark):
    assert one(spark, 1, "int", fn.null_marker()) is None
    assert one(spark, 1, "int", fn.null_marker(as_text=True)) == "@NULL@"
    assert one(spark, "@NULL@", "string", fn.to_null("v")) is None
    assert one(spark, "x", "string", fn.to_null("v")) == "x"


def test_stable_key_tells_nulls_apart(spark):
    rows = [("a", None), (None, "a"), ("a", "a"), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = [r.k for r in df.select(fn.stable_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == len(rows)


def test_fresh_key_is_unique(spark):
    keys = spark.range(0, 1000, 1, 7).select(fn.fresh_key().alias("k"))
    assert keys.select(F.count_distinct("k")).first()[0] == 1000


@pytest.mark.parametrize("to", ["tinyint", "smallint", "int", "bigint"])
def test_typed_values_at_the_edges_of_a_range(spark, to):
    bits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}[to]
    edges = [s * 2**bits + d for s in (-1, 1) for d in (-2, -1, 0, 1, 2)]
    values = [(f"cast({e}{part} as {kind})", kind) for e in edges for kind, part in (("decimal(38,18)", ".999999999999999999"), ("decimal(20,0)", ""), ("double", ".5"), ("float", ""))]
    values += [(f"cast({e} as bigint)", "bigint") for e in edges if -(2**63) < e < 2**63]
    values += [(f"cast('{x}' as {kind})", kind) for x in ("NaN", "Infinity", "-Infinity", "-0.0") for kind in ("double", "float")]
    for value, kind in values:
        df = spark.sql(f"select {value} as v")
        got = df.select(fn.safe_cast("v", to).alias("x"), fn.safe_cast(F.col("v"), to).alias("z"), F.col("v").try_cast(to).alias("y")).first()
        assert got.x == got.y == got.z, (value, kind)


@pytest.mark.parametrize("truncate", [False, True])
@pytest.mark.parametrize("to", ["tinyint", "smallint", "int", "bigint"])
def test_a_name_and_a_column_are_cast_alike(spark, to, truncate):
    texts = ["12", " 12 ", "12.7", ".5", "-.5", ".", "", None, "x", "1e3", "+7", "-128", "128", "99999999999999999999", "007", "\x0012", "1 2", "-2147483649", "127.9", "1.2.3"]
    for df in (spark.createDataFrame([(t,) for t in texts], "v string"), spark.sql("select null as v"), spark.sql("select date'2020-01-01' is null as v")):
        got = df.select(fn.safe_cast("v", to, truncate).alias("x"), fn.safe_cast(F.col("v"), to, truncate).alias("y")).collect()
        assert all(r.x == r.y for r in got)
