"""Whole loads and the two stages."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from stagewright import plans
from stagewright.plans import LoadError
from stagewright.session import scratch_path
from stagewright.sinks import write_table
from stagewright.sources import read_staged, read_table
from workload.sources import jdbc_options

DAY, OTHER = dt.date(2021, 7, 25), dt.date(2021, 7, 24)

MEMBER_SCHEMA = (
    "member_id string, country_code string, registration_id string, registration_date string,"
    " loyalty_id string, channel string, gender string, member_city string, child_id string,"
    " child_number string, child_gender string, load_date date"
)


def member(member_id, child=None, date=DAY, country="44", registration="1"):
    person = (member_id, country, registration, "2020-01-01", "L", "web", "F", "Leeds")
    return (*person, child, "1", "M", date)


@pytest.fixture
def members(spark):
    return spark.createDataFrame(
        [
            member("1"),
            member("1"),
            member("2", child="c1", country="70000", registration="abc"),
            member("2", child="c1", country="70000", registration="abc"),
            member("3", child="c2", date=OTHER, registration="12.7"),
            member("x"),
        ],
        MEMBER_SCHEMA,
    )


@pytest.fixture
def addresses(spark):
    rows = [(1, "s1", "c1", "t1"), (1, "s1", "c1", "t1"), (2, None, None, None), (3, "s", "c", "t")]
    schema = "consumer_id bigint, street string, city string, state string"
    return spark.createDataFrame(rows, schema)


def test_member_dim(members, addresses):
    dim = plans.member_dim(members, addresses)
    assert len(dim.columns) == 13 and dim.columns[0] == "member_key"
    assert dim.columns[-1] == "load_date"
    types = dict(dim.dtypes)
    assert types["country_code"] == "smallint" and types["registration_id"] == "int"
    found = {r.member_id: r for r in dim.collect()}
    assert dim.count() == 3 and set(found) == {"1", "2", "3"}
    assert found["2"].country_code is None and found["2"].registration_id is None
    assert found["2"].street is None and found["3"].registration_id is None
    truncated = plans.member_dim(members, addresses, truncate=True)
    assert truncated.where("member_id = '3'").first().registration_id == 12


def test_member_dim_daily(members):
    dim = plans.member_dim_daily(members, DAY)
    assert len(dim.columns) == 10
    assert sorted(r.member_id for r in dim.collect()) == ["1", "2", "x"]


def test_child_dim(members):
    dim = plans.child_dim(members, DAY)
    assert len(dim.columns) == 7
    assert [r.child_id for r in dim.collect()] == ["c1"]


def test_stable_keys_survive_a_rerun(members, addresses):
    first, again = (
        {r.member_id: r.member_key for r in plans.member_dim(df, addresses, "stable").collect()}
        for df in (members, members.repartition(5))
    )
    assert first == again and len(set(first.values())) == 3


TRANSACTION_SCHEMA = (
    "txn_id bigint, points_value int, retail_value double, external_reference string,"
    " activity_ts string, mobile_uid string, mobile_os string, receipt_status string,"
    " msg_code string, load_date date"
)


def transaction(txn_id, ts="2021-07-25 13:14:15.9", code="17", date=DAY):
    return (txn_id, 5, 9.5, "sale", ts, "u", "os", "ok", code, date)


@pytest.fixture
def transactions(spark):
    rows = [
        transaction(1),
        transaction(2, ts="abc", code="n/a"),
        transaction(3),
        transaction(4),
        transaction(5, date=OTHER),
        transaction(6),
        transaction(None),
    ]
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


@pytest.fixture
def receipts(spark):
    rows = [
        ("1", "m1", "a,b,,", "7", DAY),
        ("3", "m1", "a", "7", OTHER),
        ("4", None, None, "7", None),
        ("5", "m2", "a", "7", DAY),
        ("6", "m3", "", "7", DAY),
        ("6", "m4", "a", "7", OTHER),
        ("abc", "m1", "a", "7", DAY),
        (None, "m1", "a", "7", DAY),
    ]
    schema = "txn_id string, loyalty_id string, products string, base_points string, load_date date"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("m1",), ("m3",), ("m3",)], "member_id string")


@pytest.mark.parametrize("one_pass", [False, True])
def test_txn_fact(transactions, receipts, dim, one_pass):
    fact = plans.txn_fact(transactions, receipts, dim, DAY, one_pass=one_pass)
    assert len(fact.columns) == 24
    found = sorted(
        ((r.txn_id, r.item_qty, r.member_id, r.txn_hour) for r in fact.collect()), key=repr
    )
    assert found == sorted(
        [
            ("1", 4, "m1", 13),
            ("2", None, None, None),
            ("4", None, None, 13),
            ("6", 1, "m3", 13),
            ("6", 1, "m3", 13),
            (None, None, None, 13),
        ],
        key=repr,
    )
    first = fact.where("txn_id = '1'").first()
    assert (first.gross_standard, first.currency_key, first.channel_key) == (0, -1, "-1")
    assert (first.txn_minute, first.txn_second, str(first.txn_date)) == (14, 15, "2021-07-25")
    assert first.ext_dec_1 is None and first.ext_dec_2 is None and first.ext_char_5 == 17
    assert fact.where("txn_id = '2'").first().ext_char_5 is None
    assert fact.select("txn_key").distinct().count() == 6


def test_txn_fact_in_legacy_form(transactions, receipts, dim):
    fact = plans.txn_fact(
        transactions, receipts, dim, DAY, marker_text=True, legacy_null_size=True
    )
    found = {r.txn_id: r for r in fact.collect()}
    assert found["2"].item_qty == -1 and found["2"].ext_dec_1 == "@NULL@"


def test_loads_have_no_single_task_exchange(spark, transactions, receipts, dim, members, addresses):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    loads = [
        plans.txn_fact(transactions, receipts, dim, DAY),
        plans.txn_fact(transactions, receipts, dim, DAY, one_pass=True),
        plans.member_dim(members, addresses),
        plans.member_dim_daily(members, DAY),
        plans.child_dim(members, DAY),
    ]
    for df in loads:
        text = df._jdf.queryExecution().explainString(mode)
        assert "SinglePartition" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_array_profile_of_null_array(spark):
    df = spark.createDataFrame([("a", ["x", "Movies"]), ("b", None)], "k string, v array<string>")
    found = {r.k: r for r in plans.array_profile(df, "k", "v").collect()}
    assert found["a"].ordered_values == ["x", "Movies"] and found["a"].has_wanted is True
    assert found["b"].value_count is None and found["b"].has_wanted is None


def test_company_tiers(spark):
    df = spark.createDataFrame(
        [("FamilyCo", ("Ann",)), ("OldCo", ("Bo",)), ("New", None)],
        "company string, employee struct<firstName: string>",
    )
    assert [tuple(r) for r in plans.company_tiers(df).orderBy("company").collect()] == [
        ("FamilyCo", "Ann", "Premium"),
        ("New", None, "Standard"),
        ("OldCo", "Bo", "Legacy"),
    ]


def test_sql_text_with_older_rules(spark):
    views = {"texts": spark.createDataFrame([("abc", None)], "v string, l string")}
    text = "select cast(v as bigint) as n, size(split(l, ',')) as c, :load_date as d from texts"
    before = spark.conf.get("spark.sql.ansi.enabled")
    row = plans.sql_load(spark, text, views, DAY, ansi=False).first()
    assert (row.n, row.c, row.d) == (None, -1, DAY)
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        plans.sql_load(spark, text, views, DAY, ansi=True).collect()


def _sources(spark, tmp_path):
    (tmp_path / "receipts_GBR_25_07_2021.csv").write_text("1|m1|a,b|7\n2|m2|a|7\n")
    (tmp_path / "members.csv").write_text("id|name\nm1|Ann\nm2|Bo\n")
    document = '{"_id": "d1", "consumer": "m1", "address": {"street": "s", "city": "c"}}\n'
    (tmp_path / "addresses.json").write_text(document)
    table, options = f"t_{uuid.uuid4().hex}", jdbc_options(spark)
    orders = spark.range(1, 4).select("id", F.lit(2.5).alias("value"))
    write_table(orders, table, {"kind": "jdbc", "options": options})
    url = options.pop("url")
    return [
        {
            "name": "transactions",
            "kind": "jdbc",
            "url": url,
            "table": f"(select * from {table}) t",
            "split_column": '"id"',
            "rename": {"id": "txn_id"},
            "options": options,
        },
        {
            "name": "receipts",
            "kind": "delimited",
            "path": str(tmp_path),
            "drop": "receipts",
            "country": "GBR",
            "header": False,
            "columns": ["txn_id", "loyalty_id", "products", "points"],
        },
        {"name": "members", "kind": "delimited", "path": str(tmp_path / "members.csv")},
        {
            "name": "addresses",
            "kind": "documents",
            "path": str(tmp_path / "addresses.json"),
            "flatten": {"address": ["street", "city"]},
            "drop_columns": ["address", "_id"],
        },
    ]


@pytest.mark.parametrize("parallel", [1, 3])
def test_ingest_then_load(spark, tmp_path, parallel):
    staging = scratch_path(spark, "staging")
    sources = _sources(spark, tmp_path)
    results = plans.ingest(spark, sources, staging, DAY, parallel=parallel)
    assert [(r["name"], r["rows"]) for r in results] == [
        ("transactions", 3),
        ("receipts", 2),
        ("members", 2),
        ("addresses", 1),
    ]
    assert read_staged(spark, staging, "addresses").columns == [
        "consumer",
        "street",
        "city",
        "load_date",
    ]
    assert read_staged(spark, staging, "transactions").columns == ["txn_id", "value", "load_date"]

    warehouse = {"kind": "spark", "path": scratch_path(spark, "tables")}
    suffix = uuid.uuid4().hex
    targets = [
        {
            "name": "dim",
            "table": f"dim_{suffix}",
            "sources": "members",
            "build": lambda views, day: views["members"].where(F.col("load_date") == day),
            "rename": {"name": "member_name"},
        },
        {
            "name": "fact",
            "table": f"fact_{suffix}",
            "sources": ["transactions", "receipts"],
            "targets": "dim",
            "tables": {"same_dim": f"dim_{suffix}"},
            "query": """
              select t.txn_id, d.member_name, s.id from transactions t
              left join receipts r on t.txn_id = try_cast(r.txn_id as bigint)
              left join dim d on r.loyalty_id = d.id
              left join same_dim s on s.id = d.id
              where t.load_date = :load_date""",
        },
    ]
    for _ in range(2):
        results = plans.load(spark, targets, staging, warehouse, DAY)
        assert [r["rows"] for r in results] == [2, 3]
    fact = read_table(spark, f"fact_{suffix}", warehouse)
    assert sorted(tuple(r) for r in fact.where("id is not null").collect()) == [
        (1, "Ann", "m1"),
        (2, "Bo", "m2"),
    ]


def test_shown_rows_are_the_written_ones(spark, tmp_path, capsys):
    staging = scratch_path(spark, "staging")
    plans.ingest(spark, _sources(spark, tmp_path)[2:3], staging, DAY, show_rows=1)
    shown = capsys.readouterr().out
    assert "only showing top 1 row" in shown and "|-- load_date: date" in shown
    warehouse = {"kind": "jdbc", "options": jdbc_options(spark)}
    target = {"name": "m", "table": "m", "sources": "members", "query": "select id from members"}
    plans.load(spark, [target], staging, warehouse, DAY, show_rows=5)
    assert "|m1 |" in capsys.readouterr().out


def test_failed_source_does_not_stop_others(spark, tmp_path):
    staging = scratch_path(spark, "staging")
    sources = _sources(spark, tmp_path)
    sources[1]["country"] = "FRA"
    with pytest.raises(LoadError) as error:
        plans.ingest(spark, sources, staging, DAY)
    assert [r["status"] == "done" for r in error.value.results] == [True, False, True, True]


def test_failed_target_stops_its_dependants(spark, tmp_path):
    staging = scratch_path(spark, "staging")
    plans.ingest(spark, _sources(spark, tmp_path), staging, DAY)
    warehouse = {"kind": "spark", "path": scratch_path(spark, "tables")}
    suffix = uuid.uuid4().hex
    targets = [
        {"name": "a", "table": f"a_{suffix}", "sources": "members", "query": "select no from x"},
        {"name": "b", "table": f"b_{suffix}", "targets": "a", "query": "select * from a"},
        {"name": "c", "table": f"c_{suffix}", "sources": "members", "query": "table members"},
    ]
    with pytest.raises(LoadError) as error:
        plans.load(spark, targets, staging, warehouse, DAY)
    statuses = [r["status"].split(":")[0] for r in error.value.results]
    assert statuses == ["failed", "skipped", "done"]


def test_targets_are_checked_before_any_runs(spark):
    late = [{"name": "b", "table": "b", "targets": "a"}, {"name": "a", "table": "a"}]
    with pytest.raises(ValueError, match="listed before"):
        plans.load(spark, late, "/none", {"kind": "spark"}, DAY)
    same = [{"name": "a", "table": "t"}, {"name": "b", "table": "t"}]
    with pytest.raises(ValueError, match="overwrite"):
        plans.load(spark, same, "/none", {"kind": "spark"}, DAY)


def _simple_plan(df):
    df.collect()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode).split("Initial Plan")[0]


def test_staged_fact_prunes_dates_and_shuffles_the_day_once(spark, transactions, receipts, dim):
    off = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    root = scratch_path(spark, "staging")
    for name, df in (("transactions", transactions), ("receipts", receipts)):
        df.write.partitionBy("load_date").parquet(f"{root}/{name}")
    staged = [read_staged(spark, root, name) for name in ("transactions", "receipts")]
    for key in off:
        spark.conf.set(key, "-1")
    try:
        text = _simple_plan(plans.txn_fact(*staged, dim, DAY))
    finally:
        for key in off:
            spark.conf.unset(key)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    of_day = [s for s in scans if "PartitionFilters: [isnotnull(load_date" in s]
    with_undated = [s for s in scans if "OR isnull(load_date" in s]
    key_only = [s for s in scans if "ReadSchema: struct<txn_id:string>" in s]
    assert [len(s) for s in (scans, of_day, with_undated, key_only)] == [4, 2, 1, 1]
    assert "ReusedExchange" in text


def test_star_in_a_jdbc_warehouse(spark, members, addresses, transactions, receipts):
    staging = scratch_path(spark, "staging")
    staged = {
        "members": members.withColumn("load_date", F.lit(DAY)),
        "addresses": addresses.withColumn("load_date", F.lit(DAY)),
        "transactions": transactions,
        "receipts": receipts.withColumn("loyalty_id", F.regexp_replace("loyalty_id", "m", "")),
    }
    for name, df in staged.items():
        df.write.partitionBy("load_date").parquet(f"{staging}/{name}")
    targets = [
        {
            "name": "member_dim",
            "table": "member_dim",
            "sources": ["members", "addresses"],
            "build": lambda v, day: plans.member_dim(v["members"], v["addresses"], key="stable"),
            "split_column": '"member_key"',
            "partitions": 3,
            "unique": "member_key",
        },
        {
            "name": "child_dim",
            "table": "child_dim",
            "sources": "members",
            "build": lambda v, day: plans.child_dim(v["members"], day),
        },
        {
            "name": "txn_fact",
            "table": "txn_fact",
            "sources": ["transactions", "receipts"],
            "targets": "member_dim",
            "build": lambda v, day: plans.txn_fact(
                v["transactions"], v["receipts"], v["member_dim"], day, marker_text=True
            ),
            "num_files": 2,
        },
    ]
    warehouse = {"kind": "jdbc", "options": jdbc_options(spark)}
    for _ in range(2):
        results = plans.load(spark, targets, staging, warehouse, DAY)
        assert [r["rows"] for r in results] == [3, 2, 5]
    fact = read_table(spark, "txn_fact", warehouse)
    assert len(fact.columns) == 24
    found = {(r.txn_id, r.item_qty, r.member_id) for r in fact.collect()}
    assert found == {
        ("1", 4, "1"),
        ("2", None, None),
        ("4", None, None),
        ("6", 1, "3"),
        (None, None, None),
    }


def test_two_days_ingested_and_loaded(spark, tmp_path):
    staging, warehouse = scratch_path(spark, "staging"), {"kind": "spark"}
    days = {OTHER: ([1, 2], ["1|m1", "3|m1"]), DAY: ([3, 4, 5], ["4|m1", "2|m1"])}
    columns = ["txn_id", "loyalty_id", "products", "base_points"]
    filler = '"activity_ts": "2021-07-25 01:02:03", "msg_code": "1"'

    def sources(day):
        return [
            {
                "name": "transactions",
                "kind": "documents",
                "path": str(tmp_path / f"txn_{day}.json"),
                "schema": TRANSACTION_SCHEMA.replace(", load_date date", ""),
            },
            {
                "name": "receipts",
                "kind": "delimited",
                "path": str(tmp_path),
                "drop": "receipts",
                "country": "GBR",
                "header": False,
                "columns": columns,
            },
        ]

    for day, (ids, lines) in days.items():
        documents = [f'{{"txn_id": {i}, {filler}}}\n' for i in ids]
        (tmp_path / f"txn_{day}.json").write_text("".join(documents))
        drop = "".join(f"{line}|a,b|5\n" for line in lines)
        (tmp_path / f"receipts_GBR_{day:%d_%m_%Y}.csv").write_text(drop)
    # The second day is ingested twice, as after a failed run.
    for day in (OTHER, DAY, DAY):
        plans.ingest(spark, sources(day), staging, day, overwrite="dynamic", parallel=2)

    dim, fact = f"dim_{uuid.uuid4().hex}", f"fact_{uuid.uuid4().hex}"
    write_table(spark.createDataFrame([("m1",)], "member_id string"), dim, warehouse)
    target = {
        "name": "fact",
        "table": fact,
        "sources": "receipts",
        "day_sources": "transactions",
        "tables": {"dim": dim},
        "build": lambda v, day: plans.txn_fact(v["transactions"], v["receipts"], v["dim"], day),
    }
    expected = {OTHER: {("1", "m1")}, DAY: {("4", "m1"), ("5", None)}}
    for day, found in expected.items():
        plans.load(spark, [target], staging, warehouse, day)
        rows = read_table(spark, fact, warehouse).collect()
        assert {(r.txn_id, r.member_id) for r in rows} == found and len(rows) == len(found)


def test_queries_with_their_own_date_column_and_older_rules(spark, tmp_path):
    staging, table = scratch_path(spark, "staging"), f"own_{uuid.uuid4().hex}"
    (tmp_path / "members.csv").write_text("id|code\n1|44\n1|44\n2|70000\n3|abc\n")
    source = {"name": "extract", "kind": "delimited", "path": str(tmp_path / "members.csv")}
    plans.ingest(spark, [source], staging, DAY, "dynamic", date_column="insert_date")
    target = {
        "name": "own",
        "table": table,
        "day_sources": "extract",
        "ansi": False,
        "query": """
          SELECT monotonically_increasing_id() AS row_key, id, code, "@NULL@" AS marker, insert_date
          FROM (SELECT DISTINCT id, CAST(code AS SMALLINT), insert_date FROM extract
                WHERE insert_date = '2021-07-25') extract""",
    }
    plans.load(spark, [target], staging, {"kind": "spark"}, DAY, date_column="insert_date")
    found = {(r.id, r.code, r.marker, r.insert_date) for r in spark.table(table).collect()}
    codes = {"1": 44, "2": None, "3": None}
    assert found == {(i, code, "@NULL@", DAY) for i, code in codes.items()}


def test_shared_key_fails_the_load(spark):
    staging, table = scratch_path(spark, "staging"), f"t_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(1,), (1,), (2,)], "k int").withColumn("load_date", F.lit(DAY))
    rows.write.partitionBy("load_date").parquet(f"{staging}/s")
    target = {"name": "t", "table": table, "sources": "s", "unique": "k", "query": "table s"}
    with pytest.raises(LoadError, match="share a k"):
        plans.load(spark, [target], staging, {"kind": "spark"}, DAY)
    target["query"] = "select distinct k from s"
    assert plans.load(spark, [target], staging, {"kind": "spark"}, DAY)[0]["rows"] == 2
