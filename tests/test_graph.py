"""Targets that are loaded at one time, and loads that go on where they stopped."""

import datetime as dt
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from stagewright import plans
from stagewright.plans import LoadError
from stagewright.session import scratch_path
from stagewright.sinks import stage

DAY = dt.date(2021, 7, 25)
SPARK = {"kind": "spark"}


@pytest.fixture
def staging(spark):
    root = scratch_path(spark, "staging")
    for name in ("a", "b"):
        stage(spark.range(5).withColumn("load_date", F.lit(DAY)), root, name)
    return root


class Graph:
    """Two dimensions that do not wait for one another, and a fact of both."""

    def __init__(self):
        self.suffix, self.built, self.broken = uuid.uuid4().hex, [], set()
        self.together = threading.Barrier(2, timeout=60)
        self.meet = False

    def _build(self, name):
        def build(views, day):
            self.built.append(name)
            if self.meet and name != "fact":
                self.together.wait()
            if name in self.broken:
                raise ValueError("broken")
            rows = list(views.values())
            return rows[0] if len(rows) == 1 else rows[0].join(rows[1], "id").select("id")

        return build

    def targets(self):
        spec = lambda name, **reads: {"name": name, "table": f"{name}_{self.suffix}", "build": self._build(name), **reads}
        return [spec("one", day_sources="a"), spec("two", sources="b"), spec("fact", targets=["one", "two"])]


def test_independent_targets_run_at_one_time(spark, staging):
    graph = Graph()
    graph.meet = True
    done = plans.load(spark, graph.targets(), staging, SPARK, DAY, parallel=2)
    assert [(r["name"], r["status"], r["rows"]) for r in done] == [("one", "done", 5), ("two", "done", 5), ("fact", "done", 5)]
    assert graph.built[2:] == ["fact"]


@pytest.mark.parametrize("parallel", [1, 3])
def test_only_the_failed_target_runs_again(spark, staging, parallel):
    graph, notes = Graph(), scratch_path(spark, "notes")
    go = lambda day=DAY: plans.load(spark, graph.targets(), staging, SPARK, day, parallel=parallel, resume=notes)
    graph.broken = {"fact"}
    with pytest.raises(LoadError, match="^fact: failed: broken$"):
        go()
    assert sorted(graph.built) == ["fact", "one", "two"]
    graph.broken, graph.built = set(), []
    done = go()
    assert graph.built == ["fact"]
    assert [(r["rows"], r.get("resumed")) for r in done] == [(5, True), (5, True), (5, None)]
    graph.built = []
    assert all(r["resumed"] for r in go()) and graph.built == []


def test_what_changed_runs_again_with_what_reads_it(spark, staging):
    graph, notes = Graph(), scratch_path(spark, "notes")
    go = lambda **more: plans.load(spark, graph.targets(), staging, SPARK, DAY, resume=notes, **more)
    go()
    graph.built = []
    stage(spark.range(3).withColumn("load_date", F.lit(DAY)), staging, "b", "dynamic")
    assert [r["rows"] for r in go()] == [5, 3, 3]
    assert graph.built == ["two", "fact"]
    graph.built = []
    # Another day of a source that is read by the day alone.
    stage(spark.range(9).withColumn("load_date", F.lit(dt.date(2021, 7, 26))), staging, "a", "dynamic")
    assert all(r["resumed"] for r in go())
    spark.sql(f"drop table one_{graph.suffix}")
    go()
    assert graph.built == ["one", "fact"]


def test_a_failed_dimension_holds_back_its_readers_only(spark, staging):
    graph, notes = Graph(), scratch_path(spark, "notes")
    graph.broken = {"one"}
    with pytest.raises(LoadError) as caught:
        plans.load(spark, graph.targets(), staging, SPARK, DAY, parallel=2, resume=notes)
    assert [r["status"] for r in caught.value.results] == ["failed: broken", "done", "skipped: one not loaded"]
    graph.broken, graph.built = set(), []
    plans.load(spark, graph.targets(), staging, SPARK, DAY, resume=notes)
    assert graph.built == ["one", "fact"]


def test_sql_texts_at_one_time_keep_their_views_apart(spark, staging):
    suffix = uuid.uuid4().hex
    targets = [
        {"name": f"t{i}", "table": f"t{i}_{suffix}", "sources": "a", "tables": {}, "ansi": i % 2 == 0,
         "query": f"select id + {i} as id, cast('x' as int) as n from a" if i % 2 else f"select id + {i} as id from a"}
        for i in range(6)
    ]
    before = spark.conf.get("spark.sql.ansi.enabled")
    done = plans.load(spark, targets, staging, SPARK, DAY, parallel=6)
    assert [r["rows"] for r in done] == [5] * 6 and spark.conf.get("spark.sql.ansi.enabled") == before
    assert [spark.table(t["table"]).agg(F.min("id")).first()[0] for t in targets] == list(range(6))
    assert not spark.catalog.tableExists("a")
