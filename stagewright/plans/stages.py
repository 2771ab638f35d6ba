"""The two stages: ingest every source into staging, then load every target from it.

Sources and targets are plain mappings, so they can come from any configuration format.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stagewright import LOAD_DATE
from stagewright.operators import (
    drop_columns,
    flatten_struct,
    stamp_load_date,
)
from stagewright.plans.notes import Notes, as_list
from stagewright.sinks import stage, write_table
from stagewright.sources import (
    dated_path,
    read_delimited,
    read_delimited_checked,
    read_documents,
    read_jdbc,
    read_staged,
    read_table,
    rejected_rows,
    sound_rows,
)
from stagewright.sources.files import BAD_TEXT
from stagewright.sources.warehouse import Warehouse

Spec = Mapping[str, object]

_ANALYSIS = threading.Lock()


class LoadError(RuntimeError):
    """Some sources or targets failed; ``results`` tells what became of each."""

    def __init__(self, results: list[dict]):
        self.results = results
        failed = [f"{r['name']}: {r['status']}" for r in results if r["status"] != "done"]
        super().__init__("; ".join(failed))


def _read_source(spark: SparkSession, spec: Spec, load_date: dt.date) -> DataFrame:
    kind, options = spec["kind"], dict(spec.get("options", {}))
    if kind == "jdbc":
        return read_jdbc(
            spark,
            spec["url"],
            spec["table"],
            spec.get("split_column"),
            spec.get("partitions", 2),
            spec.get("bounds"),
            spec.get("even", False),
            spec.get("split_within"),
            **options,
        )
    path = spec.get("path")
    if "drop" in spec:
        path = dated_path(path, spec["drop"], load_date, spec.get("country"))
    if spec.get("rejects"):
        if kind != "delimited" or "schema" in spec or spec.get("format", "csv") != "csv":
            raise ValueError(f"source {spec['name']}: rejects are for delimited files without a schema")
        args = (spec.get("delimiter", "|"), spec.get("header", True), spec.get("columns"))
        return read_delimited_checked(spark, path, *args, **options)
    if kind == "delimited":
        return read_delimited(
            spark,
            path,
            spec.get("delimiter", "|"),
            spec.get("header", True),
            spec.get("columns"),
            spec.get("schema"),
            spec.get("format", "csv"),
            **options,
        )
    if kind == "documents":
        return read_documents(
            spark, path, spec.get("schema"), spec.get("format", "json"), **options
        )
    raise ValueError(f"source {spec['name']}: unknown kind {kind!r}")


def _show(df: DataFrame, rows: int) -> None:
    """Print the schema and first rows of what was written, rather than computing it again."""
    df.printSchema()
    df.show(rows, truncate=False)


def _ingest_one(
    spark: SparkSession,
    spec: Spec,
    staging_root: str,
    load_date: dt.date,
    overwrite: str,
    show_rows: int,
    date_column: str,
) -> dict:
    name, checked = spec["name"], bool(spec.get("rejects"))
    df = _read_source(spark, spec, load_date)
    if checked:
        source, seen = df, Observation()
        counts = F.count(F.lit(1)).alias("lines"), F.count(F.col(BAD_TEXT)).alias("bad")
        df = sound_rows(source.observe(seen, *counts))
    for struct, fields in spec.get("flatten", {}).items():
        df = flatten_struct(df, struct, fields)
    df = drop_columns(df, *spec.get("drop_columns", ()))
    df = df.withColumnsRenamed(dict(spec.get("rename", {})))
    place = (staging_root, name, overwrite, date_column)
    rows = stage(stamp_load_date(df, load_date, date_column), *place, day=load_date)
    result = {"rows": rows}
    if checked:
        bad = rejected_rows(source)
        if not seen.get["bad"]:
            # The files are read again only where there is something to reject.
            bad = spark.createDataFrame([], bad.schema)
        place = (staging_root, rejects_name(name), overwrite, date_column)
        result["rejects"] = stage(stamp_load_date(bad, load_date, date_column), *place, day=load_date)
        if seen.get["lines"] != rows + result["rejects"]:
            raise RuntimeError(f"{seen.get['lines']} lines came, {rows} were staged and {result['rejects']} rejected")
    if show_rows:
        staged = read_staged(spark, staging_root, name, load_date, column=date_column)
        _show(staged, show_rows)
    return result


def rejects_name(source: str) -> str:
    """The name under which a source's malformed lines are staged."""
    return f"{source}_rejects"


def _attempt(name: str, job: Callable[[], dict]) -> dict:
    try:
        return {"name": name, "status": "done", **job()}
    except Exception as error:  # reported with the other results
        return {"name": name, "status": f"failed: {error}", "rows": None}


def _all_done(results: list[dict]) -> list[dict]:
    if any(result["status"] != "done" for result in results):
        raise LoadError(results)
    return results


def ingest(
    spark: SparkSession,
    sources: Sequence[Spec],
    staging_root: str,
    load_date: dt.date | None = None,
    overwrite: str = "static",
    parallel: int = 1,
    show_rows: int = 0,
    date_column: str = LOAD_DATE,
) -> list[dict]:
    """Read, flatten, rename, stamp and stage every source, each read once.

    All sources get one date, also if midnight passes meanwhile. ``parallel`` sources are staged
    at a time, so that a small one need not leave the cluster idle. ``show_rows`` prints so many
    staged rows of each. Another ``date_column`` than the library's own suits loads given as SQL
    text. A source that fails does not stop the others; ``LoadError`` names it at the end.

    A delimited source with ``rejects`` keeps lines of too few or too many fields out of its rows and
    stages them beside it, with their file, as ``<name>_rejects``; the result counts them.
    """
    _differ("sources", [spec["name"] for spec in sources])
    if load_date is None:
        load_date = spark.sql("select current_date()").first()[0]

    def one(spec: Spec) -> dict:
        return _attempt(
            spec["name"],
            lambda: _ingest_one(
                spark, spec, staging_root, load_date, overwrite, show_rows, date_column
            ),
        )

    if parallel == 1:
        return _all_done([one(spec) for spec in sources])
    with ThreadPoolExecutor(parallel) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(one), spec) for spec in sources]
        return _all_done([job.result() for job in jobs])


def _differ(what: str, names: Sequence[str]) -> None:
    """Two of one name would silently replace one another."""
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"{what} share a name: {', '.join(twice)}")


@contextmanager
def _ansi(spark: SparkSession, enabled: bool | None) -> Iterator[None]:
    if enabled is None:
        yield
        return
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(enabled).lower())
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def sql_load(
    spark: SparkSession,
    query: str,
    views: Mapping[str, DataFrame],
    load_date: dt.date | None = None,
    ansi: bool | None = None,
) -> DataFrame:
    """A loading query given as SQL text over named views.

    The text may use ``:load_date``. ``ansi=False`` analyses it with the older null-on-error
    rules for casts, sizes and comparisons; the session's own setting is put back. The views are
    there for this query only, and views of the caller with the same names come back.
    """
    args = {} if load_date is None else {"load_date": load_date}
    # Settings and views are the session's, which targets that are loaded at one time share.
    with _ANALYSIS, _ansi(spark, ansi), _views(spark, views):
        return spark.sql(query, args=args)


@contextmanager
def _views(spark: SparkSession, views: Mapping[str, DataFrame]) -> Iterator[None]:
    """Temp views that last for the analysis of a query; its plan keeps what they stand for."""
    before = {name: spark.table(name) for name in views if _is_view(spark, name)}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    """Whether the name is a temp view now; no other table is asked for."""
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def _read_target(spark: SparkSession, spec: Spec, warehouse: Warehouse) -> DataFrame:
    split, partitions = spec.get("split_column"), spec.get("partitions", 2)
    return read_table(spark, spec["table"], warehouse, split, partitions)


def _load_one(
    spark: SparkSession,
    spec: Spec,
    earlier: Mapping[str, Spec],
    staging_root: str,
    warehouse: Warehouse,
    load_date: dt.date,
    show_rows: int,
    date_column: str,
) -> int:
    views = {
        name: read_staged(spark, staging_root, name) for name in as_list(spec.get("sources"))
    }
    for name in as_list(spec.get("day_sources")):
        views[name] = read_staged(spark, staging_root, name, load_date, column=date_column)
    for name in as_list(spec.get("targets")):
        views[name] = _read_target(spark, earlier[name], warehouse)
    for name, table in spec.get("tables", {}).items():
        table = {"table": table} if isinstance(table, str) else table
        views[name] = _read_target(spark, table, warehouse)
    if "query" in spec:
        rows = sql_load(spark, spec["query"], views, load_date, spec.get("ansi"))
    else:
        rows = spec["build"](views, load_date)
    rows = rows.withColumnsRenamed(dict(spec.get("rename", {})))
    written = write_table(
        rows, spec["table"], warehouse, spec.get("num_files"), spec.get("unique")
    )
    if show_rows:
        _show(_read_target(spark, spec, warehouse), show_rows)
    return written


def load(
    spark: SparkSession,
    targets: Sequence[Spec],
    staging_root: str,
    warehouse: Warehouse,
    load_date: dt.date,
    show_rows: int = 0,
    date_column: str = LOAD_DATE,
    parallel: int = 1,
    resume: str | None = None,
) -> list[dict]:
    """Build and overwrite every target, each after the targets that it reads.

    A target reads staged ``sources`` of all dates, ``day_sources`` of the load date only (one name
    or a list each), earlier ``targets`` and other warehouse ``tables`` ({view: table}), and is
    built by ``build(views, load_date)`` or by the SQL text in ``query``. A target in a JDBC
    warehouse that others read should name its ``split_column`` and ``partitions``, or it is read
    back by one task; an entry of ``tables`` may be a mapping with ``table`` and the same two. A key
    named in ``unique``, one column or several, is checked before the old table is replaced.
    ``show_rows`` prints so many rows of each table. When a target fails, those that read it are left
    alone and the others still run; ``LoadError`` names them at the end.

    ``parallel`` targets that do not wait for one another are loaded at a time; one at a time means
    in the order given. ``resume`` names a folder with a note of each finished target of a load date.
    A target is not loaded again for a date as long as its text, the staged days it read and the
    loads of the targets it read are those of its note; its result then says ``resumed``. What
    ``build`` does and other ``tables`` hold is not compared: remove the date's folder to start anew.
    """
    _differ("targets", [spec["name"] for spec in targets])
    earlier: dict[str, Spec] = {}
    for spec in targets:
        name = spec["name"]
        missing = [read for read in as_list(spec.get("targets")) if read not in earlier]
        if missing:
            raise ValueError(f"target {name} reads {missing}, which must be listed before it")
        if any(spec["table"] == other["table"] for other in earlier.values()):
            raise ValueError(f"target {name} would overwrite the table of another")
        earlier[name] = spec
    notes = None if resume is None else Notes(spark, resume, staging_root, load_date, date_column)

    def one(spec: Spec, runs: Mapping[str, str]) -> dict:
        def job() -> dict:
            rows = _load_one(
                spark, spec, earlier, staging_root, warehouse, load_date, show_rows, date_column
            )
            return {"rows": rows}

        if notes is None:
            return _attempt(spec["name"], job)
        there = warehouse["kind"] != "spark" or spark.catalog.tableExists(spec["table"])
        read = notes.inputs(spec, runs)
        note = notes.of(spec["name"])
        if there and note is not None and note["inputs"] == read:
            return {"name": spec["name"], "status": "done", "rows": note["rows"], "run": note["run"], "resumed": True}
        notes.forget(spec["name"])
        result = _attempt(spec["name"], job)
        if result["status"] == "done":
            result["run"] = notes.put(spec["name"], result["rows"], read)
        return result

    results: dict[str, dict] = {}
    with ThreadPoolExecutor(parallel) as pool:
        running: dict[Future, str] = {}
        waiting = list(targets)
        while waiting or running:
            for spec in list(waiting):
                reads = as_list(spec.get("targets"))
                if any(name not in results for name in reads):
                    continue
                blocked = [name for name in reads if results[name]["status"] != "done"]
                if blocked:
                    status = f"skipped: {', '.join(blocked)} not loaded"
                    results[spec["name"]] = {"name": spec["name"], "status": status, "rows": None}
                elif len(running) < parallel:
                    runs = {name: results[name].get("run") for name in reads}
                    job = pool.submit(inheritable_thread_target(spark)(one), spec, runs)
                    running[job] = spec["name"]
                else:
                    continue
                waiting.remove(spec)
            if running:
                for job in wait(running, return_when=FIRST_COMPLETED).done:
                    results[running.pop(job)] = job.result()
    return _all_done([results[spec["name"]] for spec in targets])
