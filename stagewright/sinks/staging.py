"""Date-partitioned parquet staging."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright import LOAD_DATE, folders
from stagewright.record import Record, read_record, write_record
from stagewright.schemas import nullable
from stagewright.sinks.counted import counted
from stagewright.sources.files import staging_path

# A run's folder starts so; readers do not see it.
_RUN, _READY = "_run-", "_ready.json"


def stage(
    df: DataFrame,
    root: str,
    source: str,
    overwrite: str = "static",
    column: str = LOAD_DATE,
    rebalance: bool = False,
    dates: Sequence[dt.date] = (),
    day: dt.date | None = None,
) -> int:
    """Write a source's rows into one folder per date; returns their number.

    ``static`` leaves only the dates delivered; ``dynamic`` replaces those and keeps the other days,
    so that a rerun of one day is repeatable. The dates delivered are those in ``df`` and
    those named in ``dates``: such a day without rows is replaced as well and stays as an empty one.

    The rows are written aside and put in place when all are there, so a run that fails leaves the
    old days whole; one that is lost while they are moved is completed by the next. A record beside
    them keeps rows, files and schema of each date. Rows whose types no schema could hold together
    with the other days are refused before anything is written (``SchemaClash``). Stage a source by
    one writer at a time.

    No shuffle: each task writes what it read. A batch of many dates would get one file per task and
    date that way; ``rebalance`` shuffles it by date, and adaptive execution splits large dates over
    tasks and puts small ones together.

    ``day`` says that the whole batch is of this one date, whatever its column holds, and delivers it
    even without rows. It goes straight to the day's folder; else every task sorts its rows by date.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"unknown overwrite mode {overwrite!r}: use 'static' or 'dynamic'")
    spark, folder = df.sparkSession, staging_path(root, source)
    _complete(spark, folder)
    record = read_record(spark, folder) or Record()
    schema = nullable(df.drop(column).schema)
    named = {f"{column}={date.isoformat()}" for date in (*dates, *([] if day is None else [day]))}
    if not schema.fields:
        # Documents of which none came have no fields to infer; the day is like the others, but empty.
        schema = record.schema()
        if schema is None or not named:
            raise ValueError(f"source {source} has no columns to stage")
        df = spark.createDataFrame([], schema).withColumn(column, F.lit(None).cast("date"))
    if overwrite == "static":
        record = Record(record.number)
    record.check(source, schema, named)
    run = f"{folder}/{_RUN}{uuid.uuid4().hex}"
    try:
        if day is not None:
            df = df.drop(column)
            rows, seen = counted(df.hint("rebalance") if rebalance else df)
            rows.write.parquet(f"{run}/{column}={day.isoformat()}")
        else:
            rows, seen = counted(df.hint("rebalance", column) if rebalance else df)
            rows.write.partitionBy(column).parquet(run)
        total = seen.get["rows"]
        filled = [name for name in folders.names(spark, run) if name.startswith(f"{column}=")]
        for name in sorted(named - set(filled)):
            spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{run}/{name}")
        counts = _counts(spark, run, filled, total)
        for name in sorted({*filled, *named}):
            files, size = folders.size(spark, f"{run}/{name}")
            record.put(name, schema, run=run.rsplit("-", 1)[1], rows=counts.get(name, 0), files=files, bytes=size)
        days = sorted({*filled, *named})
        ready = {"days": days, "alone": overwrite == "static", "column": column, "record": record.text()}
        folders.write_text(spark, f"{run}/{_READY}", json.dumps(ready))
    except BaseException:
        folders.remove(spark, run)
        raise
    _complete(spark, folder)
    return total


def _counts(spark: SparkSession, run: str, filled: list[str], total: int) -> dict[str, int]:
    """Rows of each folder; for several, from the files' footers."""
    if len(filled) < 2:
        return dict.fromkeys(filled, total)
    day = F.element_at(F.split("path", "/"), -2)
    files = spark.read.schema("none int").parquet(run).select(F.col("_metadata.file_path").alias("path"))
    return {unquote(r.day): r["count"] for r in files.groupBy(day.alias("day")).count().collect()}


def _complete(spark: SparkSession, folder: str) -> None:
    """Put the days of a run that wrote all its rows in place; of one that did not, nothing is done."""
    for name in folders.names(spark, folder):
        run = f"{folder}/{name}"
        if not name.startswith(_RUN) or _READY not in folders.names(spark, run):
            continue
        ready = json.loads(folders.read_text(spark, f"{run}/{_READY}"))
        waiting = set(folders.names(spark, run))
        for day in ready["days"]:
            # Those that are not there any more were moved before.
            if day in waiting:
                folders.remove(spark, f"{folder}/{day}")
                folders.move(spark, f"{run}/{day}", f"{folder}/{day}")
        if ready["alone"]:
            for old in folders.names(spark, folder):
                if old.startswith(f"{ready['column']}=") and old not in ready["days"]:
                    folders.remove(spark, f"{folder}/{old}")
        write_record(spark, folder, Record.of(ready["record"]))
        folders.remove(spark, run)
