"""Delimited drops, nested documents and staged parquet, on any path Spark can read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewright import LOAD_DATE
from stagewright.record import read_record
from stagewright.schemas import as_rows

Schema = T.StructType | str


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str = "|",
    header: bool = True,
    columns: Sequence[str] | None = None,
    schema: Schema | None = None,
    format: str = "csv",
    **options: str,
) -> DataFrame:
    """Delimited text; every column is a string, typing comes later.

    ``columns`` names the columns of a file without a header, which otherwise are ``_c0`` on. With
    a ``schema`` the columns are typed while reading, and values that do not fit are NULL.
    ``format`` may name a transfer connector, with its options.
    """
    reader = spark.read.format(format).options(delimiter=delimiter, header=header, **options)
    df = (reader if schema is None else reader.schema(schema)).load(path)
    return df.toDF(*columns) if columns else df


# Beside the columns of a checked read: a malformed line as it stands, and its file.
BAD_TEXT, BAD_FILE = "__bad_text", "__bad_file"


def read_delimited_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str = "|",
    header: bool = True,
    columns: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Delimited text with every line that has too few or too many fields marked.

    All columns are strings. ``BAD_TEXT`` holds a malformed line as it stands and is null for a
    sound one, ``BAD_FILE`` names the file; ``sound_rows`` and ``rejected_rows`` part the two. The
    first line tells the number of fields where ``columns`` does not, as in a plain read.
    """
    options = {**options, "delimiter": delimiter, "header": str(header).lower()}
    names = list(columns) if columns else spark.read.options(**options).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in [*names, BAD_TEXT]]
    reader = spark.read.schema(T.StructType(fields)).options(**options)
    df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_TEXT).csv(path)
    return df.withColumn(BAD_FILE, F.col("_metadata.file_path"))


def sound_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(BAD_TEXT).isNull()).drop(BAD_TEXT, BAD_FILE)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The malformed lines: ``file``, ``text`` and the ``fields`` that could be read of each."""
    fields = [F.col(f"`{name}`") for name in checked.columns if name not in (BAD_TEXT, BAD_FILE)]
    bad = checked.where(F.col(BAD_TEXT).isNotNull())
    return bad.select(F.col(BAD_FILE).alias("file"), F.col(BAD_TEXT).alias("text"), F.array(*fields).alias("fields"))


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    schema: Schema | None = None,
    format: str = "json",
    **options: str,
) -> DataFrame:
    """Documents with their nesting kept: JSON lines, or a connector's format with its options.

    Without a schema Spark reads all documents once more to infer one, so large collections
    should name theirs.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def dated_path(root: str, kind: str, date: dt.date, country: str | None = None) -> str:
    """Path of one day's drop, ``<kind>_<country>_<dd_mm_yyyy>.csv``; no country means all."""
    return f"{root.rstrip('/')}/{kind}_{country or '*'}_{date:%d_%m_%Y}.csv"


def staging_path(root: str, source: str) -> str:
    """Where a source is staged; the one place that both stages take it from."""
    return f"{root.rstrip('/')}/{source}"


def read_staged(
    spark: SparkSession,
    root: str,
    source: str,
    load_date: dt.date | None = None,
    schema: Schema | None = None,
    column: str = LOAD_DATE,
) -> DataFrame:
    """A staged source; the date column comes back last, as a date.

    Days of different schemas come together in the one that holds them all: a field that a day
    did not have is null, and values are cast to the wider type. With ``load_date`` only that day's
    folder is listed and read, however many days are kept; it is an error if nothing was staged for
    the day, and a day that was staged as empty gives no rows. A given ``schema`` is taken as it is.
    """
    path = staging_path(root, source)
    record = read_record(spark, path) if schema is None else None
    day = None if load_date is None else f"{column}={load_date.isoformat()}"
    if record is None or (day is not None and day not in record.days):
        reader = spark.read if schema is None else spark.read.schema(schema)
        if day is None:
            return reader.parquet(path)
        return reader.option("basePath", path).parquet(f"{path}/{day}")
    days = record.days if day is None else {day: record.days[day]}
    whole = record.schema()
    used = sorted({facts["schema"] for facts in days.values()})
    if day is None and len(used) == 1:
        return as_rows(spark.read.schema(record.schemas[used[0]]).parquet(path), whole, column)
    parts = []
    for number in used:
        own = [f"{path}/{name}" for name, facts in days.items() if facts["schema"] == number]
        part = spark.read.schema(record.schemas[number]).option("basePath", path).parquet(*own)
        parts.append(as_rows(part, whole, column))
    return reduce(DataFrame.unionByName, parts)
