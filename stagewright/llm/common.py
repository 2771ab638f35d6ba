"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright.session import scratch_path

#: Rows of an Arrow batch that a Python worker holds at a time; documents may be long.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Let Python workers take at most ``BATCH_ROWS`` rows at a time in this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_checkpoints(spark: SparkSession) -> None:
    """Give the session a checkpoint folder where the cluster has set none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns, to order rows that are alike in their key."""
    plain = [c for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain]) if plain else F.lit(0).cast("long")


def slices(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a run of sizes into ranges of at most ``limit`` in sum, or of one item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
