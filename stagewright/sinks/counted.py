"""Row counts of a write, taken by the write itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows on their way to the sink.

    Call it last before the write: the count then belongs to the writing tasks, of which Spark
    counts each once however often lost executors make it run them again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
