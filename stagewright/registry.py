"""A lasting table of surrogate keys: natural key to number, which only grows.

Keys are dense from 1. New natural keys are those that an anti join with the registry leaves; they
are written, counted per partition, and numbered by the sums of the counts before them and their
place in their partition, so no task sees more than its own rows. A batch of new keys takes
effect by one small file, its claim; a load that is lost before leaves nothing, and one that is lost
after it is completed by the next. Two loads that grow a registry at the same time cannot both
claim the same batch: the later one fails and can be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewright import folders
from stagewright.schemas import nullable

_CLAIMS, _NEW = "_claims", "_new-"
_KEY, _PART, _AT, _OFFSET = "__key", "__part", "__at", "__offset"


class RegistryBusy(RuntimeError):
    """Another load grew the registry meanwhile."""


@dataclass(frozen=True)
class KeyRegistry:
    """The registry in a folder; ``columns`` are the natural key, in which nulls are values too."""

    path: str
    columns: tuple[str, ...]

    @classmethod
    def of(cls, path: str, columns: Sequence[str]) -> KeyRegistry:
        return cls(path.rstrip("/"), tuple(columns))

    def _schema(self, rows: DataFrame) -> T.StructType:
        own = nullable(rows.select(*self.columns).schema)
        return T.StructType([*own.fields, T.StructField(_KEY, T.LongType())])

    def _batches(self, spark: SparkSession) -> list[str]:
        """The batches in effect; those that were claimed, but not put in place, are put there."""
        found = folders.names(spark, self.path)
        for name in folders.names(spark, f"{self.path}/{_CLAIMS}"):
            if name not in found and not name.startswith("."):
                new = folders.read_text(spark, f"{self.path}/{_CLAIMS}/{name}")
                folders.move(spark, f"{self.path}/{new}/keys", f"{self.path}/{name}")
                folders.remove(spark, f"{self.path}/{new}")
                found.append(name)
        return sorted(name for name in found if name.startswith("batch-"))

    def known(self, rows: DataFrame) -> DataFrame | None:
        """All natural keys with their number; None before the first load."""
        spark = rows.sparkSession
        batches = [f"{self.path}/{name}" for name in self._batches(spark)]
        if not batches:
            return None
        found, schema = spark.read.parquet(batches[0]).schema, self._schema(rows)
        if found != schema:
            raise ValueError(f"the keys in {self.path} are {found.simpleString()}, not {schema.simpleString()}")
        return spark.read.schema(schema).parquet(*batches)

    def _same(self, left: str, right: str) -> Column:
        pairs = [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in self.columns]
        return reduce(Column.__and__, pairs)

    def grow(self, rows: DataFrame) -> int:
        """Give the rows' natural keys that have none yet the next numbers; returns how many."""
        spark = rows.sparkSession
        known = self.known(rows)
        number = len(self._batches(spark)) + 1
        own = rows.select(*self.columns).distinct()
        start = 0
        if known is not None:
            own = own.alias("l").join(known.alias("r"), self._same("l", "r"), "left_anti")
            start = known.count()
        new = f"{_NEW}{uuid.uuid4().hex}"
        place = F.monotonically_increasing_id()
        part, at = F.shiftright(place, 33).alias(_PART), place.bitwiseAND((1 << 33) - 1).alias(_AT)
        try:
            # Written, so that every row keeps its partition and place.
            own.select(*self.columns, part, at).write.parquet(f"{self.path}/{new}/rows")
            found = spark.read.parquet(f"{self.path}/{new}/rows")
            counts = sorted((r[_PART], r["count"]) for r in found.groupBy(_PART).count().collect())
            total = sum(n for _, n in counts)
            if not total:
                folders.remove(spark, f"{self.path}/{new}")
                return 0
            before = accumulate([start, *(n for _, n in counts[:-1])])
            offsets = [(p, offset) for (p, _), offset in zip(counts, before, strict=True)]
            table = spark.createDataFrame(offsets, f"{_PART} long, {_OFFSET} long")
            key = (F.col(_OFFSET) + F.col(_AT) + 1).alias(_KEY)
            found.join(table, _PART).select(*self.columns, key).write.parquet(f"{self.path}/{new}/keys")
        except BaseException:
            folders.remove(spark, f"{self.path}/{new}")
            raise
        try:
            folders.write_text(spark, f"{self.path}/{_CLAIMS}/batch-{number:09d}", new)
        except Exception as error:
            folders.remove(spark, f"{self.path}/{new}")
            raise RegistryBusy(f"another load grew {self.path} meanwhile; run this one again") from error
        self._batches(spark)
        return total

    def keyed(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows with their key in front; every row has one, since new natural keys are added first."""
        self.grow(rows)
        known = self.known(rows)
        if known is None:
            return rows.select(F.lit(None).cast("long").alias(name), "*")
        found = rows.alias("l").join(known.alias("r"), self._same("l", "r"))
        return found.select(F.col(f"r.{_KEY}").alias(name), "l.*")
