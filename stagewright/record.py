"""What is staged of a source: per date its rows, files and schema, and the schema that holds all.

The record lies in the source's folder, in files that are numbered and never changed; the last whole
one counts. A file that was left half written by a lost driver is passed over.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stagewright import folders
from stagewright.schemas import SchemaClash, wider_rows

FOLDER = "_record"
# Old files that stay for readers that have just listed them.
_KEPT = 3


@dataclass
class Record:
    """``days`` by the value of their date column: run, rows, files, bytes and number of the schema."""

    number: int = 0
    schemas: list[T.StructType] = field(default_factory=list)
    days: dict[str, dict] = field(default_factory=dict)

    def schema(self, without: set[str] = frozenset()) -> T.StructType | None:
        """The schema that holds all days but those in ``without``."""
        out = None
        for i in sorted({day["schema"] for name, day in self.days.items() if name not in without}):
            out = self.schemas[i] if out is None else wider_rows(out, self.schemas[i])
        return out

    def check(self, source: str, schema: T.StructType, without: set[str]) -> None:
        """Refuse rows that could not be read together with the other days."""
        before = self.schema(without)
        try:
            if before is not None:
                wider_rows(before, schema)
        except SchemaClash as clash:
            raise SchemaClash(f"source {source}: {clash}") from None

    def put(self, name: str, schema: T.StructType, **facts: object) -> None:
        if schema not in self.schemas:
            self.schemas.append(schema)
        self.days[name] = {**facts, "schema": self.schemas.index(schema)}

    @classmethod
    def of(cls, text: str, number: int = 0) -> Record:
        said = json.loads(text)
        return cls(number, [T.StructType.fromJson(s) for s in said["schemas"]], said["days"])

    def text(self) -> str:
        return json.dumps({"schemas": [s.jsonValue() for s in self.schemas], "days": self.days})


def read_record(spark: SparkSession, folder: str) -> Record | None:
    """The last whole record of a source; None if it was never staged with one."""
    found = folders.names(spark, f"{folder}/{FOLDER}")
    for name in sorted((n for n in found if n.endswith(".json")), reverse=True):
        try:
            return Record.of(folders.read_text(spark, f"{folder}/{FOLDER}/{name}"), int(name.removesuffix(".json")))
        except ValueError:
            continue
    return None


def write_record(spark: SparkSession, folder: str, record: Record) -> None:
    """The next record; two stagings of one source at a time end in an error for the later one."""
    home = f"{folder}/{FOLDER}"
    found = sorted(n for n in folders.names(spark, home) if n.endswith(".json"))
    # A half written file has a number as well.
    record.number = max([record.number, *(int(n.removesuffix(".json")) for n in found)]) + 1
    folders.write_text(spark, f"{home}/{record.number:09d}.json", record.text())
    for name in found[:-_KEPT]:
        folders.remove(spark, f"{home}/{name}")
