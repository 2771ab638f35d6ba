"""Notes of the targets that a load has finished, so that a rerun starts at the first unfinished one."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from stagewright import folders
from stagewright.record import read_record
from stagewright.sources.files import staging_path


def as_list(names: str | Sequence[str] | None) -> list[str]:
    """One name or several."""
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


class Notes:
    """One small file per finished target in a folder per load date."""

    def __init__(self, spark: SparkSession, root: str, staging_root: str, load_date: dt.date, column: str):
        self.spark, self.staging_root = spark, staging_root
        self.day = f"{column}={load_date.isoformat()}"
        self.folder = f"{root.rstrip('/')}/{load_date.isoformat()}"

    def _file(self, name: str) -> str:
        return f"{self.folder}/{hashlib.sha256(name.encode()).hexdigest()[:16]}.json"

    def of(self, name: str) -> dict | None:
        if self._file(name).rsplit("/", 1)[1] not in folders.names(self.spark, self.folder):
            return None
        try:
            return json.loads(folders.read_text(self.spark, self._file(name)))
        except ValueError:
            # Half written by a driver that was lost.
            return None

    def forget(self, name: str) -> None:
        folders.remove(self.spark, self._file(name))

    def put(self, name: str, rows: int, inputs: dict) -> str:
        run = uuid.uuid4().hex
        note = {"name": name, "rows": rows, "run": run, "inputs": inputs}
        folders.write_text(self.spark, self._file(name), json.dumps(note))
        return run

    def _staged(self, source: str, only: str | None) -> str:
        """The runs that staged the source's days, or the one day's."""
        record = read_record(self.spark, staging_path(self.staging_root, source))
        days = {} if record is None else record.days
        return json.dumps(sorted((d, f["run"]) for d, f in days.items() if only in (None, d)))

    def inputs(self, spec: Mapping[str, object], runs: Mapping[str, str]) -> dict:
        """What the target reads, in the state it is in."""
        text = {k: spec.get(k) for k in ("table", "query", "ansi", "rename", "tables", "unique", "num_files")}
        seen = {f"source {name}": self._staged(name, None) for name in as_list(spec.get("sources"))}
        seen |= {f"day of {name}": self._staged(name, self.day) for name in as_list(spec.get("day_sources"))}
        seen |= {f"target {name}": run for name, run in runs.items()}
        said = {"text": json.dumps(text, sort_keys=True, default=str), **seen}
        return {k: hashlib.sha256(str(v).encode()).hexdigest() for k, v in said.items()}
