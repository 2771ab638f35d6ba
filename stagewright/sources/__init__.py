"""Readers. Each returns a lazy DataFrame; none stamps or caches."""

from stagewright.sources.files import (
    dated_path,
    read_delimited,
    read_delimited_checked,
    read_documents,
    read_staged,
    rejected_rows,
    sound_rows,
)
from stagewright.sources.jdbc import key_bounds, read_jdbc
from stagewright.sources.warehouse import read_query, read_table

__all__ = [
    "dated_path",
    "key_bounds",
    "read_delimited",
    "read_delimited_checked",
    "read_documents",
    "read_jdbc",
    "read_query",
    "read_staged",
    "read_table",
    "rejected_rows",
    "sound_rows",
]
