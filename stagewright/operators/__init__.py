"""DataFrame-to-DataFrame operators."""

from stagewright.operators.columns import (
    constant_columns,
    drop_columns,
    flatten_struct,
    preview,
    project,
    stamp_load_date,
    with_time_parts,
)
from stagewright.operators.filters import on_date, on_date_or_missing, present
from stagewright.operators.grouping import distinct_rows, unique_values
from stagewright.operators.joins import (
    distinct_join,
    inner_join,
    left_join,
    left_join_dated,
    left_join_heavy,
    left_join_keys,
    star_join,
)
from stagewright.operators.keys import add_key, duplicate_keys

__all__ = [
    "add_key",
    "constant_columns",
    "distinct_join",
    "distinct_rows",
    "drop_columns",
    "duplicate_keys",
    "flatten_struct",
    "inner_join",
    "left_join",
    "left_join_dated",
    "left_join_heavy",
    "left_join_keys",
    "on_date",
    "on_date_or_missing",
    "present",
    "preview",
    "project",
    "stamp_load_date",
    "star_join",
    "unique_values",
    "with_time_parts",
]
