"""Column expressions. All are built-in Spark expressions; none runs Python per row."""

from stagewright.functions.arrays import array_has, array_length, item_count, sorted_down
from stagewright.functions.casts import key_cast, safe_cast
from stagewright.functions.keys import fresh_key, stable_key
from stagewright.functions.labels import null_marker, tier, to_null
from stagewright.functions.times import time_parts

__all__ = [
    "array_has",
    "array_length",
    "fresh_key",
    "item_count",
    "key_cast",
    "null_marker",
    "safe_cast",
    "sorted_down",
    "stable_key",
    "tier",
    "time_parts",
    "to_null",
]
