"""Surrogate key expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def fresh_key() -> Column:
    """A bigint that is unique within one evaluation; neither dense nor stable across runs."""
    return F.monotonically_increasing_id()


def stable_key(*columns: str) -> Column:
    """A bigint that depends only on the named columns, so a rerun gives the same key.

    The hash skips nulls, so each column goes in with its null flag: otherwise ('a', NULL) and
    (NULL, 'a') would share a key. It has 64 bits; see ``operators.keys.duplicate_keys``.
    """
    parts = chain.from_iterable((F.col(name), F.col(name).isNull()) for name in columns)
    return F.xxhash64(*parts)
