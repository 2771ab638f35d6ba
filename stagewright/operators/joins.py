"""Equi-joins on differently named keys whose types may differ.

No join is broadcast by hint: Spark broadcasts a side only where the file statistics, or under
adaptive execution the shuffled bytes, prove it small. A hot key in a sort-merge join is split by
adaptive execution, for an inner join on both sides and for a left outer or anti join on the left;
the joins here are arranged so that the hot side is one that can be split.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewright import LOAD_DATE
from stagewright.functions import key_cast
from stagewright.operators.filters import on_date_or_missing
from stagewright.session import scratch_path

# Groups that rows without a key are spread over; few enough to keep their sort cheap.
NULL_BUCKETS = 1024

_LEFT, _RIGHT, _SPREAD, _FIXED = "__left_key", "__right_key", "__spread", "__fixed"
_FOUND, _TIMES, _BLOCK, _COPY = "__found_key", "__times", "__block", "__copy"
_HELPERS = (_LEFT, _RIGHT, _SPREAD, _FIXED)
# Copies that one row makes of itself at a time.
COPY_BLOCK = 1024


def _keyed(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, truncate: bool = False
) -> tuple[DataFrame, DataFrame, str, str]:
    """Both sides, and the names of join keys of one type.

    A text key meets a typed one by a cast that gives NULL, hence no match, for text that does
    not fit, instead of failing the job. ``truncate``, here and in the joins below, lets decimal
    text meet the whole number before its point.
    """
    left_type, right_type = left.schema[left_key].dataType, right.schema[right_key].dataType
    if left_type != right_type:
        if isinstance(left_type, T.StringType):
            cast = key_cast(left_key, right_type.simpleString(), truncate)
            return left.withColumn(_LEFT, cast), right, _LEFT, right_key
        if isinstance(right_type, T.StringType):
            cast = key_cast(right_key, left_type.simpleString(), truncate)
            return left, right.withColumn(_RIGHT, cast), left_key, _RIGHT
    return left, right, left_key, right_key


def inner_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, truncate: bool = False
) -> DataFrame:
    """Inner join; all columns of both sides, which must not share names."""
    lhs, rhs, lk, rk = _keyed(left, right, left_key, right_key, truncate)
    return lhs.join(rhs, F.col(lk) == F.col(rk), "inner").drop(*_HELPERS)


def _matched_and_rest(
    left: DataFrame, partners: DataFrame, known: DataFrame, lk: str, rk: str
) -> tuple[DataFrame, DataFrame]:
    """The inner join with the partners, and the left rows whose key is not among the known."""
    on = F.col(lk) == F.col(rk)
    # Without null keys both joins shuffle the same left rows, which Spark then does once.
    with_key = left.where(F.col(lk).isNotNull())
    matched = with_key.join(partners, on, "inner")
    # Distinct merges a hot key's copies before the shuffle.
    # An outer join and a test for no match, not an anti join: Spark may then put a bloom filter
    # of the left keys at the scan of a large history, so what is shuffled follows the left rows.
    found = known.select(F.col(rk).alias(_FOUND)).distinct()
    rest = with_key.join(found, F.col(lk) == F.col(_FOUND), "left_outer")
    rest = rest.where(F.col(_FOUND).isNull()).drop(_FOUND)
    without_key = left.where(F.col(lk).isNull())
    return matched.drop(*_HELPERS), rest.unionAll(without_key).drop(*_HELPERS)


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_nulls_by: Sequence[str] = (),
    hot_right: bool = False,
    truncate: bool = False,
) -> DataFrame:
    """Left outer join.

    Left rows without a key match nothing, yet all hash to one task. Where the key is null for
    many rows, name left columns that differ between them in ``spread_nulls_by``: the rows are
    then spread by a hash of these columns. It is a function of the row, so a task that is run
    again after a lost executor sends every row to the same place.

    ``hot_right`` is for a large right side with very many rows of one key. Spark does not split
    those in an outer join, so they are joined by an inner one, and an anti join adds the left
    rows without a partner. Both sides may then be evaluated more than once, so neither may hold
    fresh keys.
    """
    lhs, rhs, lk, rk = _keyed(left, right, left_key, right_key, truncate)
    if hot_right:
        matched, rest = _matched_and_rest(lhs, rhs, rhs, lk, rk)
        return matched.unionByName(rest, allowMissingColumns=True)
    on = F.col(lk) == F.col(rk)
    if spread_nulls_by:
        bucket = F.pmod(F.hash(*spread_nulls_by), F.lit(NULL_BUCKETS))
        spread = F.when(F.col(lk).isNull(), bucket).otherwise(F.lit(0))
        lhs = lhs.withColumn(_SPREAD, spread)
        # Always 0, but not a constant that the optimizer would take out of the join key.
        rhs = rhs.withColumn(_FIXED, F.pmod(F.hash(rk), F.lit(1)))
        on = on & (F.col(_SPREAD) == F.col(_FIXED))
    return lhs.join(rhs, on, "left_outer").drop(*_HELPERS)


# Keys that are looked for in one pass, and how many more the pass keeps count of.
HEAVY_KEYS, _TRACKED = 2048, 8
_PLACE, _ROWS_A, _ROWS_B, _A, _B = "__place", "__rows_a", "__rows_b", "__a", "__b"


def _placed(df: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame, int]:
    """The frame written aside, its heavy keys with about how many rows each has, and a task's share.

    The keys are counted while the rows are written, by a summary of bounded size. Every row gets its
    place in the files, which spreads even rows that are alike and is the same when a task is run again.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(2 * tasks, HEAVY_KEYS)
    path, seen = scratch_path(spark, label), Observation()
    top = F.expr(f"approx_top_k(`{key}`, {most}, {_TRACKED * most})").alias("top")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), top).write.parquet(path)
    share = max(1, -(-seen.get["rows"] // tasks))
    # What exceeds half a task's share: at most two keys a task.
    heavy = [(r["item"], r["count"]) for r in seen.get["top"] or () if r["item"] is not None and 2 * r["count"] > share]
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(_FOUND, kind), T.StructField(_TIMES, T.LongType())])
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(_PLACE)
    back = spark.read.schema(df.schema).parquet(path).select("*", place)
    return back, spark.createDataFrame(heavy, schema), share


def left_join_heavy(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, truncate: bool = False
) -> DataFrame:
    """Left outer join of sides that are computed, where a key may be heavy on either side or both.

    Each side is evaluated once and written aside, and its heavy keys are found on the way. The left
    rows of a heavy key are dealt over A groups and its right rows over B, as many as
    their rows fill tasks; left rows are copied to all B and right rows to all A, so each pair
    meets once. A key that is heavy on the right has partners, so it takes an inner join, which
    needs no copy to stay without one; the others take a left outer join with one group on the right.
    Left rows without a key are spread by their place.
    """
    lhs, rhs, lk, rk = _keyed(left, right, left_key, right_key, truncate)
    rhs = rhs.where(F.col(rk).isNotNull())
    lhs, many_left, share_left = _placed(lhs, lk, "left")
    rhs, many_right, share_right = _placed(rhs, rk, "right")

    def groups(rows: str, share: int) -> Column:
        # Of half a share each, since several groups may fall to one task.
        return F.coalesce(F.ceil(F.col(rows) * 2 / share), F.lit(1)).cast("int")

    # At most two keys a task and side, so this is small on any input.
    heavy = F.broadcast(
        many_left.withColumnRenamed(_TIMES, _ROWS_A)
        .join(many_right.withColumnRenamed(_TIMES, _ROWS_B), _FOUND, "full_outer")
        .select(_FOUND, groups(_ROWS_A, share_left).alias(_A), groups(_ROWS_B, share_right).alias(_B), F.col(_ROWS_B).isNotNull().alias(_ROWS_B))
    )

    def tagged(df: DataFrame, key: str) -> DataFrame:
        known = df.join(heavy, F.col(key) == F.col(_FOUND), "left_outer")
        return known.withColumns({_A: F.coalesce(_A, F.lit(1)), _B: F.coalesce(_B, F.lit(1)), _ROWS_B: F.coalesce(_ROWS_B, F.lit(False))})

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.col(_PLACE), F.col(own)).cast("int")
        all_others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.withColumn("__mine", mine).withColumn("__theirs", all_others)

    lefts, rights = dealt(tagged(lhs, lk), _A, _B), dealt(tagged(rhs, rk), _B, _A)
    null_bucket = F.pmod(F.col(_PLACE), F.lit(NULL_BUCKETS)).cast("int")
    group = F.when(F.col(lk).isNull(), null_bucket).otherwise(F.col("__mine"))
    lefts = lefts.withColumns({"__a": group, "__b": F.col("__theirs")})
    rights = rights.select(F.col(rk).alias(_FIXED), F.col("__theirs").alias("__ra"), F.col("__mine").alias("__rb"), F.col(_ROWS_B).alias("__rh"), *right.columns)
    on = (F.col(lk) == F.col(_FIXED)) & (F.col("__a") == F.col("__ra")) & (F.col("__b") == F.col("__rb"))
    columns = [*left.columns, *right.columns]
    hot = lefts.where(F.col(_ROWS_B)).join(rights.where(F.col("__rh")), on, "inner").select(*columns)
    rest = lefts.where(~F.col(_ROWS_B)).join(rights.where(~F.col("__rh")), on, "left_outer").select(*columns)
    return hot.unionAll(rest)


def left_join_keys(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_nulls_by: Sequence[str] = (),
    truncate: bool = False,
) -> DataFrame:
    """Left outer join that needs only the right side's key: a left row once for each equal key.

    The right keys are counted, merged before the shuffle, so a key with very many rows is one row
    in the join; matched left rows are then repeated as often as the key occurs. The repetition is
    in two steps, so no row ever holds an array of more than ``COPY_BLOCK`` or count / ``COPY_BLOCK``.
    """
    counted = right.groupBy(right_key).agg(F.count(F.lit(1)).alias(_TIMES))
    joined = left_join(
        left, counted, left_key, right_key, spread_nulls_by, truncate=truncate
    )
    times = F.coalesce(F.col(_TIMES), F.lit(1).cast("bigint"))
    one = F.lit(1).cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / COPY_BLOCK))
    left_over = times - F.col(_BLOCK) * COPY_BLOCK
    size = F.least(left_over, F.lit(COPY_BLOCK).cast("bigint"))
    return (
        joined.withColumn(_BLOCK, F.explode(blocks))
        .withColumn(_COPY, F.explode(F.sequence(one, size)))
        .drop(_TIMES, _BLOCK, _COPY)
    )


def left_join_dated(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    date: dt.date,
    date_column: str = LOAD_DATE,
    truncate: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Left outer join, then keep rows whose partner is of the date, has no date, or is absent.

    Returns the matched rows (columns of both sides; the right's date column is left out) and the
    left rows that have no partner of any date. Only partners of the date travel in full; for the
    others the key alone is read. The matched part is an inner join, so a hot key can be split on
    either side. Both sides may be evaluated more than once, so neither may hold fresh keys.
    """
    lhs, rhs, lk, rk = _keyed(left, right, left_key, right_key, truncate)
    partners = on_date_or_missing(rhs, date_column, date).drop(date_column)
    return _matched_and_rest(lhs, partners, rhs, lk, rk)


def distinct_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, truncate: bool = False
) -> DataFrame:
    """Distinct rows of the inner join, without the right key.

    Both sides are made distinct before they meet, which gives the same rows as a distinct above
    the join (the left key is among the output) and never multiplies copies by copies. With no
    aggregate above it, adaptive execution may split a hot member on either side.
    """
    lhs, rhs, lk, rk = _keyed(left.distinct(), right, left_key, right_key, truncate)
    others = [F.col(name) for name in right.columns if name != right_key]
    rhs = rhs.select(F.col(rk).alias(_RIGHT), *others).distinct()
    return lhs.join(rhs, F.col(lk) == F.col(_RIGHT), "inner").drop(*_HELPERS)


def star_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, *columns: str
) -> DataFrame:
    """Inner join giving every left column and the named right ones."""
    lhs, rhs, lk, rk = _keyed(left, right, left_key, right_key)
    return (
        lhs.alias("l")
        .join(rhs.alias("r"), F.col(f"l.{lk}") == F.col(f"r.{rk}"), "inner")
        .select("l.*", *(f"r.{name}" for name in columns))
        .drop(*_HELPERS)
    )
