"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has a bit set where more than half of its shingle hashes have it set. For
radius r, every bit position gets a non-zero vector of r + 1 bits, and every non-zero v of r + 1
bits gives a mask of the positions whose vector has an odd product with v. Fingerprints that differ
in at most r positions meet in some table: the vectors of r positions span at most r dimensions, so
some v is orthogonal to all of them and its mask leaves those positions out. With r = 2 these are 7
tables of about 36 bits, and no pair within the radius is missed.

Equal fingerprints are merged first, so copies cost one row. In a small bucket pairs are compared.
In a larger one each fingerprint is linked through its neighbours: two values within distance 2 that
agree under the mask have a common value at distance at most 1 from both, which also agrees under
the mask; so every fingerprint is listed under itself and under each value that differs in one
position outside the mask, and those listed together are linked to the least one. That costs about
30 rows per fingerprint, not the square of the bucket, and links exactly those within the radius.

Null and empty texts have no words and the fingerprint zero. Rows alike in every column share a
fingerprint and a component. A component's id is the least id in it, null if all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewright.llm.common import fresh, slices, small_batches, written
from stagewright.llm.components import components

BITS, SEED, SHINGLE, RADIUS = 64, 42, 3, 2
#: Buckets of more fingerprints than this are linked through neighbours instead of pairs.
PAIRED = 32
#: Shingles whose bits a worker counts at a time.
_CHUNK = 200_000


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of words, A-Z in lower case, joined by one space."""
    # bytes.lower() touches A-Z only; bytes.split() cuts at 0x20 and 0x09 to 0x0D.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: n - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n - shingle + 1
    )


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        # Ones of every bit: as 0/1 bytes, summed in runs short enough for a byte.
        bits = np.unpackbits(part, axis=1)
        for run in range(0, len(bits), 255):
            counts += bits[run : run + 255].sum(axis=0, dtype=np.uint8)
    return counts


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    ones = (_bit_counts(hashes) * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones).view(">i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint_of(x, shingle) for x in batch], dtype="int64")

    return each(text)


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The covering masks, as signed numbers: 2 ** (radius + 1) - 1 of them."""
    top = 1 << (radius + 1)
    vectors = [1 + i % (top - 1) for i in range(bits)]
    out = []
    for v in range(1, top):
        mask = sum(1 << i for i, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``u, v`` that join all values (``fp``, distinct) within the radius of each other.

    Both ends of a link differ in at most ``radius`` bits, and values within the radius are joined
    directly or, in a large bucket, by way of a value within the radius of both.
    """
    if radius not in (1, 2):
        raise ValueError("large buckets are linked through neighbours for radius 1 and 2")
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("mask")) for t, m in enumerate(masks(radius))
    ])
    spread = values.select("fp", F.explode(tables).alias("m")).select(
        "fp",
        F.col("m.t").alias("t"),
        F.col("m.mask").alias("mask"),
        F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"),
    )
    sizes = spread.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = spread.join(sizes, ["t", "key"])
    few, many = member.filter(F.col("n") <= PAIRED), member.filter(F.col("n") > PAIRED)
    left = few.select("t", "key", F.col("fp").alias("u"))
    right = few.select("t", "key", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
    pairs = left.join(right, ["t", "key"]).filter((F.col("u") > F.col("v")) & near).select("u", "v")
    signed = [0, *(1 << i for i in range(BITS - 1)), -(1 << (BITS - 1))]
    flips = F.array(*[F.lit(x).cast("long") for x in signed])
    listed = (
        many.select("fp", "t", "mask", F.explode(flips).alias("flip"))
        .filter(F.col("flip").bitwiseAND(F.col("mask")) == 0)
        .select("fp", "t", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    )
    if radius == 1:
        # At distance 1 the two values list each other.
        own = many.select("t", F.col("fp").alias("middle")).distinct()
        stars = listed.join(own, ["t", "middle"]).select(F.col("fp").alias("u"), F.col("middle").alias("v"))
    else:
        least = listed.groupBy("t", "middle").agg(F.min("fp").alias("v"))
        stars = listed.join(least, ["t", "middle"]).select(F.col("fp").alias("u"), "v")
    return pairs.union(stars.filter((F.col("u") != F.col("v")) & near)).distinct()


def clusters(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per document: its id, ``row``, ``fingerprint`` (long), ``component`` and ``component_id``.

    ``row`` is a 64-bit hash of the text, which tells rows of one id apart; ``component`` is a
    fingerprint that stands for the component, and ``component_id`` the least id in it.
    """
    small_batches(docs.sparkSession)
    prints = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row"),
            fingerprints(F.col(text), shingle).alias("fingerprint"),
        ),
        "simhash",
    )
    values = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least"))
    roots = components(links(values.select("fp"), radius))
    of_value = values.join(roots, values.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("component")
    )
    ids = of_value.groupBy("component").agg(F.min("least").alias("component_id"))
    known = of_value.select("fp", "component").join(ids, "component")
    out = prints.join(known, prints.fingerprint == known.fp).select(
        "doc_id", "row", "fingerprint", "component", "component_id"
    )
    return out.withColumnRenamed("doc_id", doc_id)


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with one row of each component: the least id, then the least text hash."""
    found = clusters(docs, doc_id=doc_id, text=text, **options)
    first = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), "row")
    stay = found.groupBy("component").agg(F.min(first).alias("first")).select("first.id", "first.row")
    row, place = fresh(docs, "row", "place")
    stay = stay.select(F.col("id").alias("keep_id"), F.col("row").alias("keep_row"))
    keyed = docs.withColumn(row, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    kept = keyed.join(
        stay, F.col(f"`{doc_id}`").eqNullSafe(stay.keep_id) & (F.col(row) == stay.keep_row), "left_semi"
    )
    # Rows of one id and one text are the same document twice.
    alike = Window.partitionBy(doc_id, row).orderBy(row)
    return (
        kept.withColumn(place, F.row_number().over(alike))
        .filter(F.col(place) == 1)
        .select([F.col(f"`{c}`") for c in docs.columns])
    )
