"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewright.llm.common import shared_checkpoints


def _state(edges: DataFrame) -> tuple:
    """A digest of the set of links: it is the same only once nothing changes any more."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("u", "v")),
            F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``u, v``, longs): the least node it reaches.

    Large-star and small-star rounds: each turns links towards the least neighbour, so a chain of
    any length shrinks to a star in a logarithmic number of rounds. A round merges each node's
    neighbours to their minimum before the shuffle and makes at most two links of one; the links
    of a node with very many neighbours are a skewed join side, which adaptive execution splits.
    Every round ends in a checkpoint, so a lost executor costs one round at most.
    """
    shared_checkpoints(links.sparkSession)
    edges = (
        links.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = small.checkpoint()
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
