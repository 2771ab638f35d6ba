"""Which rows a classifier may learn from, and a bounded sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewright.llm.common import written

#: What the hash of an id is spread over.
RANGE = 1 << 30


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a document is held out by the CRC-32 of its id; rows without an id always are."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(True))


def spread(doc_id: Column) -> Column:
    """A place in ``RANGE`` for a document."""
    return F.pmod(F.xxhash64(doc_id), F.lit(RANGE))


def thinned(rows: DataFrame, per: int, most: int) -> DataFrame:
    """About one and a half times ``per`` rows (``id, stratum, size``) of each stratum, by a hash of the id.

    Rows of a size over ``most`` are drawn, as many again, only for strata with fewer than ``per``
    others. The strata, classes or languages, are few and are counted first, so that rows are thinned
    where they are read and no stratum is ever brought together. ``place`` is what to order by.
    """
    fits = F.col("size") <= most
    counts = F.count_if(fits).alias("short"), F.count_if(~fits).alias("long")
    counted = rows.groupBy("stratum").agg(*counts).collect()
    if not counted:
        return rows.withColumn("place", spread(F.col("id"))).limit(0)

    def limit(wanted) -> Column:
        # At least one row, so that no division is by zero.
        pairs = [(r.stratum, min(RANGE, int(1.5 * per * RANGE / max(1, n)))) for r in counted for n in wanted(r)]
        return F.create_map(*[F.lit(x) for pair in pairs for x in pair])[F.col("stratum")] if pairs else F.lit(-1)

    few = limit(lambda r: [r.long] if r.short < per else [])
    place = rows.withColumn("place", spread(F.col("id")))
    return place.filter(F.col("place") <= F.when(fits, limit(lambda r: [r.short])).otherwise(F.coalesce(few, F.lit(-1))))


def sampled(rows: DataFrame, per: int, most: int) -> DataFrame:
    """At most ``per`` rows (``id, stratum, size``) of each stratum, the first by a hash of the id.

    Those of a size up to ``most`` come first. Where they are fewer, longer ones fill up, drawn by the
    hash as well and the shortest of these first, as long as all of the stratum stay within
    ``per * most`` together; rows that are longer by themselves are left out before anything is drawn.
    """
    longer = F.when(F.col("size") > most, F.col("size")).otherwise(0)
    order = Window.partitionBy("stratum").orderBy("longer", "place", "id", "size")
    so_far = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        thinned(rows.filter(F.col("size") <= per * most), per, most)
        .withColumn("longer", longer)
        .withColumn("number", F.row_number().over(order))
        .withColumn("so_far", so_far)
        .filter((F.col("number") <= per) & (F.col("so_far") <= per * most))
        .drop("longer", "number", "so_far")
    )


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    modulus: int,
    remainder: int,
    per: int,
    most_chars: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[list[str], list[int], float]:
    """Whole texts and 0/1 labels of a bounded sample, and the share of label 1 among all labels.

    Only rows that are not held out count. ``per`` rows of each class are taken at most, drawn from
    the texts of up to ``most_chars``; a class with fewer of these is filled up with longer
    texts. All of a class have ``per * most_chars`` characters at most, which bounds what the
    driver gets; only a text longer than that by itself is never learned from. Labels other than 0
    and 1 and rows without a text teach nothing; an id with several labels has the least, one with
    several texts the shortest. The share is 0.5 if there are no labels.
    """
    rows = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & ~held_out(F.col("id"), modulus, remainder))
        .groupBy("id")
        .agg(F.min("y").alias("stratum"))
    )
    share = rows.agg(F.avg("stratum")).first()[0]
    own = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.length(F.col(text)).cast("long").alias("size")
    ).filter(F.col("size").isNotNull())
    # Without the texts, written once since it is counted and then drawn from.
    sizes = rows.join(own.select("id", "size"), "id").groupBy("id", "stratum").agg(F.min("size").alias("size"))
    chosen = sampled(written(sizes, "labelled"), per, most_chars).select("id", "stratum", "size")
    # At most 2 * per ids: a size that does not grow with the data.
    found = own.join(F.broadcast(chosen), ["id", "size"]).groupBy("id", "stratum").agg(F.min("text").alias("text"))
    pairs = sorted((r.id, r.text, r.stratum) for r in found.collect())
    bounded = 0.5 if share is None else min(max(share, 1e-3), 1 - 1e-3)
    return [text for _, text, _ in pairs], [y for _, _, y in pairs], bounded


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature under which these logits are likeliest, between a tenth and ten.

    A few labels in a thousand are taken to be wrong, or rows that are told apart without a
    mistake would ask for certainty.
    """
    if not len(y):
        return 1.0
    y = 0.005 + 0.99 * y
    losses = []
    for temperature in np.geomspace(0.1, 10, 81):
        p = np.clip(sigmoid(logits / temperature), 1e-9, 1 - 1e-9)
        losses.append((-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean(), temperature))
    return float(min(losses)[1])
