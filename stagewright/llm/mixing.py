"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words. Its documents stand in a row, ordered by size class, and
every document is expected ``target / source size`` times. The expected copies are summed along the
row, one offset is added, and a document is emitted once for every integer that its stretch crosses.

The row is never sorted in one task: documents are counted per cell (source, size class, bucket of
the id), the cells' starts are sums over those counts, and only within a cell is a row number taken.
A source, or a size, that holds most rows is spread over the buckets.

The offset is the best of a few seeded ones: long documents make the words of a small source depend
on it, so of ``OFFSETS`` offsets the one that lands nearest the target is used. Reruns agree.

Rows with a null text have size 0; a null source is a source of its own, the last one. Rows that are
alike in every column are dealt copies like any others. A source without words gets no copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewright.llm.common import fresh, row_hash, written

#: The words of the mix against all words, and against the words of one source at most.
SHARE, MOST = 1.5, 2.0
#: What sources weigh, in order of their names, over and over.
WEIGHTS = (3, 1, 2)
OFFSETS = 32
#: A word, as the size counts it.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters that are in no word.
BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"
#: Hex digits of the MD5 that make an offset: fewer than a double's 53 bits.
_HEX = 12


def word_count(text: Column) -> Column:
    """Matches of ``WORD``: each becomes one letter and the blanks go, so no list of words is made."""
    return F.length(F.translate(F.regexp_replace(text, WORD, "w"), BLANKS, ""))


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """The documents with ``mix_`` columns for the size and the cell."""
    size = F.coalesce(word_count(F.col(text)), F.lit(0)).cast("long")
    digits = F.col("mix_size").cast("string")
    return (
        docs.withColumn("mix_row", row_hash(docs))
        .withColumn("mix_size", size)
        .withColumn(
            "mix_source",
            F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source).cast("string"))),
        )
        # Number of digits and the first two: sizes of a class differ by a tenth at most.
        .withColumn("mix_class", F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int"))
        .withColumn(
            "mix_bucket",
            F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, 2),
        )
    )


def _starts(keyed: DataFrame) -> DataFrame:
    """The place in its source's row at which each cell starts."""
    cells = keyed.groupBy("mix_source", "mix_class", "mix_bucket").agg(F.count(F.lit(1)).alias("n"))
    classes = cells.groupBy("mix_source", "mix_class").agg(F.sum("n").alias("n"))
    by_class = Window.partitionBy("mix_source").orderBy("mix_class")
    by_bucket = Window.partitionBy("mix_source", "mix_class").orderBy("mix_bucket")
    none = F.lit(0).cast("long")

    def run(order) -> Column:
        rows = order.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(rows), none)

    classes = classes.select("mix_source", "mix_class", run(by_class).alias("class_start"))
    cells = cells.withColumn("bucket_start", run(by_bucket))
    return cells.join(classes, ["mix_source", "mix_class"]).select(
        "mix_source",
        "mix_class",
        "mix_bucket",
        (F.col("class_start") + F.col("bucket_start")).alias("mix_start"),
    )


def targets(keyed: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """One row per source with its size and target.

    Sharing by weight, cutting at ``most`` times the size and sharing the excess again ends where
    all uncut sources get the same words per weight. Sources are cut in order of size per weight,
    so that level is found by sums along this order instead of rounds.
    """
    sizes = keyed.groupBy("mix_source").agg(F.sum("mix_size").alias("mix_source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy("mix_source")) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "mix_source")
    every = Window.partitionBy(F.lit(1))
    level = (F.lit(share) * F.sum("mix_source_size").over(every) - F.col("cut")) / F.col("open")
    return (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.lit(most) * F.col("mix_source_size"))
        .withColumn(
            "cut",
            F.coalesce(
                F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
            ),
        )
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", level)
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("most"))
        # Cutting a source raises the level until none is above; from then on it would fall.
        .withColumn("level", F.max(F.when(F.col("fits"), F.col("level"))).over(every))
        .select(
            "mix_source",
            "mix_source_size",
            F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")).alias("mix_target"),
        )
    )


def _ranked(keyed: DataFrame, cells: DataFrame, doc_id: str) -> DataFrame:
    place = Window.partitionBy("mix_source", "mix_class", "mix_bucket").orderBy(
        F.col(doc_id).asc_nulls_last(), "mix_row"
    )
    return (
        keyed.withColumn("mix_place", F.row_number().over(place) - 1)
        .join(cells, ["mix_source", "mix_class", "mix_bucket"])
        .withColumn("mix_place", F.col("mix_place") + F.col("mix_start"))
    )


def _copies(offset: Column) -> Column:
    """Integers that the stretch of a document crosses."""
    at = F.col("mix_place").cast("double") * F.col("mix_rate")
    to = (F.col("mix_place") + 1).cast("double") * F.col("mix_rate")
    return F.floor(offset + to) - F.floor(offset + at)


def _offset(number: int, seed: int) -> Column:
    digest = F.md5(F.concat(F.col("mix_source"), F.lit(f":{seed}:{number}")).cast("binary"))
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("double") / F.lit(float(16**_HEX))


def plan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = SHARE,
    most: float = MOST,
    weights: tuple[int, ...] = WEIGHTS,
    offsets: int = OFFSETS,
    seed: int = 42,
    whole: bool = False,
) -> DataFrame:
    """One row per document with ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_copies``.

    Beside these it has the id, or with ``whole`` every column of the documents. Columns whose
    names start with ``mix_`` are replaced.
    """
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if not c.lower().startswith("mix_")])
    keyed = _keyed(docs, doc_id, text, source)
    slim = [doc_id, "mix_row", "mix_size", "mix_source", "mix_class", "mix_bucket"]
    counted = written(keyed.select(*slim), "mix-sizes")
    aims = targets(counted, share, most, weights).withColumn(
        "mix_rate",
        F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0),
    )
    cells = _starts(counted).join(aims, "mix_source")
    tried = _ranked(counted, cells, doc_id).groupBy("mix_source").agg(
        F.first("mix_target").alias("aim"),
        *[F.sum(_copies(_offset(j, seed)) * F.col("mix_size")).alias(f"taken_{j}") for j in range(offsets)],
    )
    nearest = F.array_min(
        F.array(*[
            F.struct(
                F.abs(F.col(f"taken_{j}") - F.col("aim")).alias("off"),
                F.lit(j).alias("number"),
                _offset(j, seed).alias("offset"),
            )
            for j in range(offsets)
        ])
    )
    chosen = tried.select("mix_source", nearest["offset"].alias("mix_offset"))
    cells = cells.join(chosen, "mix_source")
    kept = list(docs.columns) if whole else [doc_id]
    return _ranked(keyed if whole else counted, cells, doc_id).select(
        *[F.col(f"`{c}`") for c in kept],
        "mix_size",
        "mix_source_size",
        "mix_target",
        _copies(F.col("mix_offset")).cast("int").alias("mix_copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it was drawn, with their own columns."""
    # Columns named like those of the plan go by another name meanwhile.
    clashing = [c for c in docs.columns if c.lower().startswith("mix_")]
    aside = dict(zip(clashing, fresh(docs, *[f"own_{c}" for c in clashing]), strict=True))
    options = {k: aside.get(v, v) if k in ("doc_id", "text", "source") else v for k, v in options.items()}
    drawn = plan(docs.withColumnsRenamed(aside), whole=True, **options)
    copies = drawn.filter(F.col("mix_copies") > 0).withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    )
    return copies.select([F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
