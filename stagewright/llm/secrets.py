"""Secret scans with an incremental ledger of blobs, in DataFrame operations only.

Every text is a blob addressed by its SHA-256. A ledger row says that one blob was scanned by one
version of one rule, and which spans it found, none included. A scan takes the pairs of blob and
rule version that the ledger lacks, reads each such blob once however many paths hold it, and joins
the findings of the whole ledger back to all paths.

Null texts count as empty. Rows alike in every column each get their findings. An empty table gives
an empty result. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagewright.llm.common import fresh

MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


def either_case(word: str) -> str:
    """A pattern for a word in either case of its ASCII letters."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (
    f"({'|'.join(either_case(name) for name in NAMES)})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, "[0-9a-f]+", 0, 24),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start:long,end:long>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _wide(rule: Rule) -> str:
    """The pattern for a whole run where the run itself must be long: it skips short runs at once.

    A run is matched from its start to its end, so asking for the length in the pattern finds the
    same matches as dropping the short ones afterwards.
    """
    if rule.group == 0 and rule.pattern.endswith("]+"):
        head = rule.pattern[: rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(head)},}}"
    return rule.pattern


def _long_enough(rule: Rule) -> Column:
    return F.transform(
        "hits", lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group)) >= rule.least
    )


def _matches(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per match and rule: ``blob, kind, start, end``; ``blobs`` has ``blob, content, todo``."""
    found = F.array(*[
        F.struct(
            F.lit(rule.kind).alias("kind"),
            F.when(
                F.array_contains("todo", rule.kind),
                F.regexp_extract_all("content", F.lit(_wide(rule)), F.lit(0)),
            ).alias("hits"),
        )
        for rule in rules
    ])
    kinds = blobs.select("blob", "content", F.explode(found).alias("f")).select(
        "blob", "content", F.col("f.kind").alias("kind"), F.col("f.hits").alias("hits")
    )
    kinds = kinds.filter(F.size("hits") > 0)
    between, keep = F.lit(None), F.lit(None)
    for rule in rules:
        is_kind = F.col("kind") == rule.kind
        between = F.when(is_kind, F.split("content", _wide(rule), -1)).otherwise(between)
        keep = F.when(is_kind, _long_enough(rule)).otherwise(keep)
    # The text between matches and the matches take turns, so lengths add up to places.
    lengths = kinds.select(
        "blob",
        "kind",
        F.posexplode(
            F.arrays_zip(
                F.slice(F.transform(between, F.length), F.lit(1), F.size("hits")).alias("gap"),
                F.transform("hits", F.length).alias("hit"),
                keep.alias("keep"),
            )
        ).alias("at", "m"),
    ).select(
        "blob",
        "kind",
        "at",
        F.col("m.gap").cast("long").alias("gap"),
        F.col("m.hit").cast("long").alias("hit"),
        F.col("m.keep").alias("keep"),
    )
    ends = F.sum(F.col("gap") + F.col("hit")).over(Window.partitionBy("blob", "kind").orderBy("at"))
    return (
        lengths.withColumn("end", ends)
        .filter("keep")
        .select("blob", "kind", (F.col("end") - F.col("hit")).alias("start"), "end")
    )


def scan(
    docs: DataFrame,
    *,
    path: str = "doc_id",
    text: str = "text",
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """The ledger rows that are new: one per unseen pair of blob and rule version.

    Rules of one kind differ by version; a new version is scanned over every blob again. One path
    of each blob is chosen to read it from, so blobs are compared by their address only.
    """
    paths = docs.select(F.col(path).alias("path"), blob_of(F.col(text)).alias("blob"))
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.lit(rule.kind) for rule in rules])
    if ledger is None:
        blobs = blobs.withColumn("todo", every)
    else:
        seen = ledger.filter(_current(rules)).groupBy("blob").agg(F.collect_set("kind").alias("seen"))
        blobs = (
            blobs.join(seen, "blob", "left")
            .withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
            .filter(F.size("todo") > 0)
            .drop("seen")
        )
    # By path and blob: copies of one text are on many paths, which spreads them.
    name = [F.col("path").isNull().alias("unnamed"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("name")]
    slim = blobs.select("blob", *name, "todo").hint("shuffle_hash")
    texts = docs.select(
        F.col(path).alias("path"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"),
    ).select(blob_of(F.col("content")).alias("blob"), *name, "content")
    # Hashed, not sorted: the side that is built is the slim one. One row of those alike is kept, by
    # the very columns that were joined on, so that texts are not shuffled again.
    key = ["blob", "unnamed", "name"]
    unseen = texts.join(slim, key).dropDuplicates(key).select("blob", "content", "todo")
    span = F.struct("start", "end")
    found = (
        _matches(unseen, rules)
        .groupBy("blob", "kind")
        .agg(F.array_sort(F.collect_set(span)).alias("spans"))
    )
    versions = F.create_map(*[F.lit(x) for rule in rules for x in (rule.kind, rule.version)])
    pairs = blobs.select("blob", F.explode("todo").alias("kind"))
    return pairs.join(found, ["blob", "kind"], "left").select(
        "blob",
        "kind",
        versions[F.col("kind")].cast("int").alias("version"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
    )


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(folder)


def _current(rules: tuple[Rule, ...]) -> Column:
    """Whether a ledger row is of one of these rules as they are now."""
    now = [f"{rule.kind}:{rule.version}" for rule in rules]
    return F.concat_ws(":", "kind", "version").isin(now)


def findings(
    docs: DataFrame,
    ledger: DataFrame,
    *,
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Every document with ``blob`` and ``spans``: what the ledger's current versions found in it.

    ``spans`` is an array of (start, number of the rule, end, kind) in this order, null if none.
    Columns of these names are replaced.
    """
    order = F.lit(None)
    for number, rule in enumerate(rules):
        order = F.when(F.col("kind") == rule.kind, F.lit(number)).otherwise(order)
    flat = (
        ledger.filter(_current(rules) & (F.size("spans") > 0))
        .withColumn("number", order)
        .select("blob", "kind", "number", F.explode("spans").alias("s"))
    )
    span = F.struct(F.col("s.start").alias("start"), "number", F.col("s.end").alias("end"), "kind")
    by_blob = flat.groupBy("blob").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    plain = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("blob", "spans")])
    return plain.withColumn("blob", blob_of(F.col(text))).join(by_blob, "blob", "left")


def redact(
    docs: DataFrame,
    ledger: DataFrame,
    *,
    text: str = "text",
    chars: str | None = "n_chars",
    rules: tuple[Rule, ...] = RULES,
    mask: str = MASK,
) -> DataFrame:
    """The documents with every found span, joined where spans overlap, replaced by ``mask``.

    ``chars`` names a column with the length of the text, kept up to date if it is there.
    """
    before = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("blob").orderBy("start", "end")
    joined = (
        ledger.filter(_current(rules) & (F.size("spans") > 0))
        .select("blob", F.explode("spans").alias("s"))
        .select("blob", F.col("s.start").alias("start"), F.col("s.end").alias("end"))
        .withColumn("new", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
        .withColumn("island", F.sum("new").over(through))
        .groupBy("blob", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    )
    blob, cuts = fresh(docs, "blob", "cuts")
    joined = joined.select(F.col("blob").alias(blob), F.col("cuts").alias(cuts))
    out = docs.withColumn(blob, blob_of(F.col(text))).join(joined, blob, "left")
    # The text between cut i and cut i + 1; the last stretch runs to the end.
    ends = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(text).cast("long")))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    kept = F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda z: F.substring(F.col(text), z["s"].cast("int") + 1, (z["e"] - z["s"]).cast("int")),
    )
    masked = F.when(F.col(cuts).isNull(), F.col(text)).otherwise(F.concat_ws(mask, kept))
    out = out.withColumn(text, masked)
    if chars and chars in docs.columns:
        changed = F.col(cuts).isNotNull()
        kind = docs.schema[chars].dataType
        out = out.withColumn(chars, F.when(changed, F.length(text).cast(kind)).otherwise(F.col(chars)))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
