"""Phrases of two to four words by partitioned mining (SON), level by level.

Texts are cut into pieces and words, per language. The documents fall into shards of ``SHARD_BYTES``;
a shard is mined completely at a support lowered in proportion to its share of all bytes: a phrase
that reaches the support in all shards together reaches the lowered one in some shard. The phrases
that are frequent in any shard are the candidates, and all candidates are counted in all shards. This
is done for two words and then for three and four, each time over phrases whose shorter parts are
frequent in all documents together: a longer phrase is never more frequent than its parts. Where the
input has so many shards that the lowered support is one everywhere, the first scan has listed and
counted every phrase already, and there is no second one.

A word of a language is known by a 64-bit number; if two words should get the same one, all are
numbered anew. What a scan looks for travels as a Bloom filter of bounded size: it may let through
too much, which only costs time, since phrases are counted by their words and held against the
support afterwards.

Null texts are empty, null languages are ``und``. Empty texts and empty tables give no phrases. Alike
rows are counted as often as they occur, and phrases that tie are ranked by their bytes.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewright.llm.common import small_batches, written

SUPPORT, LONGEST, TOP = 30, 4, 2000
#: Per cent of a phrase's occurrences that a longer one must have to replace it.
COVERED = 80
SCALE = 2_000_000
#: Bytes of text that are mined together; a longer text is a shard by itself.
SHARD_BYTES = 4 << 20
#: Bits of a filter for each phrase in it, and for all; beyond the latter a filter lets more through.
FILTER_BITS, MOST_BITS, PROBES = 16, 1 << 28, 4

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_CODES = bytes(
    10 if c in _PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_TOKENS = re.compile(rb"[^ \n]+|\n")
_COLUMNS = [f"h{i}" for i in range(1, LONGEST + 1)]


def tokens(texts: Sequence[bytes]) -> list[bytes]:
    """The words of some texts in order, a line break between pieces."""
    return _TOKENS.findall(b"\n".join(texts).translate(_CODES))


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, dict[str, list[bytes]]]]:
    """Runs of rows ``lang, text`` of about ``most`` bytes: their bytes, and their texts by language."""
    size, by_lang = 0, defaultdict(list)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if size and size + len(text) > most:
                yield size, by_lang
                size, by_lang = 0, defaultdict(list)
            by_lang[lang].append(text)
            size += len(text)
    if by_lang:
        yield size, by_lang


def numbers_of(lang: str, words: Sequence[bytes], seed: int) -> np.ndarray:
    """The numbers of words of a language; zero stands for no word."""
    start = lang.encode() + b"\xff"
    digest = xxhash.xxh64_intdigest
    found = np.fromiter((digest(start + word, seed) for word in words), np.uint64, len(words))
    return np.maximum(found, 1).view(np.int64)


@dataclass
class Filter:
    """A Bloom filter of phrases, each given by the numbers of its words."""

    bits: np.ndarray

    def has(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        out = np.ones(len(columns[0]), bool)
        for place in probes(columns, len(self.bits) * 64):
            out &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def probes(columns: Sequence[np.ndarray], size: int) -> list[np.ndarray]:
    """Places of phrases in a filter of so many bits, a power of two."""
    mixed = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        mixed = (mixed ^ column.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    step = (mixed >> np.uint64(17)) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    return [mixed + np.uint64(i) * step & np.uint64(size - 1) for i in range(PROBES)]


def filter_of(phrases: DataFrame, columns: Sequence[str]) -> Filter:
    """The filter of a table of phrases; tasks set their bits, of which there are at most ``MOST_BITS``."""
    wanted = max(1 << 12, phrases.count() * FILTER_BITS)
    size = min(MOST_BITS, 1 << (wanted - 1).bit_length())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]
            place = np.unique(np.concatenate(probes(own, size)))
            word = place >> np.uint64(6)
            starts = np.flatnonzero(np.diff(word, prepend=word[0] + np.uint64(1)))
            bits = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), starts) if len(place) else place
            yield pa.record_batch({"at": word[starts].view(np.int64), "bits": bits.view(np.int64)})

    parts = phrases.select(*columns).mapInArrow(each, "at long, bits long")
    merged = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[merged["at"].to_numpy()] = merged["bits"].to_numpy()
    return Filter(bits.view(np.uint64))


def mined(
    found: Sequence[bytes],
    lang: str,
    seed: int,
    known: dict[int, Filter],
    sizes: Sequence[int],
    least: int,
    wanted: Filter | None = None,
) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Phrases of the given sizes among tokens: columns of word numbers, and how often each occurs.

    Phrases of ``least`` occurrences count whose parts are in the filters ``known`` by size; with
    ``wanted`` only phrases of that filter do.
    """
    own = sorted(set(found) - {b"\n"})
    numbers = numbers_of(lang, own, seed)
    use = np.flatnonzero(known[1].has([numbers]))
    numbers = numbers[use]
    code = {own[i]: n for n, i in enumerate(use.tolist())}
    ids = np.fromiter(map(code.get, found, repeat(-1)), np.int64, len(found))
    good, unit, parts = ids >= 0, ids, [numbers]
    pairs = None
    for m in range(2, max(sizes) + 1):
        good = good[:-1] & (ids[m - 1 :] >= 0)
        if pairs is not None:
            good &= pairs[m - 2 :]
        at = np.flatnonzero(good)
        keys, back, times = np.unique(unit[at] << 32 | ids[at + m - 1], return_inverse=True, return_counts=True)
        parts = [*(part[keys >> 32] for part in parts), numbers[keys & 0xFFFFFFFF]]
        enough = times >= least
        if m in sizes:
            emit = enough if wanted is None else enough & wanted.has(_wide(parts))
            if emit.any():
                yield [part[emit] for part in parts], times[emit]
        if m in known:
            enough = enough & known[m].has(parts)
        good[at] = enough[back]
        if m == 2:
            pairs = good.copy()
        unit = np.zeros(len(good), np.int64)
        unit[at] = back


def _wide(parts: list[np.ndarray]) -> list[np.ndarray]:
    return parts + [np.zeros(len(parts[0]), np.int64)] * (LONGEST - len(parts))


def word_counts(rows: DataFrame, seed: int) -> DataFrame:
    """Every word (``lang, word, h, f``) of rows ``lang, text``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, by_lang in shards(batches, SHARD_BYTES):
            for lang, texts in by_lang.items():
                times = Counter(tokens(texts))
                times.pop(b"\n", None)
                own = list(times)
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang] * len(own), pa.string()),
                        "word": pa.array(own, pa.binary()),
                        "h": numbers_of(lang, own, seed),
                        "n": pa.array(times.values(), pa.int64()),
                    }
                )

    parts = rows.mapInArrow(each, "lang string, word binary, h long, n long")
    return parts.groupBy("lang", "word", "h").agg(F.sum("n").alias("f"))


def _scan(rows: DataFrame, seed: int, known: dict, sizes: tuple, share, wanted) -> DataFrame:
    """Phrases and their counts in every shard; ``share`` is (support, bytes of all shards) or None."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((known, wanted))
    names = _COLUMNS[: max(sizes)]
    most = SHARD_BYTES

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, only = sent.value
        for size, by_lang in shards(batches, most):
            least = 1 if share is None else max(1, -(-share[0] * size // share[1]))
            for lang, texts in by_lang.items():
                for parts, times in mined(tokens(texts), lang, seed, filters, sizes, least, only):
                    wide = _wide(parts)
                    yield pa.record_batch({**{c: wide[i] for i, c in enumerate(names)}, "n": times.astype(np.int64)})

    schema = ", ".join(f"{name} long" for name in [*names, "n"])
    return rows.mapInArrow(each, schema).groupBy(*names).agg(F.sum("n").alias("a"))


def _level(rows: DataFrame, seed: int, known: dict, sizes: tuple, support: int, total: int, longest: int) -> DataFrame:
    """The phrases of the given sizes that reach the support, with their counts (``a``)."""
    names = _COLUMNS[: max(sizes)]
    local = _scan(rows, seed, known, sizes, (support, total), None)
    if support * max(SHARD_BYTES, longest) > total:
        # Some shard's support may be above one, so that it left out what is rare there.
        candidates = local.select(*names)
        padded = candidates.select(*names, *[F.lit(0).cast("long").alias(c) for c in _COLUMNS[max(sizes) :]])
        local = _scan(rows, seed, known, sizes, None, filter_of(written(padded, "candidates"), _COLUMNS))
    return written(local.filter(F.col("a") >= support), "phrases")


def _parts(of: Column, offset: int, size: int) -> list[Column]:
    """Columns of the part of ``size`` words at an offset, zero after its end."""
    zero = F.lit(0).cast("long")
    return [F.col(_COLUMNS[offset + i]) if i < size else zero for i in range(LONGEST - 1)]


def frequent(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", support: int = SUPPORT
) -> tuple[DataFrame, DataFrame]:
    """All words (``lang, word, h, f``), and the phrases of one to four words that reach the support.

    A phrase has the numbers of its words in ``h1`` to ``h4``, zero after its last, and ``a``.
    """
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), body.alias("text"))
    sizes = rows.agg(F.sum(F.length("text")), F.max(F.length("text"))).first()
    total, longest = max(1, sizes[0] or 0), sizes[1] or 0
    for seed in count():
        words = written(word_counts(rows, seed), "words")
        if words.groupBy("h").count().filter("count > 1").isEmpty():
            break
    singles = words.filter(F.col("f") >= support).select(F.col("h").alias("h1"), F.col("f").alias("a"))
    known = {1: filter_of(singles, ["h1"])}
    pairs = _level(rows, seed, known, (2,), support, total, longest)
    known[2] = filter_of(pairs, ["h1", "h2"])
    more = _level(rows, seed, known, (3, 4), support, total, longest)
    zero = F.lit(0).cast("long")
    return words, (
        singles.select("h1", zero.alias("h2"), zero.alias("h3"), zero.alias("h4"), "a")
        .union(pairs.select("h1", "h2", zero.alias("h3"), zero.alias("h4"), "a"))
        .union(more.select("h1", "h2", "h3", "h4", "a"))
    )


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    covered: int = COVERED,
) -> DataFrame:
    """Every phrase of two to four words that no longer one replaces.

    Returns ``lang, phrase, a, l, r, n, score``: its occurrences, those of the two parts at its
    lowest-scoring cut, all words of the language, and the score ``floor(SCALE * a / (l + r))`` there.
    """
    words, grams = frequent(docs, text=text, lang=lang, support=support)
    grams = grams.withColumn("m", sum(((F.col(c) != 0).cast("int") for c in _COLUMNS), F.lit(0)))
    long = grams.filter("m > 1")
    wide = "decimal(38,0)"
    cuts = F.array(*[
        F.struct(
            F.lit(k).alias("k"),
            *[c.alias(f"l{i}") for i, c in enumerate(_parts(None, 0, k), 1)],
            *[c.alias(f"r{i}") for i, c in enumerate(_parts(None, k, LONGEST - k), 1)],
        )
        for k in range(1, LONGEST)
    ])
    part = grams.filter("m < 4").select(*_COLUMNS[:3], F.col("a").alias("f"))
    left, right = (part.toDF(*[f"{side}{i}" for i in (1, 2, 3)], side) for side in "lr")
    cut = (
        long.select(*_COLUMNS, "a", "m", F.explode(cuts).alias("c"))
        .filter(F.col("c.k") < F.col("m"))
        .select(*_COLUMNS, "a", "c.*")
        .join(left, ["l1", "l2", "l3"])
        .join(right, ["r1", "r2", "r3"])
        .withColumn("score", F.expr(f"cast({SCALE} as {wide}) * a div (cast(l as {wide}) + r)"))
        .groupBy(*_COLUMNS, "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    inner = F.array(*[
        F.struct(F.lit(o + n).alias("end"), *[c.alias(f"s{i}") for i, c in enumerate(_parts(None, o, n), 1)])
        for n in (2, 3)
        for o in range(LONGEST - n + 1)
    ])
    # A part of two words in one of three, and so on: never the phrase itself.
    inside = (
        long.filter("m > 2")
        .select("a", "m", F.explode(inner).alias("c"))
        .filter((F.col("c.end") <= F.col("m")) & ((F.col("m") > 3) | (F.col("c.s3") == 0)))
        .groupBy("c.s1", "c.s2", "c.s3")
        .agg(F.max("a").alias("longer"))
    )
    on = (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")) & (F.col("h3") == F.col("s3")) & (F.col("h4") == 0)
    replaced = F.col("longer").cast(wide) * 100 >= F.col("a").cast(wide) * covered
    left_over = cut.join(inside, on, "left").filter(~F.coalesce(replaced, F.lit(False)))
    spelled = words.filter(F.col("f") >= support).select("h", "lang", F.col("word").cast("string").alias("word"))
    named = (
        left_over.select(*_COLUMNS, F.posexplode(F.array(*_COLUMNS)).alias("at", "h"))
        .filter("h <> 0")
        .join(spelled, "h")
        .groupBy(*_COLUMNS)
        .agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select(*_COLUMNS, "lang", F.array_join(F.col("w.word"), " ").alias("phrase"))
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return (
        left_over.join(named, _COLUMNS)
        .join(totals, "lang")
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    )


def top_phrases(docs: DataFrame, *, top: int = TOP, **options) -> DataFrame:
    """Each language's first phrases by score, occurrences and bytes, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        collocations(docs, **options)
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
