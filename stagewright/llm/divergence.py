"""How far the sources of a language differ in the terms they use.

Terms are runs of letters and of all characters beyond ASCII, A-Z in lower case. A language keeps the
terms of at least ``LEAST_DOCS`` of its documents. They are sorted over the cluster and numbered from
0 in the order of their bytes; every ``BLOCK`` of them becomes a minimal acyclic transducer, built
from the sorted terms in one pass: a state whose continuations are final is merged with an equal one,
and each edge adds the number of terms that its state accepts before it, so that a path adds up to
the term's ordinal. All texts are then streamed through the transducers and counted again by ordinal.
From there on terms are numbers; an ordinal also breaks ties, and is spelled again at the end.

The transducers are sent to the tasks, at most about ``ROUND_BYTES`` in a round; a vocabulary beyond
that takes several rounds, each of which reads the texts. Counts travel packed, one row for a group
and block in a task, and are added up in two steps, so that no task gets all rows of a hot source.
Divergences are computed for tiles of ``TILE`` sources by block, whose sums are whole numbers.

Null texts, languages and sources are empty. Every occurring source of a language has its rows, also
without terms; a language without kept terms has divergences of zero and no terms. An empty table
gives an empty result. Alike rows are documents of their own.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewright.llm.common import small_batches, written

LEAST_DOCS, TOP = 3, 200
#: What a share of one is in whole numbers.
UNIT = 1_000_000_000
#: Terms of a transducer, sources of a tile.
BLOCK, TILE = 1 << 14, 32
#: Bytes of transducers that a task holds at a time.
ROUND_BYTES = 64 << 20
#: Counts that a task keeps before it passes them on.
KEPT_COUNTS = 400_000
#: Ways that the counts of a group and block are first spread over.
SPREAD = 64

_TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in order; ``bytes.lower`` touches A-Z only."""
    return _TERM.findall(text.lower())


@dataclass
class Transducer:
    """State 0 is the start; ``keys`` holds state * 256 + byte of every edge in order."""

    keys: np.ndarray
    leads: np.ndarray
    adds: np.ndarray
    final: np.ndarray

    def ordinals(self, terms: Sequence[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 for one that is not accepted."""
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        flat = np.frombuffer(b"".join(terms), np.uint8)
        starts = np.cumsum(sizes) - sizes
        out = np.full(len(terms), -1, np.int64)
        state, total = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        live, step = np.arange(len(terms)), 0
        while len(live):
            ends = sizes[live] == step
            done = live[ends & self.final[state[live]]]
            out[done] = total[done]
            live = live[~ends]
            keys = state[live] << 8 | flat[starts[live] + step]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            live, at = live[hit], at[hit]
            state[live] = self.leads[at]
            total[live] += self.adds[at]
            step += 1
        return out


def build(terms: Sequence[bytes]) -> Transducer:
    """The minimal transducer of sorted distinct non-empty terms, one term after the other."""
    known: dict[tuple, int] = {}
    accepts: list[int] = []

    def settle(node: list) -> int:
        """The state that stands for a node whose continuations no later term can change."""
        whole = (node[0], *node[1])
        if whole not in known:
            known[whole] = len(accepts)
            accepts.append(node[0] + sum(accepts[child] for _, child in node[1]))
        return known[whole]

    open_: list[list] = [[False, []]]
    before = b""
    for term in terms:
        shared = 0
        while shared < len(before) and shared < len(term) and before[shared] == term[shared]:
            shared += 1
        for depth in range(len(before), shared, -1):
            state = settle(open_.pop())
            open_[-1][1].append((before[depth - 1], state))
        open_.extend([False, []] for _ in range(len(term) - shared))
        open_[-1][0] = True
        before = term
    for depth in range(len(before), 0, -1):
        state = settle(open_.pop())
        open_[-1][1].append((before[depth - 1], state))
    # The start comes first: no edge leads back to it.
    start = settle(open_[0])
    number = {start: 0}
    for state in known.values():
        number.setdefault(state, len(number))
    edges, final = [], np.zeros(len(accepts), bool)
    for (ends, *own), state in known.items():
        final[number[state]] = ends
        add = int(ends)
        for byte, child in own:
            edges.append((number[state] << 8 | byte, number[child], add))
            add += accepts[child]
    edges.sort()
    columns = np.array(edges, np.int64).reshape(-1, 3)
    return Transducer(columns[:, 0].copy(), columns[:, 1].astype(np.int32), columns[:, 2].astype(np.int32), final)


def share(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / (total + kept)), exact where the product passes 64 bits."""
    rest, out, whole = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64), max(1, total + kept)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + more
    return out + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return docs.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).cast("binary").alias("text"))


def vocabulary(rows: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """The kept terms of each language with their ``ordinal``, counted from 0 in the order of bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, times in seen.items():
                langs = pa.array([lang] * len(times), pa.string())
                own = pa.array(times.keys(), pa.binary())
                yield pa.record_batch({"lang": langs, "term": own, "n": pa.array(times.values(), pa.int64())})
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[lang].update(set(terms_of(text)))
            if sum(map(len, seen.values())) > KEPT_COUNTS:
                yield from passed_on()
        yield from passed_on()

    found = rows.select("lang", "text").mapInArrow(each, "lang string, term binary, n long")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    place = F.monotonically_increasing_id()
    ordered = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    # Written, so that rows keep their places: the part of the table, and the place in it.
    ordered = written(
        ordered.select("lang", "term", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at")),
        "terms",
    )
    parts = ordered.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))).drop("n")
    ordinal = F.col("offset") + F.col("at") - F.col("first")
    numbered = ordered.join(parts, ["lang", "part"]).select("lang", "term", ordinal.alias("ordinal"))
    return written(numbered, "vocabulary")


_PARTS = ("keys", "leads", "adds", "final")
_KINDS = (np.int64, np.int32, np.int32, bool)


def transducers(terms: DataFrame) -> DataFrame:
    """One row for each block of a language's terms: its first term, and the transducer's arrays."""

    def each(table: pa.Table) -> pa.Table:
        own = sorted(table["term"].to_pylist())
        t = build(own)
        lang, block = table["lang"][0].as_py(), table["block"][0].as_py()
        arrays = {name: pa.array([getattr(t, name).tobytes()], pa.binary()) for name in _PARTS}
        heads = {"lang": [lang], "block": pa.array([block], pa.int32()), "first": pa.array([own[0]], pa.binary())}
        return pa.table({**heads, "terms": pa.array([len(own)], pa.int32()), **arrays})

    schema = "lang string, block int, first binary, terms int, keys binary, leads binary, adds binary, final binary"
    block = F.expr(f"cast(ordinal div {BLOCK} as int)").alias("block")
    return terms.select("lang", "term", block).groupBy("lang", "block").applyInArrow(each, schema)


_PACKED = "lang string, source string, block int, way int, at binary, n binary, total long"


def _pack(lang: str, source: str | None, block: int, way: int, at: np.ndarray, n: np.ndarray) -> dict:
    at, n = at.astype(np.uint16).tobytes(), n.astype(np.int64)
    return {"lang": lang, "source": source, "block": block, "way": way, "at": at, "n": n.tobytes(), "total": int(n.sum())}


def _batch(packed: list[dict]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
    names = [part.split()[0] for part in _PACKED.split(", ")]
    return pa.record_batch([pa.array([row[c] for row in packed], k) for c, k in zip(names, kinds, strict=True)], names)


def recounts(rows: DataFrame, machines: DataFrame) -> DataFrame:
    """How often each group has each kept term, in packed rows (``_PACKED``).

    A group is a source of a language, or with a null source the language. ``at`` are places in the
    block, ``n`` the counts.
    """
    spark = rows.sparkSession
    size = machines.agg(F.sum(sum((F.length(name) for name in _PARTS), F.lit(0)))).first()[0] or 0
    # Blocks are dealt by a hash, so that a round has half the bound on average.
    rounds = 1 if size <= ROUND_BYTES else -(-2 * size // ROUND_BYTES)
    dealt = F.pmod(F.xxhash64("lang", "block"), F.lit(rounds))
    out = None
    for number in range(rounds):
        own: dict[str, list[tuple[bytes, int, Transducer]]] = defaultdict(list)
        for r in machines.filter(dealt == number).toArrow().to_pylist():
            arrays = [np.frombuffer(r[name], kind) for name, kind in zip(_PARTS, _KINDS, strict=True)]
            own[r["lang"]].append((r["first"], r["block"], Transducer(*arrays)))
        for blocks in own.values():
            blocks.sort(key=lambda b: b[0])
        part = _recounted(rows, spark.sparkContext.broadcast(dict(own)))
        out = part if out is None else out.union(part)
    return _added(_added(out, "way"))


def _recounted(rows: DataFrame, sent) -> DataFrame:
    kept, spread, width = KEPT_COUNTS, SPREAD, BLOCK

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        machines, way = sent.value, TaskContext.get().partitionId() % spread
        counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, by_source in counts.items():
                terms, ordinals = _transduced(set().union(*by_source.values()), machines[lang], width)
                ordinal = dict(zip(terms, ordinals.tolist(), strict=True))
                parts = []
                for source, times in by_source.items():
                    number = np.fromiter(map(ordinal.__getitem__, times), np.int64, len(times))
                    parts.append((number, np.fromiter(times.values(), np.int64, len(times))))
                    yield from _by_block(lang, source, way, *parts[-1], width)
                yield from _by_block(lang, None, way, *map(np.concatenate, zip(*parts, strict=True)), width)
            counts.clear()

        for batch in batches:
            langs, sources, texts = (batch.column(i).to_pylist() for i in range(3))
            for lang, source, text in zip(langs, sources, texts, strict=True):
                if lang in machines:
                    counts[lang][source].update(terms_of(text))
            if sum(len(c) for by_source in counts.values() for c in by_source.values()) > kept:
                yield from passed_on()
        yield from passed_on()

    return rows.mapInArrow(each, _PACKED)


def _transduced(found: set[bytes], machines: list, width: int) -> tuple[list[bytes], np.ndarray]:
    """Terms and their ordinals in the language, -1 for those that are not kept."""
    terms, firsts = sorted(found), [first for first, _, _ in machines]
    out = np.full(len(terms), -1, np.int64)
    at = [bisect_left(terms, first) for first in firsts] + [len(terms)]
    for (_, block, machine), start, end in zip(machines, at[:-1], at[1:], strict=True):
        local = machine.ordinals(terms[start:end])
        out[start:end] = np.where(local < 0, -1, local + block * width)
    return terms, out


def _by_block(lang: str, source: str | None, way: int, number: np.ndarray, n: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Counts of ordinals, which may come several times or be -1, as a packed row for each block."""
    order = np.argsort(number, kind="stable")
    number, n = number[order], n[order]
    number, n = number[(first := np.searchsorted(number, 0)) :], n[first:]
    if not len(number):
        return
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    number, n = number[starts], np.add.reduceat(n, starts)
    block = number // width
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    yield _batch([_pack(lang, source, int(block[a]), way, number[a:b] % width, n[a:b]) for a, b in zip(cuts, cuts[1:])])


def _added(packed: DataFrame, *more: str) -> DataFrame:
    """Packed rows of one group and block added up, a row at a time as they come sorted."""
    keys, width = ["lang", "source", "block", *more], BLOCK

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(width, np.int64)

        def finished() -> Iterator[pa.RecordBatch]:
            if now is not None:
                at = np.flatnonzero(sums)
                yield _batch([_pack(*now[:3], now[3] if more else 0, at, sums[at])])

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["lang"], row["source"], row["block"], row["way"] if more else 0)
                if key != now:
                    yield from finished()
                    now = key
                    sums[:] = 0
                sums[np.frombuffer(row["at"], np.uint16)] += np.frombuffer(row["n"], np.int64)
        yield from finished()

    return packed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(each, _PACKED)


def _full(at: bytes | None, n: bytes | None, terms: int) -> np.ndarray:
    out = np.zeros(terms, np.int64)
    if at is not None:
        out[np.frombuffer(at, np.uint16)] = np.frombuffer(n, np.int64)
    return out


def pair_divergences(groups: DataFrame, packed: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each source and each other of its language.

    ``groups`` has a row for each source of a language with its ``total`` and the language's ``kept``;
    ``blocks`` the number of terms of each block.
    """
    order = Window.partitionBy("lang").orderBy("source")
    tiled = groups.withColumn("no", F.row_number().over(order) - 1)
    sizes = tiled.groupBy("lang").agg(F.expr(f"cast(max(no) div {TILE} as int)").alias("last"))
    # A language without kept terms has one block of none.
    every = sizes.join(blocks, "lang", "left").select(
        "lang", "last", F.coalesce("block", F.lit(0)).alias("block"), F.coalesce("terms", F.lit(0)).alias("terms")
    )
    own = packed.filter("source is not null").select("lang", "source", "block", "at", "n")
    spread = (
        tiled.join(every, "lang")
        .join(own, ["lang", "source", "block"], "left")
        .withColumn("tile", F.expr(f"cast(no div {TILE} as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("a", F.least("tile", "other"))
        .withColumn("b", F.greatest("tile", "other"))
    )

    def each(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        shares = [share(_full(r["at"], r["n"], r["terms"]), r["total"], r["kept"]) for r in rows]
        crossed = rows[0]["a"] != rows[0]["b"]
        out = {"lang": [], "source": [], "item": [], "value": []}
        for j, other in enumerate(rows):
            for i, row in enumerate(rows):
                if i == j or (crossed and row["tile"] == other["tile"]):
                    continue
                out["lang"].append(row["lang"])
                out["source"].append(row["source"])
                out["item"].append(other["source"])
                out["value"].append(int(divergences(shares[i], shares[j]).sum()))
        return pa.table(out, schema=pa.schema([("lang", "string"), ("source", "string"), ("item", "string"), ("value", "int64")]))

    sums = spread.groupBy("lang", "block", "a", "b").applyInArrow(each, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergences(groups: DataFrame, packed: DataFrame, blocks: DataFrame, terms: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` terms that each source uses more than its language: ``lang, source, item, value, rank``."""
    whole = packed.filter("source is null")
    langs = whole.groupBy("lang").agg(F.sum("total").alias("whole"))
    of_lang = whole.select("lang", "block", F.col("at").alias("lang_at"), F.col("n").alias("lang_n"))
    rows = (
        packed.filter("source is not null")
        .drop("total")
        .join(groups, ["lang", "source"])
        .join(langs, "lang")
        .join(blocks, ["lang", "block"])
        .join(of_lang, ["lang", "block"])
        .select("lang", "source", "block", "at", "n", "total", "kept", "whole", "terms", "lang_at", "lang_n")
    )
    width = BLOCK

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at, n = np.frombuffer(r["at"], np.uint16), np.frombuffer(r["n"], np.int64)
                p = share(n, r["total"], r["kept"])
                q = share(_full(r["lang_at"], r["lang_n"], r["terms"])[at], r["whole"], r["kept"])
                more = np.flatnonzero(p > q)
                value = divergences(p[more], q[more])
                first = np.lexsort((at[more], -value))[:top]
                number = at[more][first].astype(np.int64) + r["block"] * width
                k = len(first)
                yield pa.record_batch({
                    "lang": pa.array([r["lang"]] * k, pa.string()),
                    "source": pa.array([r["source"]] * k, pa.string()),
                    "ordinal": number,
                    "value": value[first],
                })

    found = rows.mapInArrow(each, "lang string, source string, ordinal long, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(terms, ["lang", "ordinal"]).select(
        "lang", "source", F.col("term").cast("string").alias("item"), "value", "rank"
    )


def audit(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCS,
    top: int = TOP,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: both divergences of every source.

    Part ``pair`` ranks the other sources of the language, part ``term`` the first ``top`` terms.
    """
    small_batches(docs.sparkSession)
    rows = _rows(docs, text, lang, source)
    terms = vocabulary(rows, least)
    machines = written(transducers(terms), "transducers")
    blocks = machines.select("lang", "block", "terms")
    kept = blocks.groupBy("lang").agg(F.sum("terms").alias("kept"))
    packed = written(recounts(rows, machines), "recounts")
    totals = packed.filter("source is not null").groupBy("lang", "source").agg(F.sum("total").alias("total"))
    zero = F.lit(0).cast("long")
    groups = written(
        rows.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept")),
        "groups",
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergences(groups, packed, blocks).withColumn("rank", F.row_number().over(order))
    found = term_divergences(groups, packed, blocks, terms, top)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(names).union(found.withColumn("part", F.lit("term")).select(names))
