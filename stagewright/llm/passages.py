"""Removal of repeated passages by suffix arrays.

A byte goes if some string of ``LENGTH`` bytes that covers it starts anywhere else as well, in the
same document or another; strings are judged on the input. Every such string, every window, has an
anchor: the leftmost least of the hashes of its 32-byte strings. Equal windows have equal anchors, so
what one shard has to compare is brought together by the anchor's hash, and an anchor that occurs
once needs no look at its bytes at all. The steps:

1. Each document gives its anchors, about one in 80 bytes: the windows that have it (they are in one
   run), the anchor's hash, and a hash of the run's bytes.
2. Anchors with one occurrence are dropped. Runs with the same two hashes are of one kind.
3. One run of each kind, or two where it occurs more often, is read from its document and dealt to a
   shard by the anchor's hash. A shard of bounded size sorts all suffixes of its runs by
   Larsson-Sadakane refinement, takes the common prefixes of neighbours by Kasai's walk, and so knows
   the windows that start more than once. What it finds in a pair holds for every run of the kind.
4. An anchor with very many different runs is cut into several shards. Each sorts the digests of its
   windows, cuts them by binary search at bounds that all its shards share, and one task per range
   looks each digest up in the merged run of all shards.
5. The spans of every document are joined to it, and its remaining bytes are hashed or kept.

Null texts count as empty. Equal texts of ``LENGTH`` bytes or more go whole, in every row, also where
rows are alike in every column. Hashes of anchors and runs have 64 bits each and are compared
together; windows of an anchor in several shards are compared by digests of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from stagewright.llm.common import fresh, slices, small_batches, written

#: Bytes of a window, and of the strings that can be its anchor.
LENGTH, GRAM = 200, 32
#: Bytes of runs in a shard, and different runs of one anchor in a shard.
SHARD_BYTES, SHARD_RUNS = 1 << 20, 8192
#: Runs that are too common for one task have more than one in so many of all occurrences.
HEAVY = 2048
#: Ranges that each shard of a hot anchor is cut into, per shard.
RANGES = 4
#: Bytes whose anchors are found at a time; places fit the low bits of the sort key.
_PIECE, _PLACE = (1 << 20) - 4096, np.uint64((1 << 20) - 1)
_TABLE = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64)
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD],
    np.uint64,
)


def _body(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def gram_hashes(flat: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every place on."""
    out, width = _TABLE[flat], 1
    while width < GRAM:
        out = out[:-width] * _MIX[width.bit_length() - 1] + out[width:]
        width *= 2
    out ^= out >> np.uint64(32)
    out *= _MIX[-1]
    out ^= out >> np.uint64(29)
    return out


def anchors(bodies: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Of all runs of windows with one anchor: document, first and last window, two hashes.

    The windows of a document longer than a piece are taken piece by piece; a run that is cut there
    only has another hash of its bytes, so it is compared in a shard.
    """
    parts = []
    for i, body in enumerate(bodies):
        for start in range(0, max(0, len(body) - length + 1), _PIECE):
            parts.append((i, start, body[start : start + _PIECE + length - 1]))
    found: list[list[np.ndarray]] = []
    for a, b in slices([len(p[2]) for p in parts], _PIECE + length):
        some = parts[a:b]
        joined = b"".join(p[2] for p in some)
        flat = np.frombuffer(joined, np.uint8)
        hashes = gram_hashes(flat)
        keys = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)
        least, width, places = keys, 1, length - GRAM + 1
        while 2 * width <= places:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (places - width)], least[places - width :])
        sizes = np.array([len(p[2]) for p in some])
        ends = np.cumsum(sizes)
        inside = np.ones(len(flat), bool)
        for end in ends.tolist():
            inside[max(0, end - length + 1) : end] = False
        windows = np.flatnonzero(inside)
        anchor = (least[windows] & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(anchor)) - 1
        low, high, anchor = windows[first], windows[last], anchor[first]
        owner = np.searchsorted(ends, low, side="right")
        view = memoryview(joined)
        digest = xxhash.xxh3_64_intdigest
        runs = np.fromiter(
            (digest(view[x:y]) for x, y in zip(low.tolist(), (high + length).tolist(), strict=True)), np.uint64, len(low)
        )
        offset = np.array([p[1] for p in some])[owner] - (ends - sizes)[owner]
        document = np.array([p[0] for p in some])[owner]
        found.append([document, low + offset, high + offset, hashes[anchor].view(np.int64), runs.view(np.int64)])
    if not found:
        return [np.zeros(0, np.int64) for _ in range(5)]
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def suffix_order(words: np.ndarray, ends: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of several runs laid one after the other, and every suffix's rank.

    ``words`` are the 8 bytes from each place on, ``ends`` the end of its run and ``run`` its number.
    After a round suffixes are in order of their first h bytes, 8 at first; the next round orders
    only groups that are still equal, by the rank of the suffix h bytes on (Larsson and Sadakane).
    The end of a run is less than any byte, and different for every run.
    """
    n = len(words)
    order = np.argsort(words, kind="stable").astype(np.int32)
    new = np.diff(words[order], prepend=words[order[:1]] ^ np.uint64(1)) != 0
    # The rank of a group is the place of its first suffix.
    group = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    rank = np.empty(n, np.int32)
    rank[order] = group
    h, runs = 8, int(run.max()) + 1 if n else 0
    # What is still equal to a neighbour, by place: a group's suffixes are together.
    place = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
    suffix, group = order[place], group[place]
    left, of_run = (ends[suffix] - suffix).astype(np.int32), run[suffix].astype(np.int32)
    while len(place):
        least = (h + 1) * runs
        # Where a run has ended, a shorter rest comes first; words are filled up with zeros.
        after = left.astype(np.int64) * runs + of_run
        longer = np.flatnonzero(left > h)
        after[longer] = rank[suffix[longer] + h] + np.int64(least)
        key = group * np.int64(n + least) + after
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        suffix, left, of_run = suffix[turn], left[turn], of_run[turn]
        order[place] = suffix
        new = np.diff(key, prepend=key[0] - 1) != 0
        group = np.maximum.accumulate(np.where(new, place, 0))
        rank[suffix] = group
        still = ~(new & np.append(new[1:], True))
        place, suffix, group, left, of_run = (x[still] for x in (place, suffix, group, left, of_run))
        h *= 2
    return order, rank


def common_prefixes(
    words: np.ndarray,
    order: np.ndarray,
    rank: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    steps: np.ndarray,
    most: int,
) -> np.ndarray:
    """Common bytes, up to ``most``, of each suffix and the one before it in order, by its rank.

    Kasai's walk: the next suffix of a run has at most one byte less in common with its neighbour.
    All runs walk in step, ``steps`` places each; they compare eight bytes at a time.
    """
    out = np.zeros(len(order) + 1, np.int64)
    ends = np.repeat(starts + sizes, sizes)
    shared = np.zeros(len(starts), np.int64)
    by_steps = np.argsort(-steps, kind="stable")
    for offset in range(int(steps.max(initial=0))):
        walking = by_steps[: int(np.searchsorted(-steps[by_steps], -offset, side="left"))]
        here = starts[walking] + offset
        ranks = rank[here]
        there = order[np.maximum(ranks - 1, 0)]
        common = np.maximum(shared[walking] - 1, 0)
        room = np.minimum(np.minimum(ends[here] - here, ends[there] - there), most)
        common = np.minimum(common, room)
        common[ranks == 0] = 0
        going = np.flatnonzero((common < room) & (ranks > 0))
        while len(going):
            at = common[going]
            differ = words[here[going] + at] ^ words[there[going] + at]
            # The bits of the first one that differs; without the bit below it no rounding carries.
            bits = np.frexp((differ & ~(differ >> np.uint64(1))).astype(np.float64))[1]
            same = 8 - (bits + 7) // 8
            at = np.minimum(at + same, room[going])
            common[going] = at
            going = going[(same == 8) & (at < room[going])]
        shared[walking] = common
        out[ranks] = common
    return out


def repeated_windows(bodies: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per run, whether each of its windows starts at another place of these runs as well."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    flat = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
    n = int(sizes.sum())
    starts = np.cumsum(sizes) - sizes
    ends = np.repeat(starts + sizes, sizes)
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, 8)[:n]).view(">u8").ravel()
    # Bytes beyond the end of a run are zero.
    beyond = np.maximum(np.arange(n) + 8 - ends, 0).astype(np.uint64) * np.uint64(8)
    words = words.astype(np.uint64) >> beyond << beyond
    run = np.repeat(np.arange(len(bodies)), sizes)
    order, rank = suffix_order(words, ends, run)
    steps = np.maximum(sizes - length + 1, 0)
    common = common_prefixes(words, order, rank, starts, sizes, steps, length)
    return [
        (common[r] >= length) | (common[r + 1] >= length)
        for r in (rank[s : s + k] for s, k in zip(starts.tolist(), steps.tolist(), strict=True))
    ]


def _spans(flags: np.ndarray, low: int, length: int) -> list[tuple[int, int]]:
    """Byte spans of the flagged windows of a run that starts at ``low``."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return [(low + a, low + b - 1 + length) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


_SPAN = "id long, row long, first long, last long"
_FOUND = f"m1 long, m2 long, {_SPAN}, keys binary, ids binary, rows binary, places binary"


def _compare(length: int):
    """A shard: spans of its runs (``m2`` -1), spans within a kind of run that occurs more often (-2, with
    its anchor, its hash as ``id`` and its ``n`` as ``row``), and the window digests of a hot anchor's shard.
    """

    def each(group: pd.DataFrame) -> pd.DataFrame:
        # Rows that are alike give their runs once each.
        group = group.sort_values(["h", "c", "second"]).drop_duplicates(["h", "c", "second"])
        bodies = [bytes(b) for b in group["body"]]
        flags = repeated_windows(bodies, length)
        ids, rows, lows, alone = (group[x].to_numpy() for x in ("id", "row", "low", "n"))
        anchor, run, second = (group[x].to_numpy() for x in ("h", "c", "second"))
        out = []
        for i, flag in enumerate(flags):
            if alone[i] == 1:
                of_run = _spans(flag, int(lows[i]), length)
                out += [(0, -1, ids[i], rows[i], a, b, *[b""] * 4) for a, b in of_run]
            elif second[i] == 0:
                out += [(anchor[i], -2, run[i], alone[i], a, b, *[b""] * 4) for a, b in _spans(flag, 0, length)]
        ranges = int(group["ranges"].iloc[0])
        if ranges:
            out += _digests(int(group["h"].iloc[0]), bodies, flags, ids, rows, lows, alone, ranges, length)
        return pd.DataFrame(out, columns=[c.split()[0] for c in _FOUND.split(", ")])

    return each


def _digests(h: int, bodies, flags, ids, rows, lows, alone, ranges: int, length: int) -> list[tuple]:
    """Window digests in order, cut at bounds that do not depend on the shard.

    A window that is repeated in this shard, or stands for several runs, is settled; its digest
    goes along without a place, once.
    """
    digest = xxhash.xxh3_64_intdigest
    keys = np.concatenate([
        np.fromiter((digest(body[o : o + length]) for o in range(len(flag))), np.uint64, len(flag))
        for body, flag in zip(bodies, flags, strict=True)
    ])
    windows = np.array([len(f) for f in flags])
    owner = np.repeat(np.arange(len(bodies)), windows)
    places = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + lows[owner]
    settled = np.concatenate(flags) | (alone[owner] > 1)
    places = np.where(settled, -1, places)
    order = np.lexsort((settled, keys))
    keys, owner, places = keys[order], owner[order], places[order]
    once = np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0
    keys, owner, places = keys[once], owner[once], places[once]
    bounds = np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges)
    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    packed = [keys, *(x.astype(np.int64) for x in (ids[owner], rows[owner], places))]
    return [
        (h, r, 0, 0, 0, 0, *(x[a:b].tobytes() for x in packed))
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        if b > a
    ]


def _merge(length: int):
    """Of a hot anchor's range, the windows that several shards have."""

    def each(group: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "row", "first", "last"]
        parts = [np.frombuffer(x, np.uint64) for x in group["keys"]]
        merged = np.sort(np.concatenate(parts))
        out = []
        for part, ids, rows, places in zip(parts, group["ids"], group["rows"], group["places"], strict=True):
            place = np.frombuffer(places, np.int64)
            several = np.searchsorted(merged, part, "right") - np.searchsorted(merged, part, "left") > 1
            hit = several & (place >= 0)
            own = [np.frombuffer(x, np.int64)[hit] for x in (ids, rows, places, places)]
            out.append(pd.DataFrame(dict(zip(columns, own, strict=True))))
        found = pd.concat(out)
        return found.assign(last=found["last"] + length)

    return each


def _number(docs: DataFrame, doc_id: str) -> Column:
    """The id as a long; ids of other types go by their hash. The row's hash tells null from 0."""
    if isinstance(docs.schema[doc_id].dataType, IntegralType):
        return F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(0).cast("long"))
    return F.xxhash64(F.col(f"`{doc_id}`"))


def _with_row(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    """The documents with a hash of id and text; rows alike in both share it."""
    (row,) = fresh(docs, "row")
    return docs.withColumn(row, F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))), row


def _by_row(base: DataFrame, row: str, doc_id: str, other: DataFrame, how: str) -> DataFrame:
    """Documents joined with something per ``id`` and ``row``.

    Both joins of the documents are made here in one form, so that Spark can shuffle the texts once.
    """
    number, other_row = fresh(base, "__id", "__row")
    other = other.withColumnsRenamed({"id": number, "row": other_row})
    same_row = (_number(base, doc_id) == F.col(number)) & (F.col(row) == F.col(other_row))
    return base.join(other, same_row, how)


def _occurrences(keyed: DataFrame, length: int) -> DataFrame:
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, rows = batch["id"].to_numpy(), batch["row"].to_numpy()
            owner, low, high, h, c = anchors([_body(x) for x in batch["text"]], length)
            yield pd.DataFrame({"id": ids[owner], "row": rows[owner], "low": low, "high": high, "h": h, "c": c})

    return keyed.mapInPandas(each, "id long, row long, low long, high long, h long, c long")


_ITEM = ("g1", "g2", "ranges", "h", "c", "n", "second", "low")


def _bodies(length: int):
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {x: [] for x in (*_ITEM, "id", "row", "body")}
            for number, row, text, wanted in zip(batch["id"], batch["row"], batch["text"], batch["wanted"], strict=True):
                body = _body(text)
                for item in wanted:
                    for x in _ITEM:
                        out[x].append(item[x])
                    out["id"].append(number)
                    out["row"].append(row)
                    out["body"].append(body[item["low"] : item["high"] + length])
            yield pd.DataFrame(out)

    return each


def _everywhere(marked: DataFrame, decided: DataFrame) -> DataFrame:
    """The spans that a shard found in a kind of run, in all occurrences of that kind.

    A kind with more than one in ``HEAVY`` of all occurrences (``n`` 3) would fill a task. There are
    fewer than ``HEAVY`` of these, of bounded length, so they are sent to all occurrences; the others
    are joined by a shuffle.
    """
    key = ["h", "c"]
    place = ["id", "row", (F.col("low") + F.col("first")).alias("first"), (F.col("low") + F.col("last")).alias("last")]
    heavy = F.broadcast(decided.filter("n = 3"))
    light = marked.join(F.broadcast(decided.filter("n = 3").select(key)), key, "left_anti")
    return marked.join(heavy, key).select(place).union(light.join(decided.filter("n = 2"), key).select(place))


def spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, row, spans`` of each document with repeated bytes; spans may overlap, in no order."""
    if length < 2 * GRAM:
        raise ValueError(f"a window has at least {2 * GRAM} bytes")
    small_batches(docs.sparkSession)
    base, row = _with_row(docs, doc_id, text)
    keyed = base.select(
        _number(base, doc_id).alias("id"), F.col(row).alias("row"), F.col(f"`{text}`").alias("text")
    )
    found = written(_occurrences(keyed.filter(F.octet_length("text") >= length), length), "anchors")
    # Counts are written before they are joined: a join of two plain shuffles is one that adaptive
    # execution can split where an anchor or a run is very common.
    shared = found.groupBy("h").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("h")
    marked = written(found.join(written(shared, "anchor-counts"), "h"), "shared-anchors")
    place = F.struct("id", "row", "low", "high")
    kinds = marked.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("one"), F.max(place).alias("other")
    )
    kinds = written(kinds, "kinds-of-runs")
    per_anchor = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("runs"))
    crowded = written(per_anchor.filter(F.col("runs") > SHARD_RUNS), "hot-anchors")
    bodies_of = F.when(F.col("n") > 1, F.array("one", "other")).otherwise(F.array("one"))
    runs = kinds.select("h", "c", "n", F.posexplode(bodies_of).alias("second", "one"))
    runs = runs.select("h", "c", "n", "second", "one.*")
    size = runs.agg(F.sum(F.col("high") - F.col("low") + length)).first()[0] or 0
    often = F.when(F.col("n") * HEAVY > marked.count(), 3).otherwise(F.least("n", F.lit(2)))
    shards = max(1, -(-size // SHARD_BYTES))
    # An anchor with too many runs for a shard gets several of its own.
    cut = F.ceil(F.col("runs") / F.lit(SHARD_RUNS))
    hot = F.col("runs").isNotNull()
    wanted = runs.join(crowded, "h", "left").select(
        "id",
        "row",
        F.struct(
            F.when(hot, F.col("h")).otherwise(F.pmod("h", F.lit(shards))).alias("g1"),
            F.when(hot, F.pmod("c", cut) + 1).otherwise(F.lit(0)).alias("g2"),
            F.when(hot, cut * RANGES).otherwise(F.lit(0)).alias("ranges"),
            "h",
            "c",
            F.when(F.col("n") > 1, often).otherwise(F.lit(1)).alias("n"),
            "second",
            "low",
            "high",
        ).alias("item"),
    )
    wanted = wanted.groupBy("id", "row").agg(F.collect_list("item").alias("wanted"))
    read = _by_row(base, row, doc_id, wanted, "inner")
    read = read.select(
        _number(base, doc_id).alias("id"), F.col(row).alias("row"), F.col(f"`{text}`").alias("text"), "wanted"
    )
    bodies = read.mapInPandas(
        _bodies(length),
        f"{' long, '.join(_ITEM)} long, id long, row long, body binary",
    )
    compared = written(bodies.groupBy("g1", "g2").applyInPandas(_compare(length), _FOUND), "compared-runs")
    alone = compared.filter("m2 = -1").select("id", "row", "first", "last")
    several = compared.filter("m2 >= 0").groupBy("m1", "m2").applyInPandas(_merge(length), _SPAN)
    decided = compared.filter("m2 = -2").select(
        F.col("m1").alias("h"), F.col("id").alias("c"), F.col("row").alias("n"), "first", "last"
    )
    return (
        alone.union(several)
        .union(_everywhere(marked, decided))
        .groupBy("id", "row")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )


def _kept(text: str | None, spans) -> tuple[int, int, int, bytes]:
    body = _body(text)
    runs: list[list[int]] = []
    for first, last in sorted((x["first"], x["last"]) for x in (spans if spans is not None else ())):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    kept, at = [], 0
    for first, last in runs:
        kept.append(body[at:first])
        at = last
    kept.append(body[at:])
    left = b"".join(kept)
    return len(body), len(body) - len(left), len(runs), left


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes of each.

    ``n_spans`` counts maximal removed runs. Columns of these names are replaced.
    """
    found = spans(docs, doc_id=doc_id, text=text, length=length)

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def each(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, marks in batches:
            rows = [_kept(x, y) for x, y in zip(texts, marks, strict=True)]
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    plain = [c for c in docs.columns if c.lower() not in added]
    base, row = _with_row(docs, doc_id, text)
    marks, done = fresh(base, "spans", "done")
    found = found.withColumnRenamed("spans", marks)
    out = _by_row(base, row, doc_id, found, "left").withColumn(done, each(F.col(f"`{text}`"), F.col(marks)))
    return out.select(*[F.col(f"`{c}`") for c in plain], *[F.col(f"{done}.{c}").alias(c) for c in added])
