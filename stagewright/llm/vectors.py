"""What the two vector searches share: usable vectors, shards by place, and kd-trees with tight boxes."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewright.llm.common import small_batches, written

#: Most rows and bytes (of doubles) of a shard, and of the queries that one task takes through it.
SHARD_ROWS, SHARD_BYTES = 65536, 16 << 20
QUERY_ROWS, QUERY_BYTES = 16384, 8 << 20
#: Bytes of the rows that teach the first splits, and the rows of it that each place has at least.
#: The sample decides only where rows lie together; every row is in a shard.
SAMPLE_BYTES, PLACE_ROWS = 16 << 20, 16
#: Points of a kd-tree's leaf, and most leaves that one step in numpy takes.
LEAF, TOGETHER = 64, 64

def usable(vector: Column, *, zero: bool) -> Column:
    """Whether a vector takes part: all components finite, and unless ``zero`` not all of them 0."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
    )
    ok = F.coalesce((F.size(vector) > 0) & finite, F.lit(False))
    return ok if zero else ok & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


class Tree:
    """A kd-tree over rows: median splits of the widest side, and the tight box of every node."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        #: Per node: start and end in ``order``, children (0: a leaf), and the box.
        self.start, self.end, self.left, self.right = [0], [len(points)], [0], [0]
        low, high = [points.min(axis=0)], [points.max(axis=0)]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = self.start[node], self.end[node]
            sides = high[node] - low[node]
            widest = int(np.argmax(sides))
            if b - a <= leaf or sides[widest] == 0:
                continue
            rows, middle = self.order[a:b], (b - a) // 2
            self.order[a:b] = rows[np.argpartition(points[rows, widest], middle)]
            for children, x, y in ((self.left, a, a + middle), (self.right, a + middle, b)):
                children[node] = len(self.start)
                own = points[self.order[x:y]]
                low.append(own.min(axis=0))
                high.append(own.max(axis=0))
                self.start.append(x)
                self.end.append(y)
                self.left.append(0)
                self.right.append(0)
                todo.append(children[node])
        self.low, self.high = np.array(low), np.array(high)

    @classmethod
    def of_leaves(cls, starts: np.ndarray, rows: int, low: np.ndarray, high: np.ndarray) -> Tree:
        """The tree over rows that are in its order already, from its leaves' first rows and boxes."""
        tree = cls.__new__(cls)
        tree.order, bounds = np.arange(rows), [*starts.tolist(), rows]
        tree.start, tree.end, tree.left, tree.right = [0], [rows], [0], [0]
        lows, highs = [low.min(axis=0)], [high.max(axis=0)]
        todo = [(0, 0, len(starts))]
        while todo:
            node, a, b = todo.pop()
            if b - a == 1:
                continue
            middle = (a + b) // 2
            for children, x, y in ((tree.left, a, middle), (tree.right, middle, b)):
                children[node] = len(tree.start)
                lows.append(low[x:y].min(axis=0))
                highs.append(high[x:y].max(axis=0))
                tree.start.append(bounds[x])
                tree.end.append(bounds[y])
                tree.left.append(0)
                tree.right.append(0)
                todo.append((children[node], x, y))
        tree.low, tree.high = np.array(lows), np.array(highs)
        return tree

    def leaves(self) -> list[int]:
        """The leaves in the order of their rows."""
        return sorted((n for n in range(len(self.left)) if not self.left[n]), key=self.start.__getitem__)

    def nearest_first(self, bounds: list):
        """Leaves in order of their bounds, least first; a node's bound is at most its children's.

        Yields the bound and the rows of a leaf; the caller stops when no leaf can matter any more.
        """
        heap = [(bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if self.left[node]:
                heapq.heappush(heap, (bounds[self.left[node]], self.left[node]))
                heapq.heappush(heap, (bounds[self.right[node]], self.right[node]))
            else:
                yield bound, self.order[self.start[node] : self.end[node]]


def steps(leaves: Iterator[tuple[float, np.ndarray]], over: Callable[[float], bool]):
    """Leaves in growing steps, best first, until the next one is ``over``: their last bound, their rows."""
    some, wanted, last = [], 1, 0.0
    for bound, rows in leaves:
        if over(bound):
            break
        some.append(rows)
        last = bound
        if len(some) == wanted:
            yield last, np.concatenate(some)
            some, wanted = [], min(2 * wanted, TOGETHER)
    if some:
        yield last, np.concatenate(some)


class Splits:
    """The first median splits, learned from a sample: they say in which place a row lies."""

    def __init__(self, points: np.ndarray, places: int):
        #: Per node: the side it splits (-1: a place), the value, children, and the place's number.
        self.side, self.cut, self.left, self.right, self.place = [-1], [0.0], [0], [0], [0]
        self.places, todo = 0, [(0, np.arange(len(points)), places)]
        while todo:
            node, rows, wanted = todo.pop()
            own = points[rows]
            low, high = own.min(axis=0), own.max(axis=0)
            side = int(np.argmax(high - low))
            if wanted <= 1 or low[side] == high[side]:
                self.place[node], self.places = self.places, self.places + 1
                continue
            values = own[:, side]
            cut = np.partition(values, len(rows) * (wanted // 2) // wanted)[len(rows) * (wanted // 2) // wanted]
            if cut == low[side]:
                cut = values[values > cut].min()
            self.side[node], self.cut[node] = side, cut
            for children in (self.left, self.right):
                children[node] = len(self.side)
                self.side.append(-1)
                self.cut.append(0.0)
                self.left.append(0)
                self.right.append(0)
                self.place.append(0)
            # The left one is taken next, so that neighbouring places have neighbouring numbers.
            todo.append((self.right[node], rows[values >= cut], wanted - wanted // 2))
            todo.append((self.left[node], rows[values < cut], wanted // 2))

    def of(self, points: np.ndarray) -> np.ndarray:
        side, cut = np.array(self.side), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        node, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        while len(rows):
            rows = rows[side[node[rows]] >= 0]
            at = node[rows]
            node[rows] = np.where(points[rows, side[at]] < cut[at], left[at], right[at])
        return np.array(self.place)[node]


class Best:
    """The k highest scores so far, ties to the smaller id."""

    def __init__(self, k: int, kth: float | None):
        self.k, self.floor = k, kth
        self.scores: np.ndarray | None = None
        self.ids = np.zeros(0, np.int64)

    @property
    def kth(self) -> float | None:
        """A score that a new row must reach; None while any row helps."""
        own = self.scores[-1] if self.scores is not None and len(self.scores) == self.k else None
        if own is None or self.floor is None:
            return self.floor if own is None else own
        return max(own, self.floor)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.kth is not None:
            enough = scores >= self.kth
            scores, ids = scores[enough], ids[enough]
        if not len(ids):
            return
        if self.scores is not None:
            scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]


class Method(NamedTuple):
    """How a search goes through the shards."""

    #: The coordinates of vectors that the trees are over.
    points: Callable[[np.ndarray], np.ndarray]
    #: Whether each query may need a row of each box: queries (see ``asking``), low and high sides.
    reach: Callable[[pd.DataFrame, np.ndarray, np.ndarray], np.ndarray]
    #: (query, row, score) of a shard: its tree, its ids and vectors in tree order, the queries.
    find: Callable[[Tree, np.ndarray, np.ndarray, pd.DataFrame], list[tuple[int, int, float]]]
    leaf: int = LEAF


_SHARD = ["size", "place", "piece"]
_BLOCK = ["size", "block", "part"]


def _most(rows: int, size_bytes: int) -> Column:
    """How many vectors of ``size`` go together."""
    return F.greatest(F.lit(1), F.least(F.lit(rows), F.floor(F.lit(size_bytes) / (8 * F.col("size")))))


def _learn_splits(rows: DataFrame, method: Method) -> dict[int, Splits]:
    """Splits per length of vectors; lengths that the sample lacks have one place."""
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("vector"))).first()
    if not n or (n <= SHARD_ROWS and 8 * total <= SHARD_BYTES):
        return {}
    wanted = max(1, SAMPLE_BYTES * n // (8 * total))
    step = max(1, n // wanted)
    sample = rows.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(step)) == 0).select("vector")
    vectors = sample.limit(2 * wanted).toPandas()["vector"]
    sizes, out = vectors.map(len), {}
    for size in sorted(set(sizes)):
        own = vectors[sizes == size]
        shard = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * size)))
        places = min(-(-len(own) * n // (len(vectors) * shard)), max(1, len(own) // PLACE_ROWS))
        if places > 1:
            out[size] = Splits(method.points(matrix(own)), places)
    return out


def _placed(rows: DataFrame, splits: dict[int, Splits], method: Method) -> DataFrame:
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vector"].map(len).to_numpy(np.int64)
            place = np.zeros(len(batch), np.int64)
            for size in set(sizes.tolist()) & set(splits):
                own = np.flatnonzero(sizes == size)
                place[own] = splits[size].of(method.points(matrix(batch["vector"].iloc[own])))
            yield batch.assign(size=sizes, place=place)

    return rows.mapInPandas(each, "id long, vector array<double>, at long, size long, place long")


def _indexed(placed: DataFrame, method: Method) -> DataFrame:
    """The rows of every shard in the order of its tree; a leaf's first row has the leaf's box.

    A row ``at`` -1, which is no row of the table, has the box of the shard.
    """

    def each(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(method.points(matrix(own["vector"])), method.leaf)
        own = own.iloc[tree.order]
        low, high = [None] * len(own), [None] * len(own)
        for node in tree.leaves():
            low[tree.start[node]], high[tree.start[node]] = tree.low[node], tree.high[node]
        return pd.DataFrame({
            **{name: int(value) for name, value in zip(_SHARD, key, strict=True)},
            "at": np.arange(-1, len(own)),
            "id": np.concatenate(([0], own["id"].to_numpy())),
            "vector": [np.zeros(0), *own["vector"]],
            "low": [tree.low[0], *low],
            "high": [tree.high[0], *high],
        })

    fields = "size long, place long, piece long, at long, id long, vector array<double>, low array<double>, high array<double>"
    return placed.groupBy(*_SHARD).applyInPandas(each, fields)


def _anew(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as new ones, so that the frame can be grouped together with itself."""
    return df.select(*[F.col(c).alias(c) for c in columns])


def _boxes(index: DataFrame) -> DataFrame:
    """The box of every place: ``size, place, low, high``."""
    sides = index.filter("at = -1").select(
        "size", "place", F.posexplode(F.arrays_zip("low", "high")).alias("side", "box")
    )
    sides = sides.groupBy("size", "place", "side").agg(F.min("box.low").alias("low"), F.max("box.high").alias("high"))
    whole = sides.groupBy("size", "place").agg(F.sort_array(F.collect_list(F.struct("side", "low", "high"))).alias("box"))
    return whole.select("size", "place", F.col("box.low").alias("low"), F.col("box.high").alias("high"))


def _reached(asked: DataFrame, boxes: DataFrame, method: Method) -> DataFrame:
    """``id, to``: the places in which a query may find what its kth score does not rule out."""

    def each(wanted: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(wanted) or not len(own):
            return pd.DataFrame({"id": [], "to": []}, dtype=np.int64)
        query, box = np.nonzero(method.reach(wanted, matrix(own["low"]), matrix(own["high"])))
        return pd.DataFrame({"id": wanted["id"].to_numpy()[query], "to": own["place"].to_numpy()[box]})

    blocks = _anew(asked, _BLOCK).distinct()
    return (
        asked.groupBy(*_BLOCK)
        .cogroup(boxes.join(blocks, "size").groupBy(*_BLOCK))
        .applyInPandas(each, "id long, to long")
    )


def _visited(index: DataFrame, queries: DataFrame, keys: list[str], method: Method, score: str) -> DataFrame:
    def each(own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(own) and len(wanted):
            own = own.sort_values("at")
            first = own["low"].notna().to_numpy()
            tree = Tree.of_leaves(np.flatnonzero(first), len(own), matrix(own["low"][first]), matrix(own["high"][first]))
            out = method.find(tree, own["id"].to_numpy(), matrix(own["vector"]), wanted)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return (
        index.filter("at >= 0")
        .groupBy(*keys)
        .cogroup(queries.select("id", "vector", "kth", "known", *keys).groupBy(*keys))
        .applyInPandas(each, f"query_id long, vec_id long, score {score}")
    )


def search(
    table: DataFrame,
    k: int,
    every: int,
    method: Method,
    *,
    vec_id: str,
    vector: str,
    zero: bool,
    score: str,
    label: str,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all rows for each query.

    Queries are the rows whose id is divisible by ``every``, a stated set that is meant to meet all
    rows. Rows go to places by median splits that a bounded sample teaches; a place with more rows
    than a shard holds, such as that of a very common vector, has several shards. The rows of a
    shard are written in the order of its tree, with the boxes, once. Each query first visits a
    shard of its own place; the kth score it finds there goes along, and the query visits only the
    places whose box that score does not rule out. A task holds one shard and a block of queries
    from neighbouring places.

    Rows without an id and unusable vectors take no part. Rows alike are candidates one by one; an
    id with several rows asks once, with the least of its vectors, and none of its rows is a
    candidate of its own query. Vectors of different length do not meet.
    """
    small_batches(table.sparkSession)
    rows = table.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector"), zero=zero))
    splits = _learn_splits(rows, method)
    # Dealt by position within a place: rows that are alike in every column spread over its shards.
    placed = written(_placed(rows.withColumn("at", F.monotonically_increasing_id()), splits, method), label)
    pieces = F.ceil(F.count(F.lit(1)) / _most(SHARD_ROWS, SHARD_BYTES)).alias("pieces")
    counts = written(placed.groupBy("size", "place").agg(pieces), label)
    dealt = placed.join(counts, ["size", "place"]).withColumn("piece", F.pmod("at", "pieces"))
    index = written(_indexed(dealt, method), label)

    none = F.lit(0).cast(score)
    asked = placed.filter(F.col("id") % every == 0).groupBy("id")
    asked = asked.agg(F.min(F.struct("vector", "size", "place")).alias("own")).select("id", "own.*")
    asked = asked.join(counts, ["size", "place"]).withColumn("piece", F.pmod(F.xxhash64("id"), "pieces"))
    asked = written(asked.drop("pieces"), label)
    home = asked.withColumns({"kth": none, "known": F.lit(False)})
    first = written(_visited(index, home, _SHARD, method, score), label)
    found = first
    places, shards = counts.agg(F.count(F.lit(1)), F.sum("pieces")).first()
    if (shards or 0) > 1:
        kth = first.groupBy(F.col("query_id").alias("id")).agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")
        )
        # Without nulls, so that long scores stay whole numbers in pandas.
        known = asked.join(kth, "id", "left").withColumn("known", F.col("kth").isNotNull())
        known = known.withColumn("kth", F.coalesce("kth", none))
        near = max(1, QUERY_ROWS * places // max(1, asked.count()))
        known = known.withColumn("block", F.floor(F.col("place") / near))
        parts = F.ceil(F.count(F.lit(1)) / _most(QUERY_ROWS, QUERY_BYTES)).alias("parts")
        of_block = known.groupBy("size", "block").agg(parts)
        known = known.join(of_block, ["size", "block"]).withColumn(
            "part", F.pmod(F.shiftright(F.xxhash64("id"), 20), "parts")
        )
        known = written(known.drop("parts"), label)
        reached = _reached(known, written(_boxes(index), label), method)
        visits = reached.join(known, "id").join(
            counts.select("size", F.col("place").alias("to"), "pieces"), ["size", "to"]
        )
        visits = visits.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
        visits = visits.filter((F.col("to") != F.col("place")) | (F.col("shard") != F.col("piece")))
        visits = visits.drop("place", "piece").withColumnsRenamed({"to": "place", "shard": "piece"})
        visits = written(visits, label)
        keys = [*_SHARD, "block", "part"]
        copies = index.join(_anew(visits, keys).distinct(), _SHARD)
        found = first.union(_visited(copies, visits, keys, method, score))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def asking(wanted: pd.DataFrame) -> list[tuple[int, float | None]]:
    """The ids of the queries and the scores that they bring along."""
    return [
        (query, kth if known else None)
        for query, kth, known in zip(
            wanted["id"].tolist(), wanted["kth"].tolist(), wanted["known"].tolist(), strict=True
        )
    ]


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)
