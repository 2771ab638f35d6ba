"""Exact top-k search by integer inner product with kd-trees.

Components become floor(256 x). Every shard has a kd-tree with median splits and tight boxes. A
box bounds the product of any row in it with the query: each component of the query meets the upper
side of the box where it is positive and the lower side where it is negative. Leaves are visited
best bound first, until the next bound is below the kth score that the query has found here or
brought along from the shard it visited first; an equal bound is still visited, for the ties. Whole
shards are ruled out by the box of their place in the same way, before any of their rows is sent.

See ``vectors.search`` for nulls, repeated rows and which rows ask. Sums too large for exact
doubles are taken in whole numbers, and scores beyond a long are cut to its range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from stagewright.llm.vectors import Best, Method, Tree, asking, matrix, search, steps

SCALE = 256
TOP, EVERY = 5, 50
_LONG = 2**63 - 1


def quantized(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers; what leaves the range of doubles counts as the largest one."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(SCALE * vectors))


def _whole(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], dtype=object)


def _exact(points: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Numbers whose products doubles hold exactly, or whole numbers of any size."""
    most = max(float(np.abs(x).max(initial=0)) for x in others)
    if float(np.abs(points).max(initial=0)) * most * points.shape[1] >= 2.0**53:
        return tuple(_whole(x) for x in (points, *others))
    return (points, *others)


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def reach(wanted: pd.DataFrame, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    queries, low, high = _exact(quantized(matrix(wanted["vector"])), low, high)
    out = np.zeros((len(queries), len(low)), bool)
    for row, (_, kth) in enumerate(asking(wanted)):
        # A score that was cut to the range of a long rules nothing out.
        known = kth is not None and kth > -_LONG
        out[row] = _bounds(queries[row : row + 1], low, high)[0] >= kth if known else True
    return out


def find_in_shard(k: int):
    def find(tree: Tree, ids: np.ndarray, vectors: np.ndarray, wanted: pd.DataFrame) -> list[tuple[int, int, int]]:
        queries = quantized(matrix(wanted["vector"]))
        queries, points, low, high = _exact(queries, quantized(vectors), tree.low, tree.high)
        out = []
        for row, (query, kth) in enumerate(asking(wanted)):
            best = Best(k, kth if kth is None or kth > -_LONG else None)
            # Negated, so that the best bound is the least one.
            bounds = -_bounds(queries[row : row + 1], low, high)[0]

            def over(bound: float, best: Best = best) -> bool:
                return best.kth is not None and -bound < best.kth

            for _, leaf in steps(tree.nearest_first(bounds.tolist()), over):
                leaf = leaf[ids[leaf] != query]
                best.add(points[leaf] @ queries[row], ids[leaf])
            if best.scores is not None:
                out += [
                    (query, int(i), max(-_LONG, min(_LONG, int(s))))
                    for i, s in zip(best.ids, best.scores, strict=True)
                ]
        return out

    return find


def top_k(
    table: DataFrame,
    *,
    k: int = TOP,
    every: int = EVERY,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k highest integer inner products."""
    method = Method(quantized, reach, find_in_shard(k))
    return search(table, k, every, method, vec_id=vec_id, vector=vector, zero=True, score="long", label="kd-shards")
