"""Approximate nearest neighbours by cosine over low-dimensional stable projections.

Vectors are brought to length one, where the order by distance is the order by cosine, and projected
by a few Gaussian directions, which are 2-stable: the squared projected distance over the squared
distance is chi-square with as many degrees of freedom. A kd-tree holds the projections of a shard.
Projected neighbours come in order of their distance and are verified on the whole vectors; a query
stops once the next projected distance is so large that a row nearer than its kth neighbour would
have been seen with probability ``SURE``. The same test on the boxes of places rules out whole shards
before any of their rows is sent. There is no other cap on how many rows are verified.

See ``vectors.search`` for nulls, repeated rows and which rows ask.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from stagewright.llm.vectors import Best, Method, Tree, asking, matrix, search, steps

TOP, EVERY = 5, 50
#: Projections (even, for the closed form below), and the chance that a nearer row was seen.
PROJECTIONS, SURE, SEED = 12, 0.98, 42
#: Points of a leaf: a leaf is one step in numpy, so it is larger than a tree alone would ask for.
LEAF = 256
#: Squared projected distance that only copies of a vector are within.
COPY = 1e-12


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < p else (low, middle)
    return high


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors scaled, so that no square leaves the range of doubles, and their lengths."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


def _projector(projections: int, seed: int):
    def project(vectors: np.ndarray) -> np.ndarray:
        scaled, lengths = _unit(vectors)
        directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        return (scaled / lengths[:, None]) @ directions

    return project


def _far(distance, kth: float, limit: float):
    """Whether no row at this squared projected distance or beyond needs to be seen.

    Copies of the query have a distance of 0 up to rounding, so a kth score of 1 stops as well.
    """
    return distance >= max(limit * (2 - 2 * kth), COPY)


def _gaps(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    away = np.maximum(np.maximum(low - point, point - high), 0)
    return (away * away).sum(axis=1)


def may_reach(limit: float, project):
    def reach(wanted: pd.DataFrame, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.ones((len(wanted), len(low)), bool)
        at = project(matrix(wanted["vector"]))
        for row, (_, kth) in enumerate(asking(wanted)):
            if kth is not None:
                out[row] = ~_far(_gaps(at[row], low, high), kth, limit)
        return out

    return reach


def find_in_shard(k: int, limit: float, project):
    def find(tree: Tree, ids: np.ndarray, vectors: np.ndarray, wanted: pd.DataFrame) -> list[tuple[int, int, float]]:
        asked = matrix(wanted["vector"])
        low, at = project(vectors), project(asked)
        rows, norms = _unit(vectors)
        asked, lengths = _unit(asked)
        out = []
        for row, (query, kth) in enumerate(asking(wanted)):
            point = at[row]
            best = Best(k, kth)

            def over(distance: float, best: Best = best) -> bool:
                return best.kth is not None and bool(_far(distance, best.kth, limit))

            def verify(which: np.ndarray, row: int = row, best: Best = best) -> None:
                scores = (rows[which] * asked[row]).sum(axis=1) / (norms[which] * lengths[row])
                best.add(scores, ids[which])

            waiting, distances = np.zeros(0, np.int64), np.zeros(0)
            for bound, leaf in steps(tree.nearest_first(_gaps(point, tree.low, tree.high).tolist()), over):
                leaf = leaf[ids[leaf] != query]
                gap = low[leaf] - point
                waiting = np.concatenate((waiting, leaf))
                distances = np.concatenate((distances, (gap * gap).sum(axis=1)))
                # What waits below the last bound is next in projected order.
                ready = distances <= bound
                verify(waiting[ready])
                waiting, distances = waiting[~ready], distances[~ready]
            if best.kth is not None:
                waiting = waiting[~_far(distances, best.kth, limit)]
            verify(waiting)
            if best.scores is not None:
                out += [(query, int(i), float(s)) for i, s in zip(best.ids, best.scores, strict=True)]
        return out

    return find


def nearest(
    table: DataFrame,
    *,
    k: int = TOP,
    every: int = EVERY,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    projections: int = PROJECTIONS,
    sure: float = SURE,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k nearest found by cosine."""
    if projections < 2 or projections % 2:
        raise ValueError("the number of projections is even")
    limit, project = quantile(sure, projections), _projector(projections, seed)
    return search(
        table,
        k,
        every,
        Method(project, may_reach(limit, project), find_in_shard(k, limit, project), LEAF),
        vec_id=vec_id,
        vector=vector,
        zero=False,
        score="double",
        label="projected-shards",
    )
