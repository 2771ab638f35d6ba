"""Shards by place: where rows go, what is spared, and that nothing is lost by it."""

import numpy as np
import pytest

from stagewright.llm import kdsearch, projected
from stagewright.llm import vectors as shared


def clustered(n: int, size: int, centers: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centers, size))
    return middle[rng.integers(0, centers, n)] + 0.02 * rng.standard_normal((n, size))


def table_of(spark, points):
    some = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(3)


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(shared, "SHARD_ROWS", 64)
    monkeypatch.setattr(shared, "QUERY_ROWS", 5)


def plain(points, k, every, score):
    out = set()
    for q in range(0, len(points), every):
        scores = score(points, points[q])
        order = sorted((i for i in range(len(points)) if i != q), key=lambda i: (-scores[i], i))[:k]
        out |= {(q, r + 1, i, scores[i]) for r, i in enumerate(order)}
    return out


def test_exact_search_on_clusters_equals_a_plain_scan(spark, small_shards):
    points = clustered(900, 8, 12)
    got = {tuple(r) for r in kdsearch.top_k(table_of(spark, points), every=7).collect()}
    whole = np.floor(256 * points).astype(np.int64)
    assert got == plain(whole, 5, 7, lambda x, q: [int(v) for v in x @ q])


def test_nearest_on_clusters_finds_nearly_all(spark, small_shards):
    points = clustered(900, 24, 12)
    got = {(r.query_id, r.vec_id) for r in projected.nearest(table_of(spark, points), every=7).collect()}
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    want = {(q, i) for q, _, i, _ in plain(unit, 5, 7, lambda x, q: (x @ q).tolist())}
    assert len(got & want) >= 0.9 * len(want)
    assert len(got) == len(want)


@pytest.mark.parametrize("find", [kdsearch.top_k, projected.nearest])
def test_a_vector_that_a_third_of_the_rows_share(spark, small_shards, find):
    points = clustered(600, 6, 5)
    points[::3] = points[0]
    got = find(table_of(spark, points), every=50).filter("query_id = 150").orderBy("rank").collect()
    if find is projected.nearest:
        assert [r.vec_id for r in got] == [0, 3, 6, 9, 12]
    assert len(got) == 5


def test_vectors_of_several_lengths_meet_their_own_length_only(spark, small_shards):
    points = [p[: 4 + i % 2] for i, p in enumerate(clustered(500, 5, 9))]
    for find in (kdsearch.top_k, projected.nearest):
        got = find(table_of(spark, points), every=10).collect()
        assert len(got) == 5 * 50
        assert all(r.query_id % 2 == r.vec_id % 2 for r in got)


def test_values_at_the_end_of_the_range_do_not_fail(spark):
    got = kdsearch.top_k(table_of(spark, [[1e308, -1e308], [1e308, 1.0], [1.0, 1.0]])).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)][0] == 1


def test_splits_are_even_and_send_equal_points_together():
    points = clustered(4000, 6, 30)
    splits = shared.Splits(points, 16)
    sizes = np.bincount(splits.of(points))
    assert len(sizes) == splits.places == 16
    assert sizes.max() <= 1.1 * 250
    assert len(set(splits.of(np.repeat(points[:1], 50, axis=0)).tolist())) == 1
    same = shared.Splits(np.ones((50, 3)), 8)
    assert same.places == 1
    halves = shared.Splits(np.repeat([[0.0], [1.0]], [49, 1], axis=0), 8)
    assert halves.places == 2


def test_a_tree_of_written_leaves_has_the_same_rows_and_boxes():
    points = clustered(1000, 4, 10)
    tree = shared.Tree(points, 32)
    leaves = tree.leaves()
    starts = np.array([tree.start[n] for n in leaves])
    again = shared.Tree.of_leaves(starts, 1000, tree.low[leaves], tree.high[leaves])
    ordered = points[tree.order]
    for node in range(len(again.left)):
        own = ordered[again.start[node] : again.end[node]]
        assert (own.min(axis=0) == again.low[node]).all()
        assert (own.max(axis=0) == again.high[node]).all()
    seen = np.concatenate([rows for _, rows in again.nearest_first([0.0] * len(again.left))])
    assert sorted(seen.tolist()) == list(range(1000))


def test_boxes_spare_most_places_of_clustered_vectors(spark, small_shards):
    """A query of a cluster is not sent to the places of the other clusters."""
    points = clustered(1600, 8, 25)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    limit, project = projected.quantile(0.98, 12), projected._projector(12, 42)
    low = project(points)
    splits = shared.Splits(low, 25)
    place = splits.of(low)
    boxes = [(low[place == p].min(axis=0), low[place == p].max(axis=0)) for p in range(25)]
    import pandas as pd

    kth = [float(np.sort(unit @ unit[q])[-6]) for q in range(50)]
    wanted = pd.DataFrame({"id": range(50), "vector": list(points[:50]), "kth": kth, "known": True})
    reached = projected.may_reach(limit, project)(wanted, *(np.array(x) for x in zip(*boxes, strict=True)))
    assert reached[np.arange(50), place[:50]].all()
    assert reached.mean() < 0.25
