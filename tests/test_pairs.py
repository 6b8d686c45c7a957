"""Pair work on more tiles than blocks, against all distances at once."""

import numpy as np
import pytest

from kinfold.functions.vectors import pair_distances
from kinfold.operators import merging, pairs, stability
from kinfold.operators.spanning import minimum_tree
from kinfold.operators.trees import merge_tree

N = 400


@pytest.fixture(scope="module")
def points():
    x = np.random.default_rng(3).normal(size=(N, 5))
    x[300:340] = x[:40]  # copies
    return x


@pytest.fixture(scope="module")
def table(spark, points):
    rows = [(i, [float(v) for v in p], i % 7) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "row_id bigint, features array<double>, cluster bigint").repartition(4).localCheckpoint()


def test_rows_are_sent_to_few_blocks(table, points):
    edges = pairs.tree_edges(table, block_rows=10).localCheckpoint()
    assert edges.count() < 5000  # 40 blocks of 10 rows leave 7,594
    dist, tree = pair_distances(points, points), minimum_tree(edges).collect()
    assert len(tree) == N - 1
    assert sum(r["w"] for r in tree) == pytest.approx(pairs._dense_tree(dist)[2].sum())


@pytest.mark.parametrize("k", [1, 3])
def test_neighbours_over_tiles(table, points, k):
    dist = pair_distances(points, points)
    np.fill_diagonal(dist, np.inf)
    got = {(r["row_id"], r["rank"]): r["distance"] for r in pairs.self_neighbours(table, k, block_rows=10).collect()}
    want = np.sort(dist, axis=1)[:, :k]
    assert len(got) == N * k
    assert all(got[i, j + 1] == pytest.approx(want[i, j], abs=1e-9) for i in range(N) for j in range(k))


def test_neighbours_at_one_distance_go_by_id(spark):
    df = spark.createDataFrame([(i, [0.0, 1.0]) for i in range(200)], "row_id bigint, features array<double>")
    got = {}
    for r in pairs.self_neighbours(df, 2, block_rows=5).collect():
        got.setdefault(r["row_id"], []).append(r["neighbour"])
    assert all(sorted(v) == [j for j in range(3) if j != i][:2] for i, v in got.items()) and len(got) == 200


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("within", [False, True])
def test_summary_over_tiles(table, points, metric, within):
    dist, cl = pair_distances(points, points, metric), np.arange(N) % 7
    i, j = np.triu_indices(N, 1)
    got = {(r[0], r[1]): r[2:] for r in pairs.pair_summary(table, metric=metric, within_only=within, block_rows=10).collect()}
    assert len(got) == (7 if within else 28)
    for (a, b), found in got.items():
        d = dist[i, j][(np.minimum(cl[i], cl[j]) == a) & (np.maximum(cl[i], cl[j]) == b)]
        assert found == pytest.approx((len(d), d.sum(), d.min(), d.max()), abs=1e-9)


def test_sums_and_cluster_distances_over_tiles(table, points):
    dist, cl = pair_distances(points, points), np.arange(N) % 7
    got = {(r["row_id"], r["other"]): r["total"] for r in pairs.cluster_distance_sums(table, block_rows=10).collect()}
    assert len(got) == N * 7
    assert all(t == pytest.approx(dist[i, cl == c].sum()) for (i, c), t in got.items())
    for name, fold in (("single", np.min), ("complete", np.max), ("average", np.mean)):
        far = {(r["a"], r["b"]): r["height"] for r in merging.cluster_distances(table, linkage=name, block_rows=10).collect()}
        assert len(far) == 21
        assert all(h == pytest.approx(fold(dist[np.ix_(cl == a, cl == b)]), abs=1e-9) for (a, b), h in far.items())


def test_shared_labels_over_tiles(spark, table, monkeypatch):
    labels = np.random.default_rng(1).integers(-1, 3, (N, 4))
    rows = [(i, [0.0], [None if v < 0 else int(v) for v in r]) for i, r in enumerate(labels)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, labels array<int>")
    monkeypatch.setattr(pairs, "FEW_BLOCKS", 3)
    i, j = np.triu_indices(N, 1)
    both = (labels[i] >= 0) & (labels[j] >= 0)
    co, drawn = ((labels[i] == labels[j]) & both).sum(1), both.sum(1)
    want = {(c, d): int(((co == c) & (drawn == d)).sum()) for c, d in set(zip(co.tolist(), drawn.tolist()))}
    assert {(r["co"], r["drawn"]): r["pairs"] for r in stability.co_association_counts(df).collect()} == want


def test_nearest_clusters_over_tiles(table, points):
    """Tiles hold whole clusters, and the best of all tiles is kept."""
    cl = np.arange(N) % 7
    dist = pair_distances(points, points)
    want = np.array([[dist[np.ix_(cl == a, cl == b)].mean() if a != b else np.inf for b in range(7)] for a in range(7)])
    near = merging._best(merging._meet(table, "average", "euclidean", N, 10, False)).collect()
    assert {r["cluster"]: r["near"] for r in near} == dict(enumerate(want.argmin(1).tolist()))
    assert all(r["height"] == pytest.approx(want.min(1)[r["cluster"]]) for r in near)


def test_manhattan_strips_change_nothing():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(70, 9)), rng.normal(size=(1100, 9))
    assert pair_distances(a, b, "manhattan") == pytest.approx(np.abs(a[:, None] - b[None]).sum(2))
    assert pair_distances(a[:0], b, "manhattan").shape == (0, 1100)
