import numpy as np
import pyarrow as pa
import pytest
from conftest import blobs, frame
from pyspark.sql import functions as F

from kinfold.functions.vectors import pair_distances
from kinfold.operators import density, pairs, spanning


def _weights(x, k):
    d = pair_distances(x, x)
    core = np.sort(d, axis=1)[:, k]
    return np.maximum(d, np.maximum.outer(core, core))


@pytest.mark.parametrize("shape", ["blobs", "copies"])
def test_edges_within_reach_hold_the_tree(spark, shape):
    """Few of all pairs are looked at for the tree once neighbours are known, and its weight is that of all pairs."""
    x = blobs(150, 6, 5)[0] if shape == "blobs" else np.repeat(np.random.default_rng(0).integers(0, 4, (25, 3)).astype(float), 6, axis=0)
    df = frame(spark, x)
    near = pairs.self_neighbours(df, 4, block_rows=20).localCheckpoint()
    core = near.groupBy("row_id").agg(F.max("distance").alias("core")).localCheckpoint()
    cored = df.join(core, "row_id").localCheckpoint()
    spans = spanning.reached(cored, density._neighbour_edges(near, core), len(x), metric="euclidean")
    found = pairs.tree_edges(cored.join(spans, "row_id"), core=True, reach=True, n=len(x), block_rows=20).localCheckpoint()
    tree = spanning.minimum_tree(found).where("u <> v").collect()
    assert len(tree) == len(x) - 1
    assert sum(r["w"] for r in tree) == pytest.approx(pairs._dense_tree(_weights(x, 4))[2].sum())
    if shape == "blobs":
        assert spans.select("part").distinct().count() == 1 and found.count() < 12 * len(x)


def test_every_edge_of_the_tree_is_within_reach(monkeypatch):
    monkeypatch.setattr(pairs, "_REACHED", 400)
    x = blobs(400, 5, 4, seed=3)[0]
    w = _weights(x, 3)
    u, v, heavy = pairs._dense_tree(w)
    part, off = spanning._off(u, v, heavy * np.where(np.arange(len(u)) % 50, 1.0, 1.7), len(x))  # a tree that is not the lightest
    sides = [np.arange(0, 200), np.arange(200, 400)]
    blocks = [
        pairs.Block(pa.table({"row_id": pa.array(s), "features": pa.array(x[s].tolist()), "part": pa.array(part[s]), "off": pa.array(off[s])})) for s in sides
    ]
    d, core = pair_distances(x, x), np.sort(pair_distances(x, x), axis=1)[:, 3]
    for a, b in ((0, 0), (0, 1), (1, 1)):
        i, j, got = pairs._within_reach(blocks[a], blocks[b], d[np.ix_(sides[a], sides[b])], (core[sides[a]], core[sides[b]]), a == b)
        kept = {frozenset((int(sides[a][p]), int(sides[b][q]))): g for p, q, g in zip(i, j, got)}
        mine = {frozenset((int(p), int(q))): g for p, q, g in zip(u, v, heavy) if {p // 200, q // 200} == {a, b}}
        assert all(kept[e] == pytest.approx(g) for e, g in mine.items()) and len(kept) < d[np.ix_(sides[a], sides[b])].size / 2


def test_tree_between_two_tiles():
    rng = np.random.default_rng(2)
    for p, q in ((1, 1), (1, 9), (13, 7)):
        d = rng.integers(0, 6, (p, q)).astype(float)
        whole = np.full((p + q, p + q), np.inf)
        whole[:p, p:], whole[p:, :p] = d, d.T
        i, j, w = pairs._cross_tree(d)
        assert len(w) == p + q - 1 and w.sum() == pairs._dense_tree(whole)[2].sum() and (d[i, j] == w).all()
    d[0], d[:, 2] = np.nan, np.nan
    assert len(pairs._cross_tree(d)[2]) == 12 + 6 - 1
