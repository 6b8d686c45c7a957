import numpy as np
import pytest
from conftest import frame

from kinfold.functions.vectors import pair_distances
from kinfold.operators import pairs, sorted_pairs


def _want(x, cl, within=False, between=False):
    d = np.abs(x[:, None] - x[None]).sum(2)
    out = {}
    for a in np.unique(cl):
        for b in np.unique(cl[cl >= a]):
            part = d[np.ix_(cl == a, cl == b)]
            part = part[np.triu_indices(len(part), 1)] if a == b else part.ravel()
            if len(part) and not (within and a != b) and not (between and a == b):
                out[int(a), int(b)] = (len(part), part.sum())
    return out


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_totals_from_sorted_columns_are_those_of_all_pairs(spark, monkeypatch):
    """Buckets, common values, a column of one value, a cluster of one row, and values without a place."""
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 3, (240, 5))
    x[:, 1], x[:, 2] = 7.0, rng.integers(0, 3, 240)
    x[rng.random(240) < 0.4, 3] = 1e6
    cl = rng.integers(0, 4, 240)
    cl[17] = 9
    odd = x.copy()
    odd[cl == 0, 4][0:1] = np.nan
    odd[np.flatnonzero(cl == 1)[0], 0] = np.inf
    odd[np.flatnonzero(cl == 2)[:2], 0] = -np.inf
    odd[np.flatnonzero(cl == 3)[0], 2] = np.nan
    for size, pending, held in ((1 << 16, 1 << 22, 1 << 20), (20, 50, 7)):
        monkeypatch.setattr(sorted_pairs, "BUCKET_VALUES", size)
        monkeypatch.setattr(sorted_pairs, "_PENDING_CELLS", pending)
        monkeypatch.setattr(sorted_pairs, "_HELD", held)
        for rows, only in ((x, {}), (x, {"within_only": True}), (odd, {}), (odd, {"between_only": True})):
            got = pairs.pair_summary(frame(spark, rows, cluster=cl), metric="manhattan", extremes=False, **only)
            got = {(r["cluster_a"], r["cluster_b"]): (r["pairs"], r["total"]) for r in got.collect()}
            want = _want(rows, cl, "within_only" in only, "between_only" in only)
            assert got.keys() == want.keys()
            assert all(got[k] == pytest.approx(want[k], rel=1e-9, nan_ok=True) for k in want)


def test_manhattan_totals_look_at_no_pair(spark, monkeypatch):
    """All pairs were held one block against another, which took the square of the rows."""
    x, cl = np.random.default_rng(1).normal(size=(50, 3)), np.arange(50) % 3
    monkeypatch.setattr(pairs, "block_map", None)
    got = pairs.pair_summary(frame(spark, x, cluster=cl), metric="manhattan", extremes=False).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in got} == {k: pytest.approx(v) for k, v in _want(x, cl).items()}


def test_too_many_clusters_meet_pair_by_pair(spark, monkeypatch):
    x, cl = np.random.default_rng(2).normal(size=(40, 2)), np.arange(40) % 5
    monkeypatch.setattr(sorted_pairs, "MOST_CELLS", 10)
    d = pair_distances(x, x, "euclidean")
    for metric, want in (("manhattan", _want(x, cl)), ("euclidean", {(0, 0): (28, d[np.ix_(cl == 0, cl == 0)].sum() / 2)})):
        got = pairs.pair_summary(frame(spark, x, cluster=cl), metric=metric, extremes=False).collect()
        got = {(r[0], r[1]): tuple(r[2:]) for r in got}
        assert len(got) == 15 and all(got[k] == pytest.approx(v) for k, v in want.items())
