"""K-means for many (k, seed) runs at once: every Lloyd step is one pass that serves all runs."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import poisson_weights, u01
from ..functions.vectors import batches_of, list_array, matrix, total_vectors, values
from ..session import TooLarge, check_broadcast, is_kept, kept
from .geometry import count_rows, nearest_rows, rows_of

# Rows that a seeding pass draws: at least this many, and so many for each centre. The passes go over all rows.
DRAWN_ROWS = 64
DRAWN_PER_CENTER = 8
SEED_PASSES = 4
_TINY = float(np.finfo(float).tiny)


@dataclass
class KMeansFit:
    k: int
    seed: int
    centers: np.ndarray
    inertia: float = math.nan
    sizes: np.ndarray | None = None
    n_iter: int = 0

    def labels(self, df: DataFrame, *keep: str, features: str = "features", out: str = "cluster") -> DataFrame:
        return labels_from_centers(df, self.centers, *keep, features=features, out=out)


@dataclass
class Run:
    """One Lloyd run: its centers, and bootstrap weights if it sees a resample of the rows."""

    centers: np.ndarray
    rate: float | None = None
    weight_seed: int = 0
    done: bool = False
    inertia: float = math.nan
    sizes: np.ndarray | None = field(default=None)
    n_iter: int = 0


def labels_from_centers(df: DataFrame, centers: np.ndarray, *keep: str, features: str = "features", out: str = "cluster") -> DataFrame:
    check_broadcast(centers.size, "centers")

    @F.arrow_udf("int")
    def near(feats: pa.Array) -> pa.Array:
        return pa.array(nearest_rows(rows_of(feats), centers)[0].astype(np.int32))

    return df.select(*(keep or ("row_id",)), near(features).alias(out))


def label_array(df: DataFrame, fits: list[KMeansFit], *keep: str) -> DataFrame:
    """``(row_id, labels array<int>)``: every run's label of a row, from one scan."""
    centers = [f.centers for f in fits]
    check_broadcast(sum(c.size for c in centers), "centers")

    @F.arrow_udf("array<int>")
    def near(feats: pa.Array) -> pa.Array:
        x = rows_of(feats)
        cols = np.column_stack([nearest_rows(x, c)[0] for c in centers]).astype(np.int32)
        offsets = pa.array(np.arange(0, cols.size + 1, cols.shape[1], dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(cols.ravel()))

    return df.select(*(keep or ("row_id",)), near("features").alias("labels"))


def _step(df: DataFrame, runs: dict[int, Run]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per run: summed rows, (weighted) sizes per centre and inertia, from one pass."""
    live = {i: (r.centers, r.rate, r.weight_seed) for i, r in runs.items()}
    check_broadcast(sum(c.size for c, _, _ in live.values()), "centers")
    weighted = any(rate is not None for _, rate, _ in live.values())

    def kernel(batches):
        acc = {i: np.zeros((len(c), c.shape[1] + 2)) for i, (c, _, _) in live.items()}
        stacked = np.concatenate([c for c, _, _ in live.values()])
        half = 0.5 * (stacked * stacked).sum(1)
        step = max(1, 2_000_000 // len(stacked))
        for batch in batches_of(batches):
            x_all = matrix(batch)
            ids = values(batch, "row_id") if weighted else None
            for at in range(0, len(x_all), step):
                x = x_all[at : at + step]
                score = half[:, None] - stacked @ x.T  # one row per centre keeps the scans contiguous
                norm = (x * x).sum(1)
                lo = 0
                for i, (c, rate, wseed) in live.items():
                    part = score[lo : lo + len(c)]
                    lo += len(c)
                    near = part.argmin(axis=0)
                    sq = np.maximum(norm + 2.0 * part[near, np.arange(len(x))], 0.0)
                    member = (near[None, :] == np.arange(len(c))[:, None]).astype(np.float64)
                    if rate is not None:
                        w = poisson_weights(ids[at : at + step], rate, wseed)
                        member *= w
                        sq = sq * w
                    acc[i][:, 0] += member.sum(1)
                    acc[i][:, 1] += np.bincount(near, sq, len(c))
                    acc[i][:, 2:] += member @ x
        for i, a in acc.items():
            yield i, a.ravel()

    cells = sum(len(c) * (c.shape[1] + 2) for c, _, _ in live.values())
    found = total_vectors(df, kernel, ["run"], cells=cells)
    out = {}
    for i, r in runs.items():
        a = found[(i,)].reshape(len(r.centers), -1)
        out[i] = (a[:, 2:], a[:, 0], float(a[:, 1].sum()))
    return out


def lloyd(df: DataFrame, runs: dict[int, Run], *, max_iter: int = 100, tol: float = 0.0, fixed: bool = False) -> dict[int, Run]:
    """Iterate all runs together until each has settled; an empty cluster keeps its centre.

    A run has settled when its centres move by at most ``tol`` in summed squares. ``fixed`` runs
    exactly ``max_iter`` updates. Inertia and sizes belong to the final centres.
    Only centres and sums reach the driver, so the lineage does not grow with the iterations.
    """
    for it in range(max_iter + 1):
        live = {i: r for i, r in runs.items() if not r.done}
        if not live:
            break
        for i, (sums, sizes, inertia) in _step(df, live).items():
            r = runs[i]
            r.inertia, r.sizes = inertia, sizes
            if it == max_iter:
                r.done = True
                continue
            new = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, _TINY)[:, None], r.centers)
            shift = float(((new - r.centers) ** 2).sum())
            if not fixed and shift <= tol:
                r.done = True  # the sums just taken belong to centres that no longer move
                continue
            r.centers, r.n_iter = new, it + 1
    return runs


def lowest_rows(df: DataFrame, k: int, seed: int = 0, tag: str = "init") -> np.ndarray:
    """The k rows with the lowest hash, in hash order: a start any engine can reproduce."""
    rows = df.select("features", u01("row_id", tag, seed).alias("u"), "row_id").orderBy("u", "row_id").limit(k).collect()
    return np.array([r["features"] for r in rows], dtype=float)


def _draw(df: DataFrame, centers: np.ndarray | None, size: int, tag: str, seed: int) -> np.ndarray:
    """``size`` rows drawn without replacement by their squared distance to the centres, evenly without any.

    Rows with the smallest exponential of that rate win, so a pass needs no total beforehand, and a task passes
    on no more rows than are drawn. The draw depends on row ids, not on partitions.
    """

    def kernel(batches):
        best, kept_x = np.empty(0), None
        for batch in batches_of(batches):
            x, u = matrix(batch), values(batch, "u")
            rate = np.ones(len(x)) if centers is None else nearest_rows(x, centers)[1] ** 2
            with np.errstate(divide="ignore", invalid="ignore"):
                key = np.where(rate > 0, -np.log1p(-u) / rate, np.inf)
            key, x = np.r_[best, key], x if kept_x is None else np.concatenate([kept_x, x])
            first = np.argpartition(key, size - 1)[:size] if len(key) > size else np.arange(len(key))
            best, kept_x = key[first], x[first]
        if kept_x is not None:
            some = np.isfinite(best)
            yield pa.RecordBatch.from_arrays([pa.array(best[some]), list_array(kept_x[some])], names=["key", "features"])

    drawn = df.select("features", u01("row_id", tag, seed).alias("u")).mapInArrow(kernel, "key double, features array<double>")
    rows = drawn.orderBy("key").limit(size).toArrow()
    flat = rows.column("features").combine_chunks()
    return flat.flatten().to_numpy().astype(float).reshape(rows.num_rows, -1) if rows.num_rows else np.empty((0, 0))


def seeding_rows(df: DataFrame, size: int, *, seed: int = 0, passes: int = SEED_PASSES) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, weights)``: rows drawn from the whole table in a few passes, and how many rows are nearest to each.

    The first pass draws evenly, each further one by squared distance to what was drawn before, so that a small
    group far from the rest is drawn from however few its rows are (k-means||, Bahmani et al. 2012).
    """
    found = _draw(df, None, size, "seed-0", seed)
    check_broadcast(found.size * passes, "seeding rows")
    for i in range(1, passes):
        more = _draw(df, found, size, f"seed-{i}", seed)
        if not len(more):  # every row is a copy of one drawn already
            break
        found = np.concatenate([found, more])
    return found, _step(df, {0: Run(found)})[0][1]


def plus_plus(pool: np.ndarray, k: int, rng: np.random.Generator, weights: np.ndarray | None = None) -> np.ndarray:
    """Spread-out starting centres from bounded weighted rows, by squared-distance sampling."""
    w = np.ones(len(pool)) if weights is None else weights
    centers = [pool[rng.choice(len(pool), p=w / w.sum())]]
    near = ((pool - centers[0]) ** 2).sum(1)
    for _ in range(1, k):
        share = near * w
        total = share.sum()
        pick = rng.choice(len(pool), p=share / total) if total > 0 else rng.integers(len(pool))
        centers.append(pool[pick])
        near = np.minimum(near, ((pool - pool[pick]) ** 2).sum(1))
    return np.array(centers)


def _settle(pool: np.ndarray, weights: np.ndarray, centers: np.ndarray, rounds: int = 15) -> np.ndarray:
    """Improve starting centres on bounded weighted rows."""
    inertia = np.inf
    for _ in range(rounds):
        near, dist = nearest_rows(pool, centers)
        member = (near[None, :] == np.arange(len(centers))[:, None]) * weights
        n = member.sum(1)
        centers = np.where(n[:, None] > 0, member @ pool / np.maximum(n, _TINY)[:, None], centers)
        last, inertia = inertia, float((weights * dist**2).sum())
        if last - inertia <= 1e-3 * max(inertia, _TINY):
            break
    return centers


def fit_many(
    df: DataFrame, wanted: list[tuple[int, int]], *, n_init: int = 10, full_starts: int = 2, max_iter: int = 100, tol: float = 1e-4,
    resamples: dict[int, tuple[float, int]] | None = None,
) -> list[KMeansFit]:
    """Best fit for every (k, seed), all advanced by the same passes over the data.

    ``n_init`` starts are drawn from weighted rows that a few passes select from the whole table, and ranked
    by their inertia on all rows, in one more pass for all of them. The best ``full_starts`` are run on all
    rows until the centres move less than ``tol`` mean variances.
    ``resamples`` maps a position in ``wanted`` to (rate, seed) of its bootstrap weights.
    """
    for k, _ in wanted:
        if k < 2:
            raise ValueError("k must be at least 2")
    with kept(df.select("row_id", "features") if not is_kept(df) else df) as held:
        return _fit_many(held, wanted, n_init, full_starts, max_iter, tol, resamples or {})


def _fit_many(df, wanted, n_init, full_starts, max_iter, tol, resamples) -> list[KMeansFit]:
    if not wanted:
        return []
    n, most = count_rows(df), max(k for k, _ in wanted)
    if most > n:
        raise ValueError(f"k={most} exceeds the {n} rows available")
    pool, weights = seeding_rows(df, max(DRAWN_ROWS, DRAWN_PER_CENTER * most))
    tried: dict[tuple[int, int], list[np.ndarray]] = {}
    for k, seed in dict.fromkeys(wanted):
        rng = np.random.default_rng(seed)
        starts = [_settle(pool, weights, plus_plus(pool, k, rng, weights)) for _ in range(n_init)]
        # starts that settled on the same centres are one
        tried[k, seed] = list({np.unique(c.round(9), axis=0).tobytes(): c for c in starts}.values())
    ready = _ranked(df, tried, max(1, full_starts))
    runs, owner = {}, {}
    for w, (k, seed) in enumerate(wanted):
        for centers in ready[k, seed]:
            rate, wseed = resamples.get(w, (None, 0))
            owner[len(runs)] = w
            runs[len(runs)] = Run(centers.copy(), rate, wseed)
    spread = np.average((pool - np.average(pool, axis=0, weights=weights)) ** 2, axis=0, weights=weights)
    lloyd(df, runs, max_iter=max_iter, tol=tol * float(spread.mean()))
    fits = []
    for w, (k, seed) in enumerate(wanted):
        best = min((i for i in runs if owner[i] == w), key=lambda i: (runs[i].inertia, i))
        r = runs[best]
        fits.append(KMeansFit(k, seed, r.centers, r.inertia, r.sizes, r.n_iter))
    return fits


# Cells of centres that one ranking pass compares; more starts take more passes.
_RANK_CELLS = 1 << 16


def _ranked(df: DataFrame, tried: dict[tuple[int, int], list[np.ndarray]], best: int) -> dict[tuple[int, int], list[np.ndarray]]:
    """The best starts of each request by their inertia on all rows."""
    open_ = [(key, i, c) for key, starts in tried.items() if len(starts) > best for i, c in enumerate(starts)]
    inertia: dict[tuple, float] = {}
    while open_:
        taken, cells = [], 0
        while open_ and (not taken or cells + open_[-1][2].size <= _RANK_CELLS):
            taken.append(open_.pop())
            cells += taken[-1][2].size
        sums = _step(df, {i: Run(c) for i, (_, _, c) in enumerate(taken)})
        inertia.update({taken[i][:2]: v[2] for i, v in sums.items()})
    return {
        key: [starts[i] for i in sorted(range(len(starts)), key=lambda i: (inertia.get((key, i), 0.0), i))[:best]] for key, starts in tried.items()
    }


def fit_kmeans(df: DataFrame, k: int, *, seed: int = 0, n_init: int = 10, max_iter: int = 100) -> KMeansFit:
    if k < 2:
        raise ValueError("k must be at least 2")
    return fit_many(df, [(k, seed)], n_init=n_init, max_iter=max_iter)[0]


def fit_fixed(df: DataFrame, ks: list[int], *, steps: int, seed: int = 0) -> dict[int, KMeansFit]:
    """Exactly ``steps`` Lloyd updates from the lowest-hash rows, for several k together."""
    start = lowest_rows(df, max(ks), seed)
    if len(start) < max(ks):
        raise TooLarge(f"k={max(ks)} exceeds the {len(start)} rows available")
    runs = {k: Run(start[:k].copy()) for k in ks}
    lloyd(df, runs, max_iter=steps, fixed=True)
    return {k: KMeansFit(k, seed, r.centers, r.inertia, r.sizes, r.n_iter) for k, r in runs.items()}


def log_inertia(inertia: float) -> float:
    """Finite even when identical points give no inertia at all."""
    return math.log(inertia) if inertia > 0 else math.log(_TINY)


def centers_table(spark, fit: KMeansFit) -> DataFrame:
    rows = [(i, int(n), [float(v) for v in c]) for i, (c, n) in enumerate(zip(fit.centers, fit.sizes))]
    return spark.createDataFrame(rows, "cluster int, size bigint, centroid array<double>")

