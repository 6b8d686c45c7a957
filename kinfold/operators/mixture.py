"""Gaussian mixtures by expectation-maximisation, four covariance shapes, many models per pass."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import batches_of, matrix, total_vectors
from ..session import check_broadcast, is_kept, kept
from .geometry import rows_of
from .kmeans import KMeansFit, fit_many

COVARIANCE_TYPES = ("spherical", "diag", "tied", "full")
REGULARISATION = 1e-6


@dataclass
class Mixture:
    k: int
    covariance_type: str
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray  # always (k, d, d) in use; the shape constraint is applied when fitting
    log_likelihood: float = -math.inf
    n: int = 0
    n_iter: int = 0
    converged: bool = False
    used: int = 0

    @property
    def n_parameters(self) -> int:
        d = self.means.shape[1]
        shape = {
            "full": self.k * d * (d + 1) // 2,
            "tied": d * (d + 1) // 2,
            "diag": self.k * d,
            "spherical": self.k,
        }[self.covariance_type]
        return shape + self.k * d + self.k - 1

    @property
    def bic(self) -> float:
        return -2 * self.log_likelihood + self.n_parameters * math.log(self.n)

    @property
    def aic(self) -> float:
        return -2 * self.log_likelihood + 2 * self.n_parameters

    def whiteners(self) -> tuple[np.ndarray, np.ndarray]:
        """Per component: a matrix that turns centred rows into unit variance, and its log determinant."""
        chol = np.linalg.cholesky(self.covariances)
        inv = np.stack([np.linalg.inv(c) for c in chol])
        return inv, np.log(np.diagonal(inv, axis1=1, axis2=2)).sum(1)

    def log_joint(self, x: np.ndarray, prepared=None) -> np.ndarray:
        inv, logdet = prepared or self.whiteners()
        out = np.empty((len(x), self.k))
        for j in range(self.k):
            z = (x - self.means[j]) @ inv[j].T
            out[:, j] = logdet[j] - 0.5 * (z * z).sum(1)
        return out - 0.5 * x.shape[1] * math.log(2 * math.pi) + np.log(np.maximum(self.weights, 1e-300))

    def labels(self, df: DataFrame, *keep: str) -> DataFrame:
        model, prepared = self, self.whiteners()

        @F.arrow_udf("int")
        def hard(feats: pa.Array) -> pa.Array:
            return pa.array(model.log_joint(rows_of(feats), prepared).argmax(1).astype(np.int32))

        return df.select(*(keep or ("row_id",)), hard("features").alias("cluster"))


def _expect(df: DataFrame, models: dict[int, Mixture]) -> dict[tuple, np.ndarray]:
    """Responsibility-weighted counts, sums and outer products of every model, plus its likelihood."""
    ready = {i: (m, m.whiteners()) for i, m in models.items()}
    check_broadcast(sum(m.covariances.size for m in models.values()), "mixture parameters")

    def kernel(batches):
        acc: dict[int, list] = {}
        for batch in batches_of(batches):
            x_all = matrix(batch)
            for at in range(0, len(x_all), 65536):
                x = x_all[at : at + 65536]
                for i, (m, prep) in ready.items():
                    joint = m.log_joint(x, prep)
                    top = joint.max(1, keepdims=True)
                    norm = top[:, 0] + np.log(np.exp(joint - top).sum(1))
                    resp = np.exp(joint - norm[:, None])
                    hard = np.bincount(joint.argmax(1), minlength=m.k)
                    # outer products around the current means keep their digits
                    second = np.stack([((x - m.means[j]) * resp[:, j : j + 1]).T @ (x - m.means[j]) for j in range(m.k)])
                    first = np.stack([(resp[:, j : j + 1] * (x - m.means[j])).sum(0) for j in range(m.k)])
                    part = [np.r_[norm.sum(), len(x)], resp.sum(0), hard, first, second]
                    acc[i] = [a + b for a, b in zip(acc[i], part)] if i in acc else part
        for i, parts in acc.items():
            yield i, np.concatenate([np.ravel(p) for p in parts])

    cells = sum(2 + 2 * m.k + m.means.size + m.covariances.size for m in models.values())
    return total_vectors(df, kernel, ["model"], cells=cells)


def _maximise(m: Mixture, vec: np.ndarray) -> Mixture:
    k, d = m.means.shape
    ll, n = vec[0], int(vec[1])
    nk, hard = vec[2 : 2 + k], vec[2 + k : 2 + 2 * k]
    first = vec[2 + 2 * k : 2 + 2 * k + k * d].reshape(k, d)
    second = vec[2 + 2 * k + k * d :].reshape(k, d, d)
    safe = np.maximum(nk, 10 * np.finfo(float).eps)
    shift = first / safe[:, None]
    scatter = second / safe[:, None, None] - shift[:, :, None] * shift[:, None, :]
    eye = np.eye(d)
    if m.covariance_type == "tied":
        pooled = (scatter * nk[:, None, None]).sum(0) / nk.sum()
        cov = np.repeat(pooled[None], k, axis=0)
    elif m.covariance_type == "diag":
        cov = scatter * eye
    elif m.covariance_type == "spherical":
        cov = np.trace(scatter, axis1=1, axis2=2)[:, None, None] / d * eye
    else:
        cov = scatter
    return Mixture(
        k, m.covariance_type, nk / n, m.means + shift, cov + REGULARISATION * eye, float(ll), n, m.n_iter, m.converged,
        int((hard > 0).sum()),
    )


def fit_mixtures(
    df: DataFrame, wanted: list[tuple[int, str]], *, seed: int = 0, max_iter: int = 100, tol: float = 1e-3,
    starts: dict[int, KMeansFit] | None = None,
) -> list[Mixture]:
    """Fit several (k, covariance type) models; each iteration is one pass over the rows for all."""
    for k, kind in wanted:
        if k < 2:
            raise ValueError("k must be at least 2")
        if kind not in COVARIANCE_TYPES:
            raise ValueError(f"unknown covariance type {kind!r}")
    with kept(df.select("row_id", "features") if not is_kept(df) else df) as held:
        return _fit(held, wanted, seed, max_iter, tol, starts)


def _fit(df, wanted, seed, max_iter, tol, starts) -> list[Mixture]:
    ks = sorted({k for k, _ in wanted})
    if starts is None:
        starts = {f.k: f for f in fit_many(df, [(k, seed) for k in ks], n_init=1)}
    models: dict[int, Mixture] = {}
    for i, (k, kind) in enumerate(wanted):
        centers = starts[k].centers
        d = centers.shape[1]
        spread = max(starts[k].inertia / max(starts[k].sizes.sum(), 1.0) / d, REGULARISATION)
        sizes = np.maximum(starts[k].sizes, 1e-9)
        models[i] = Mixture(k, kind, sizes / sizes.sum(), centers.copy(), np.repeat((spread * np.eye(d))[None], k, axis=0))
    live = set(models)
    previous = {i: -math.inf for i in models}
    for it in range(max_iter + 1):
        if not live:
            break
        found = _expect(df, {i: models[i] for i in live})
        for i in sorted(live):
            vec = found[(i,)]
            ll, n = float(vec[0]), int(vec[1])
            settled = abs(ll - previous[i]) / n < tol
            previous[i] = ll
            if settled or it == max_iter:  # likelihood just taken belongs to the parameters kept
                m = models[i]
                m.log_likelihood, m.n, m.converged = ll, n, settled
                m.used = int((vec[2 + m.k : 2 + 2 * m.k] > 0).sum())
                live.discard(i)
            else:
                models[i] = _maximise(models[i], vec)
                models[i].n_iter = it + 1
    return [models[i] for i in range(len(wanted))]


def fit_mixture(df: DataFrame, k: int, *, seed: int = 0, covariance_type: str = "full") -> Mixture:
    return fit_mixtures(df, [(k, covariance_type)], seed=seed)[0]


MIXTURE_SCHEMA = (
    "covariance_type string, log_likelihood double, mean_log_likelihood double, bic double, aic double, "
    "n_parameters int, n_iter int, converged boolean, n_clusters_used int"
)


def compare_covariances(df: DataFrame, k: int, *, seed: int = 0, kinds: tuple[str, ...] = COVARIANCE_TYPES) -> DataFrame:
    """One row per covariance shape, best BIC first."""
    rows = [
        (m.covariance_type, m.log_likelihood, m.log_likelihood / m.n, m.bic, m.aic, m.n_parameters, m.n_iter, m.converged, m.used)
        for m in fit_mixtures(df, [(k, kind) for kind in kinds], seed=seed)
    ]
    return df.sparkSession.createDataFrame(rows, MIXTURE_SCHEMA).orderBy("bic")
