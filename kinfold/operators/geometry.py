"""Centroids, nearest-centroid assignment, moments and principal axes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import (
    batches_of,
    list_array,
    matrix,
    pair_distances,
    total_vectors,
    values,
)
from ..session import TooLarge, bounded_rows, check_broadcast

MAX_CENTROIDS = 20_000


def width(df: DataFrame, features: str = "features") -> int:
    row = df.select(F.size(features).alias("d")).first()
    if row is None:
        raise ValueError("empty table")
    return int(row["d"])


class UnsoundRows(ValueError):
    """Rows that no distance is defined for."""


def count_rows(df: DataFrame, features: str = "features") -> int:
    """The number of rows, once it is known that every vector is there, as long as the others, and holds numbers only."""
    ok = F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v))
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(features).isNull()).alias("absent"), F.count_if(~ok).alias("odd"),
        F.min(F.size(features)).alias("short"), F.max(F.size(features)).alias("long"),
    ).first()
    if row["absent"] or row["odd"]:
        raise UnsoundRows(f"{row['absent']} rows have no {features}, {row['odd']} hold null or NaN in them")
    if row["short"] != row["long"]:
        raise UnsoundRows(f"{features} have {row['short']} to {row['long']} values")
    return row["n"]


def rows_of(feats: pa.Array) -> np.ndarray:
    """(n, d) view of a list column handed to a vectorised function."""
    return feats.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(feats), -1)


def one_row(spark: SparkSession, **named: float) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in named.items()])


@dataclass(frozen=True)
class Centroids:
    """Cluster ids, sizes, centres and mean squared norms; small enough to travel with a task."""

    ids: tuple
    points: np.ndarray
    sizes: np.ndarray | None = None
    norms: np.ndarray | None = None

    @staticmethod
    def fit(df: DataFrame, *, features: str = "features", cluster: str = "cluster") -> Centroids:
        """One pass: each task reduces its rows to a sum per cluster, Spark adds the sums."""
        if isinstance(df.schema[cluster].dataType, T.StringType):
            return Centroids._fit_named(df, features, cluster)

        def kernel(batches):
            total: dict[int, np.ndarray] = {}
            for b in batches_of(batches):
                x, c = matrix(b, features), values(b, cluster)
                names, code = np.unique(c, return_inverse=True)
                onehot = np.zeros((len(x), len(names)))
                onehot[np.arange(len(x)), code] = 1.0
                part = np.column_stack([onehot.sum(0), onehot.T @ (x * x).sum(1), onehot.T @ x])
                for name, vec in zip(names.tolist(), part):
                    total[name] = total[name] + vec if name in total else vec
            yield from total.items()

        live = df.where(F.col(cluster) != -1).select(features, F.col(cluster).cast("bigint").alias(cluster))
        found = total_vectors(live, kernel, ["cluster"], cells=1_000_000)
        if not found:
            raise ValueError("no non-noise cluster to build centroids from")
        if len(found) > MAX_CENTROIDS:
            raise TooLarge(f"centroids: more than {MAX_CENTROIDS} clusters")
        keys = sorted(found)
        m = np.array([found[k] for k in keys])
        check_broadcast(m.size, "centroids")
        return Centroids(tuple(k[0] for k in keys), m[:, 2:] / m[:, :1], m[:, 0], m[:, 1] / m[:, 0])

    @staticmethod
    def _fit_named(df: DataFrame, features: str, cluster: str) -> Centroids:
        d = width(df, features)
        table = df.groupBy(cluster).agg(
            F.count(F.lit(1)).alias("size"), F.array(*[F.avg(F.col(features)[i]) for i in range(d)]).alias("centroid")
        )
        rows = sorted(bounded_rows(table, MAX_CENTROIDS, "centroids"), key=lambda r: r[cluster])
        if not rows:
            raise ValueError("no non-noise cluster to build centroids from")
        points = np.array([r["centroid"] for r in rows], dtype=float)
        check_broadcast(points.size, "centroids")
        return Centroids(tuple(r[cluster] for r in rows), points, np.array([float(r["size"]) for r in rows]))

    def id_array(self) -> Column:
        """The ids as an array column, in centroid order."""
        kind = "string" if isinstance(self.ids[0], str) else "bigint"
        return F.array(*[F.lit(c).cast(kind) for c in self.ids])

    @property
    def d(self) -> int:
        return self.points.shape[1]

    def check_width(self, d: int) -> None:
        if d != self.d:
            raise ValueError(f"rows have {d} features, centroids have {self.d}")

    def table(self, spark: SparkSession) -> DataFrame:
        """``(cluster, size, centroid)``."""
        sizes = self.sizes if self.sizes is not None else np.full(len(self.ids), np.nan)
        rows = [(c, int(n), [float(x) for x in p]) for c, n, p in zip(self.ids, sizes, self.points)]
        kind = "string" if isinstance(self.ids[0], str) else "bigint"
        return spark.createDataFrame(rows, f"cluster {kind}, size bigint, centroid array<double>")


# Up to this many centroid numbers a distance is compiled arithmetic; beyond, a vectorised function.
# Either way gives the same answer; only the speed differs.
_COMPILED_CELLS = 256
# Rounding of an expanded squared distance, as a share of the norms.
_NEAR_TIE = 1e-13


def _squared(features: Column, point: np.ndarray) -> Column:
    total = F.lit(0.0)
    for i, v in enumerate(point):
        total = total + (features[i] - F.lit(float(v))) * (features[i] - F.lit(float(v)))
    return total


def _all_distances(centroids: Centroids, features: Column) -> Column:
    """Array of distances to every centroid, in centroid order."""
    if centroids.points.size <= _COMPILED_CELLS:
        return F.array(*[F.sqrt(_squared(features, p)) for p in centroids.points])
    points = centroids.points

    @F.arrow_udf("array<double>")
    def distances(feats: pa.Array) -> pa.Array:
        return list_array(pair_distances(rows_of(feats), points))

    return distances(features)


def centroid_ranking(df: DataFrame, centroids: Centroids, *, row_id: str = "row_id", features: str = "features") -> DataFrame:
    """``(row_id, cluster, distance, rank)`` against every centroid, computed inside each row."""
    centroids.check_width(width(df, features))
    distance = _all_distances(centroids, F.col(features)).alias("distance")
    ladder = F.array_sort(F.arrays_zip(distance, centroids.id_array().alias("cluster")))
    long = df.select(row_id, F.posexplode(ladder).alias("_r", "_c"))
    return long.select(
        row_id, F.col("_c.cluster").alias("cluster"), F.col("_c.distance").alias("distance"), (F.col("_r") + 1).alias("rank")
    )


def assign_nearest(df: DataFrame, centroids: Centroids, *, features: str = "features", checked: bool = False) -> DataFrame:
    """Add ``assigned_cluster`` and ``distance_to_centroid``; works on batch and streaming tables.

    Ties go to the lower cluster id. Few centroids are compiled arithmetic; many go through one
    vectorised pass. Neither shuffles.
    """
    if not checked:
        centroids.check_width(width(df, features))
    kind = "string" if isinstance(centroids.ids[0], str) else "bigint"
    if centroids.points.size <= _COMPILED_CELLS:
        f = F.col(features)
        near = F.array_min(
            F.array(
                *[
                    F.struct(F.sqrt(_squared(f, p)).alias("d"), F.lit(c).cast(kind).alias("c"))
                    for c, p in zip(centroids.ids, centroids.points)
                ]
            )
        )
    else:
        points, ids = centroids.points, pa.array(list(centroids.ids))

        @F.arrow_udf(f"struct<d:double,c:{kind}>")
        def nearest(feats: pa.Array) -> pa.Array:
            best, dist = nearest_rows(rows_of(feats), points)
            target = pa.string() if kind == "string" else pa.int64()
            return pa.StructArray.from_arrays([pa.array(dist), ids.take(pa.array(best)).cast(target)], ["d", "c"])

        near = nearest(features)
    return df.withColumn("_near", near).select(
        *df.columns, F.col("_near.c").alias("assigned_cluster"), F.col("_near.d").alias("distance_to_centroid")
    )


def nearest_rows(x: np.ndarray, points: np.ndarray, block: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to the nearest point for each row, in bounded work areas."""
    best, dist = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    pn = (points * points).sum(1)
    step = max(1, block // max(1, len(points)))
    for i in range(0, len(x), step):
        b = x[i : i + step]
        score = pn[None, :] - 2.0 * (b @ points.T)
        near = np.argmin(score, axis=1)
        # centres too close to the best for the expanded form are compared by their differences, ties to the first
        low = score[np.arange(len(b)), near][:, None]
        rival = score <= low + _NEAR_TIE * ((b * b).sum(1)[:, None] + pn[None, :])
        unsure = np.flatnonzero(rival.sum(1) > 1)
        few = max(1, 32_768 // len(points))
        for at in range(0, len(unsure), few):
            rows = unsure[at : at + few]
            r, c = np.nonzero(rival[rows])
            exact = np.full((len(rows), len(points)), np.inf)
            exact[r, c] = ((b[rows[r]] - points[c]) ** 2).sum(1)
            near[rows] = exact.argmin(1)
        best[i : i + step] = near
        dist[i : i + step] = np.sqrt(((b - points[near]) ** 2).sum(1))
    return best, dist


def own_centroid_distance(
    df: DataFrame, centroids: Centroids, *, features: str = "features", cluster: str = "cluster"
) -> DataFrame:
    """Add ``distance``: to the row's own centroid, or to the nearest one for noise (label -1).

    A label that has no centroid, or none at all, has no distance (null).
    """
    f, c = F.col(features), F.col(cluster)
    if centroids.points.size <= _COMPILED_CELLS:
        squares = [_squared(f, p) for p in centroids.points]
        own = F.lit(None).cast("double")
        for name, sq in zip(centroids.ids, squares):
            own = F.when(c == F.lit(name), sq).otherwise(own)
        nearest = F.array_min(F.array(*squares))
        noise = F.lit(False) if isinstance(centroids.ids[0], str) else c == -1
        return df.withColumn("distance", F.sqrt(F.when(noise, nearest).otherwise(own)))
    points, ids = centroids.points, pa.array(list(centroids.ids))

    @F.arrow_udf("double")
    def own_distance(feats: pa.Array, cl: pa.Array) -> pa.Array:
        x, cl = rows_of(feats), cl.cast(ids.type)
        at = pc.index_in(cl, ids)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False)
        dist = np.sqrt(((x - points[at]) ** 2).sum(1))
        noise = np.zeros(len(x), bool)
        if not pa.types.is_string(ids.type):
            noise = pc.fill_null(pc.equal(cl, -1), False).to_numpy(zero_copy_only=False)
        if noise.any():
            dist[noise] = nearest_rows(x[noise], points)[1]
        return pa.array(dist, mask=~(known | noise))

    return df.withColumn("distance", own_distance(f, c))


def dispersion(df: DataFrame, centroids: Centroids, *, features: str = "features", cluster: str = "cluster") -> np.ndarray:
    """Per cluster, in centroid order: rows, summed distance and summed squared distance to its centre."""
    points, index = centroids.points, {c: i for i, c in enumerate(centroids.ids)}

    def kernel(batches):
        acc = np.zeros((len(points), 3))
        for b in batches_of(batches):
            x, c = matrix(b, features), values(b, cluster)
            names, code = np.unique(c, return_inverse=True)
            at = np.array([index[n] for n in names.tolist()])[code]
            sq = ((x - points[at]) ** 2).sum(1)
            acc[:, 0] += np.bincount(at, minlength=len(points))
            acc[:, 1] += np.bincount(at, np.sqrt(sq), len(points))
            acc[:, 2] += np.bincount(at, sq, len(points))
        yield (acc.ravel(),)

    live = df.where(F.col(cluster) != -1).select(features, cluster)
    return total_vectors(live, kernel, [], cells=3 * len(points))[()].reshape(-1, 3)


# --- moments and principal axes -------------------------------------------------------------


@dataclass(frozen=True)
class Moments:
    n: int
    mean: np.ndarray
    scatter: np.ndarray  # sum of centred outer products

    def covariance(self, sample: bool = True) -> np.ndarray:
        return self.scatter / (self.n - 1 if sample else self.n)


def fit_moments(df: DataFrame, features: str = "features") -> Moments:
    """Count, mean and centred scatter matrix in two passes; only d x d numbers leave the tasks."""
    def sums(batches):
        acc = None
        for b in batches_of(batches):
            x = matrix(b, features)
            part = np.r_[len(x), x.sum(0)]
            acc = part if acc is None else acc + part
        if acc is not None:
            yield (acc,)

    first = total_vectors(df.select(features), sums, [], cells=100_000)
    if not first:
        raise ValueError("empty table")
    n, mean = int(first[()][0]), first[()][1:] / first[()][0]
    d = len(mean)

    def kernel(batches):
        acc = np.zeros((d, d))
        for b in batches_of(batches):
            x = matrix(b, features) - mean
            acc += x.T @ x
        yield (acc.ravel(),)

    scatter = total_vectors(df.select(features), kernel, [], cells=d * d)[()].reshape(d, d)
    return Moments(n, mean, scatter)


def inverse_covariance(moments: Moments) -> np.ndarray:
    return np.linalg.inv(moments.covariance())


@dataclass(frozen=True)
class PCAModel:
    mean: np.ndarray
    components: np.ndarray  # all d axes as rows, strongest first
    variance: np.ndarray
    n_components: int

    @property
    def ratio(self) -> np.ndarray:
        return self.variance / self.variance.sum()

    def project(self, df: DataFrame, *, features: str = "features", out: str = "features") -> DataFrame:
        """Centred scores on the kept axes; the loadings are d x m numbers inside the task."""
        mean, axes = self.mean, self.components[: self.n_components].T.copy()

        @F.arrow_udf("array<double>")
        def scores(feats: pa.Array) -> pa.Array:
            return list_array((rows_of(feats) - mean) @ axes)

        return df.withColumn(out, scores(features))


def fit_pca(df: DataFrame, target: float | int = 0.95, *, features: str = "features") -> PCAModel:
    """Axes from the covariance matrix; keep the fewest that reach ``target`` variance, or a count."""
    m = fit_moments(df, features)
    values, vectors = np.linalg.eigh(m.covariance())
    order = np.argsort(values)[::-1]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order].T
    # fixed sign: the largest loading of each axis is positive
    peak = np.abs(vectors).argmax(axis=1)
    vectors = vectors * np.sign(vectors[np.arange(len(vectors)), peak])[:, None]
    d = len(values)
    if isinstance(target, int):
        keep = min(target, d)
    else:
        cum = np.cumsum(values / values.sum())
        keep = min(int(np.searchsorted(cum, target)) + 1, d)
    return PCAModel(m.mean, vectors, values, keep)


def variance_curve(spark, model: PCAModel, max_components: int | None = None) -> DataFrame:
    """``(component, ratio, cumulative)``; at most d rows."""
    ratio = model.ratio[: max_components or len(model.variance)]
    cum = np.cumsum(ratio)
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, cum))]
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


def density_grid(df: DataFrame, x: str, y: str, cells: int = 60) -> DataFrame:
    """Counts on a cells x cells grid over the data's box; empty cells are absent."""
    box = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()

    def bin_of(c: str, lo: float, hi: float) -> Column:
        span = (hi - lo) or 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(span) * cells), F.lit(cells - 1)).cast("int")

    return (
        df.select(bin_of(x, box["x0"], box["x1"]).alias("bin_x"), bin_of(y, box["y0"], box["y1"]).alias("bin_y"))
        .groupBy("bin_x", "bin_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def log_sum_exp(x: np.ndarray) -> float:
    top = float(np.max(x))
    return top if math.isinf(top) else top + float(np.log(np.exp(x - top).sum()))
