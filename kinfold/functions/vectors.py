"""Vector distances as Column expressions, and NumPy views of Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def literal_vector(values: Iterable[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def squared_euclidean(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def manhattan(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def cosine(a: Column, b: Column) -> Column:
    """1 - cosine similarity; a zero vector is at distance 1 from everything."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(1.0)).otherwise(1 - dot(a, b) / norms)


def mahalanobis(a: Column, b: Column, inverse_covariance: np.ndarray) -> Column:
    """sqrt(dT VI d) for a small d x d matrix held as a literal."""
    vi = np.asarray(inverse_covariance, dtype=float)
    diff = F.zip_with(a, b, lambda x, y: x - y)
    rows = F.array(*[literal_vector(r) for r in vi])
    weighted = F.zip_with(rows, diff, lambda row, x: x * dot(row, diff))
    return F.sqrt(F.greatest(_total(weighted), F.lit(0.0)))


DISTANCES: dict[str, Callable[..., Column]] = {
    "euclidean": euclidean,
    "l2": euclidean,
    "manhattan": manhattan,
    "l1": manhattan,
    "cosine": cosine,
}


def get_distance(name: str, inverse_covariance: np.ndarray | None = None) -> Callable[[Column, Column], Column]:
    """Look up a distance by name; Mahalanobis needs the inverse covariance."""
    if name == "mahalanobis":
        if inverse_covariance is None:
            raise ValueError("mahalanobis needs an inverse covariance matrix")
        return lambda a, b: mahalanobis(a, b, inverse_covariance)
    if name not in DISTANCES:
        raise KeyError(f"unknown distance {name!r}")
    return DISTANCES[name]


def pack(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """``(keep..., features array<double>)`` from scalar columns."""
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]).alias("features"))


def matrix(batch: pa.RecordBatch, name: str = "features") -> np.ndarray:
    """Arrow list column of equal-length vectors as an (n, d) array."""
    col = batch.column(batch.schema.get_field_index(name))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(col), -1) if len(col) else np.empty((0, 0))


def values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def list_array(m: np.ndarray) -> pa.Array:
    m = np.ascontiguousarray(m, dtype=np.float64)
    offsets = np.arange(0, m.size + 1, m.shape[1] if m.ndim == 2 and m.shape[1] else 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets[: len(m) + 1]), pa.array(m.ravel()))


# Doubles that partial sums may bring to the driver in one step: 64 MiB.
_PARTIAL_CELLS = 8 * 1024 * 1024


def total_vectors(
    df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], keys: list[str], *, cells: int
) -> dict[tuple, np.ndarray]:
    """Add up the vectors that each task reduces its rows to; ``{key: vector}`` on the driver.

    ``kernel`` folds all batches of a partition into ``(key..., vector)`` tuples, once per
    partition, of at most ``cells`` doubles together. When the partial sums of all partitions are
    few they are fetched as they are, which is a job of one stage. Otherwise they are first added
    up in a round of tasks, or, where a scan's partitions are not known, element by element in a
    shuffle. What moves depends on the number of partitions, never on the number of rows.
    """
    from ..session import TooLarge, is_kept

    if cells > _PARTIAL_CELLS:
        raise TooLarge(f"{cells} cells of sums exceed the limit of {_PARTIAL_CELLS}")
    fields = [pa.field(k, pa.int64()) for k in keys] + [pa.field("vec", pa.list_(pa.float64()))]
    schema = ", ".join([*(f"{k} bigint" for k in keys), "vec array<double>"])

    def send(rows):
        if rows:
            cols = [pa.array([int(r[i]) for r in rows], pa.int64()) for i in range(len(keys))]
            cols.append(pa.array([np.asarray(r[-1], dtype=float) for r in rows], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(fields))

    def run(batches):
        yield from send(list(kernel(batches)))

    def add(batches):
        yield from send([(*k, v) for k, v in _add_up(batches, keys).items()])

    parts = df.mapInArrow(run, schema)
    if is_kept(df):
        n = df.rdd.getNumPartitions()
        if n * cells > _PARTIAL_CELLS:
            few = max(1, min(math.isqrt(n), _PARTIAL_CELLS // cells))
            parts = parts.repartition(few).mapInArrow(add, schema)
        return _add_up(parts.toArrow().to_batches(), keys)
    long = parts.select(*keys, F.posexplode("vec").alias("pos", "x"))
    found = long.groupBy(*keys, "pos").agg(F.sum("x").alias("x")).toArrow()
    at = list(zip(*[found.column(k).to_pylist() for k in keys])) if keys else [()] * found.num_rows
    grouped: dict[tuple, list] = {}
    for key, pos, x in zip(at, found.column("pos").to_pylist(), found.column("x").to_pylist()):
        grouped.setdefault(key, []).append((pos, x))
    return {k: np.array([x for _, x in sorted(v)]) for k, v in grouped.items()}


def _add_up(batches: Iterable[pa.RecordBatch], keys: list[str]) -> dict[tuple, np.ndarray]:
    total: dict[tuple, np.ndarray] = {}
    for b in batches_of(iter(batches)):
        at = list(zip(*[values(b, k).tolist() for k in keys])) if keys else [()] * b.num_rows
        for key, vec in zip(at, b.column(len(keys))):
            v = vec.values.to_numpy(zero_copy_only=False)
            total[key] = total[key] + v if key in total else v
    return total


# Share of the norms below which an expanded squared distance has lost too many digits.
_CANCELLED = 1e-5
_RECHECKED = 1 << 15  # pairs whose differences are held at once
_STRIP = 1 << 15  # distances that are summed up together over the columns


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of two blocks, good to about eleven digits whatever the number of columns.

    The expanded form is one matrix product but cancels for close rows, so those pairs are taken
    from their differences again; a row is at distance 0 from its copies.
    """
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    middle = a.mean(0)
    ca, cb = a - middle, b - middle
    na, nb = (ca * ca).sum(1), (cb * cb).sum(1)
    norms, sq = np.add.outer(na, nb), ca @ cb.T
    sq *= -2.0
    sq += norms
    norms *= _CANCELLED
    i, j = np.nonzero(sq <= norms)
    for at in range(0, len(i), _RECHECKED):
        p, q = i[at : at + _RECHECKED], j[at : at + _RECHECKED]
        sq[p, q] = ((a[p] - b[q]) ** 2).sum(1)
    return sq


def _along(a: np.ndarray, b: np.ndarray, each: Callable, last: Callable | None = None) -> np.ndarray:
    """Sums over the columns of what ``each`` makes of the differences, in strips that stay in the processor's cache."""
    out = np.zeros((len(a), len(b)))
    high = max(1, _STRIP // max(1, len(b)))
    rest = np.empty((high, len(b)))
    across, down = np.ascontiguousarray(b.T), np.ascontiguousarray(a.T)
    for i in range(0, len(a), high):
        strip = out[i : i + high]
        gap = rest[: len(strip)]
        for p, q in zip(down[:, i : i + high, None], across):
            np.subtract(p, q, out=gap)
            each(gap)
            strip += gap
        if last is not None:
            last(strip, out=strip)
    return out


def pair_distances(a: np.ndarray, b: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    """Distances between two blocks of rows held by one task."""
    if metric in ("euclidean", "l2"):
        if a.shape[1] <= 16:  # a loop over few columns costs no more than the matrix product
            return _along(a, b, lambda gap: np.multiply(gap, gap, out=gap), np.sqrt)
        return np.sqrt(squared_distances(a, b))
    if metric in ("manhattan", "l1"):
        return _along(a, b, lambda gap: np.abs(gap, out=gap))
    if metric == "cosine":
        na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
        scale = np.outer(na, nb)
        sim = np.divide(a @ b.T, scale, out=np.zeros_like(scale), where=scale > 0)
        return np.where(scale > 0, np.maximum(1.0 - sim, 0.0), 1.0)
    raise KeyError(f"unknown distance {metric!r}")


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)
