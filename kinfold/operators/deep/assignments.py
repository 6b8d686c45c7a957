"""Soft assignments, their sharpened targets, and batch losses as table operations."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.hashing import u01
from ..geometry import Centroids, _all_distances
from .network import info_nce, nearest_other


def _normalised(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.transform(values, lambda x: x / total)


def soft_arrays(df: DataFrame, centroids: Centroids) -> DataFrame:
    """Add ``q``: one Student-t weight per centroid, summing to one within the row."""
    dist = _all_distances(centroids, F.col("features"))
    raw = df.withColumn("_k", F.transform(dist, lambda d: 1.0 / (1.0 + d * d)))
    return raw.withColumn("q", _normalised(F.col("_k"))).drop("_k")


def cluster_mass(soft: DataFrame, k: int) -> DataFrame:
    """One row: the array of summed weights per centroid."""
    return soft.agg(F.array(*[F.sum(F.col("q")[i]) for i in range(k)]).alias("f"))


def target_arrays(soft: DataFrame, k: int) -> DataFrame:
    """Add ``p``, which squares and re-normalises ``q``; only k totals cross rows."""
    with_f = soft.withColumn("_f", cluster_mass(soft, k).scalar())
    raw = F.zip_with("q", "_f", lambda q, f: q * q / f)
    return with_f.withColumn("_p", raw).withColumn("p", _normalised(F.col("_p"))).drop("_f", "_p")


def long_form(soft: DataFrame, centroids: Centroids, *columns: str) -> DataFrame:
    """``(row_id, cluster, columns...)``."""
    zipped = F.arrays_zip(centroids.id_array().alias("cluster"), *[F.col(c) for c in columns])
    return soft.select("row_id", F.inline(zipped))


def hard_labels(soft: DataFrame, centroids: Centroids) -> DataFrame:
    """The centroid with the largest weight; ties go to the lower id."""
    best = F.array_position("q", F.array_max("q")).cast("int")
    return soft.select("row_id", F.element_at(centroids.id_array(), best).alias("cluster"))


def divergence(target: DataFrame) -> DataFrame:
    """Mean over rows of KL(p || q)."""
    part = F.aggregate(F.zip_with("p", "q", lambda p, q: F.when(p > 0, p * F.log(p / q)).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
    return target.agg(F.avg(part).alias("kl"))


def batched(df: DataFrame, batch_rows: int = 128, *, seed: int = 0, n: int | None = None) -> DataFrame:
    """Add ``batch``: every row is hashed into one of n / batch_rows batches."""
    n = df.count() if n is None else n
    count = max(1, math.ceil(n / batch_rows))
    return df.withColumn("batch", F.floor(u01("row_id", "batch", seed) * count).cast("bigint"))


def _sorted_batch(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.sort_by("row_id")
    x = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    return table.column("row_id").to_numpy(), x.reshape(table.num_rows, -1)


def batch_neighbours(df: DataFrame, *, batch_rows: int = 128, seed: int = 0) -> DataFrame:
    """``(batch, row_id, neighbour)``: nearest other row within the row's hashed batch."""

    def kernel(table: pa.Table) -> pa.Table:
        b = table.column("batch")[0].as_py()
        ids, x = _sorted_batch(table)
        if len(ids) < 2:
            ids, near = ids[:0], ids[:0]
        else:
            near = ids[nearest_other(x)]
        return pa.table({"batch": pa.array(np.full(len(ids), b)), "row_id": pa.array(ids), "neighbour": pa.array(near)})

    rows = batched(df.select("row_id", "features"), batch_rows, seed=seed)
    return rows.groupBy("batch").applyInArrow(kernel, "batch bigint, row_id bigint, neighbour bigint")


def batch_contrastive_loss(df: DataFrame, *, batch_rows: int = 128, temperature: float = 0.5, n_negatives: int = 1024, seed: int = 0) -> DataFrame:
    """``(batch, rows, loss)`` over all hashed batches; positives are the batch neighbours."""

    def kernel(table: pa.Table) -> pa.Table:
        b = table.column("batch")[0].as_py()
        ids, x = _sorted_batch(table)
        if len(ids) < 2:
            return pa.table({"batch": pa.array([], pa.int64()), "rows": pa.array([], pa.int64()), "loss": pa.array([], pa.float64())})
        loss, _ = info_nce(x, nearest_other(x), temperature=temperature, n_negatives=n_negatives)
        return pa.table({"batch": [b], "rows": [len(ids)], "loss": [loss]})

    rows = batched(df.select("row_id", "features"), batch_rows, seed=seed)
    return rows.groupBy("batch").applyInArrow(kernel, "batch bigint, rows bigint, loss double")
