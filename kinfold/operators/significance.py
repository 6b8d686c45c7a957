"""Confidence intervals and permutation tests that resample contingency cells, not rows.

A bootstrap of (true, predicted) pairs is a multinomial draw over the cells, and a shuffle of the
predictions is a draw with fixed margins, so after one pass over the data the cost of a replicate
depends on the number of cells only. Replicates are spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import fixed_margins, metric_function
from ..session import bounded_rows
from .contingency import contingency

MAX_CELLS = 1_000_000
Metric = str | Callable[[np.ndarray], float]


def cell_matrix(df: DataFrame, true: str, pred: str) -> np.ndarray:
    rows = bounded_rows(contingency(df, true, pred), MAX_CELLS, "contingency cells")
    ts, ps = sorted({r["t"] for r in rows}), sorted({r["p"] for r in rows})
    out = np.zeros((len(ts), len(ps)), dtype=np.int64)
    ti, pi = {t: i for i, t in enumerate(ts)}, {p: i for i, p in enumerate(ps)}
    for r in rows:
        out[ti[r["t"]], pi[r["p"]]] = r["n"]
    return out


def _replicates(spark, n: int, draw: Callable[[np.random.Generator], float], seed: int) -> DataFrame:
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array([float(draw(np.random.default_rng([seed, int(i)]))) for i in ids])],
                names=["replicate", "value"],
            )

    parts = min(n, max(1, spark.sparkContext.defaultParallelism))
    return spark.range(0, n, 1, parts).mapInArrow(run, "replicate bigint, value double")


def bootstrap_ci(
    df: DataFrame, metric: Metric, *, true: str = "class", pred: str = "cluster", replicates: int = 1000, level: float = 0.95, seed: int = 0
) -> DataFrame:
    """One row: observed value, mean and deviation over replicates, and the percentile interval."""
    name, fn = metric_function(metric)
    cells = cell_matrix(df, true, pred)
    flat, n = cells.ravel(), int(cells.sum())
    shares = flat / n

    def draw(rng):
        return fn(rng.multinomial(n, shares).reshape(cells.shape))

    tail = (1 - level) / 2
    return _replicates(df.sparkSession, replicates, draw, seed).agg(
        F.lit(name).alias("metric"),
        F.lit(float(fn(cells))).alias("observed"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.percentile("value", F.lit(tail)).alias("lower"),
        F.percentile("value", F.lit(1 - tail)).alias("upper"),
        F.count(F.lit(1)).alias("n_bootstrap"),
        F.lit(level).alias("level"),
    )


def permutation_test(
    df: DataFrame, metric: Metric, *, true: str = "class", pred: str = "cluster", permutations: int = 1000, seed: int = 0
) -> DataFrame:
    """One row: observed value, the null's mean and deviation, and the share of it at or above."""
    name, fn = metric_function(metric)
    cells = cell_matrix(df, true, pred)
    rows, cols, seen = cells.sum(1), cells.sum(0), float(fn(cells))

    def draw(rng):
        return fn(fixed_margins(rng, rows, cols))

    return _replicates(df.sparkSession, permutations, draw, seed).agg(
        F.lit(name).alias("metric"),
        F.lit(seen).alias("observed"),
        F.avg("value").alias("null_mean"),
        F.stddev_pop("value").alias("null_std"),
        F.avg(F.when(F.col("value") >= F.lit(seen), 1.0).otherwise(0.0)).alias("p_value"),
        F.count(F.lit(1)).alias("n_permutations"),
    )


def compare_models(
    df: DataFrame, metric: Metric, *, true: str = "class", pred_a: str = "a", pred_b: str = "b", replicates: int = 1000,
    level: float = 0.95, seed: int = 0,
) -> DataFrame:
    """Interval of metric(a) - metric(b) under joint resampling; significant if it excludes zero."""
    name, fn = metric_function(metric)
    grouped = df.groupBy(true, pred_a, pred_b).agg(F.count(F.lit(1)).alias("n"))
    rows = bounded_rows(grouped, MAX_CELLS, "joint cells")
    axes = [sorted({r[c] for r in rows}) for c in (true, pred_a, pred_b)]
    index = [{v: i for i, v in enumerate(a)} for a in axes]
    cube = np.zeros([len(a) for a in axes], dtype=np.int64)
    for r in rows:
        cube[index[0][r[true]], index[1][r[pred_a]], index[2][r[pred_b]]] = r["n"]
    n, shares = int(cube.sum()), cube.ravel() / cube.sum()

    def difference(c):
        return fn(c.sum(axis=2)) - fn(c.sum(axis=1))

    def draw(rng):
        return difference(rng.multinomial(n, shares).reshape(cube.shape))

    tail = (1 - level) / 2
    out = _replicates(df.sparkSession, replicates, draw, seed).agg(
        F.lit(name).alias("metric"),
        F.lit(float(difference(cube))).alias("observed_diff"),
        F.avg("value").alias("diff_mean"),
        F.stddev_pop("value").alias("diff_std"),
        F.percentile("value", F.lit(tail)).alias("ci_lower"),
        F.percentile("value", F.lit(1 - tail)).alias("ci_upper"),
        F.count(F.lit(1)).alias("n_bootstrap"),
        F.lit(level).alias("level"),
    )
    return out.withColumn("significant", (F.col("ci_lower") > 0) | (F.col("ci_upper") < 0))
