"""Does the clustering come out the same again? Seeds, resamples and consensus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from ..session import TooLarge
from .algorithms import fit_algorithm
from .choose_k import replicate_agreement
from .contingency import agreement
from .kmeans import fit_many
from .pairs import Block, grouped, pair_map
from .sampling import simple_sample
from .trees import chain, cut

MAX_CONSENSUS = 4000


def seed_stability(name: str, df: DataFrame, k: int, *, n_seeds: int, seed_offset: int = 0, **options) -> float:
    """Mean pairwise ARI over refits with different seeds; one seed agrees with itself."""
    if n_seeds < 2:
        return 1.0
    if name == "kmeans":
        fits = fit_many(df, [(k, seed_offset + i) for i in range(n_seeds)], n_init=options.get("n_init", 1), full_starts=1)
        return float(np.mean(replicate_agreement(df, fits)[k]))
    runs = None
    for i in range(n_seeds):
        one = fit_algorithm(name, df, k, seed=seed_offset + i, **options).withColumn("run", F.lit(i))
        runs = one if runs is None else runs.unionByName(one)
    return float(agreement(runs).where("run_a < run_b").agg(F.avg("ari")).first()[0])


def resample_labels(df: DataFrame, k: int, *, n_resamples: int, fraction: float, seed: int = 0, max_n: int = 2000) -> DataFrame:
    """``(row_id, features, labels array<int>)`` for a fixed sample of rows.

    One fit per resample, all in the same passes and from the same starting seed, so resampling
    is the only source of variation. A row that a resample did not draw has label null there; a
    row drawn twice counts once.
    """
    from ..functions.hashing import poisson_weights
    from .geometry import nearest_rows, rows_of

    sample = simple_sample(df.select("row_id", "features"), max_n, tag="consensus", seed=seed)
    draws = [(fraction, seed * 104729 + 1 + r) for r in range(n_resamples)]
    fits = fit_many(sample, [(k, seed)] * n_resamples, n_init=3, full_starts=1, resamples=dict(enumerate(draws)))
    centers = [f.centers for f in fits]

    @F.arrow_udf("array<int>")
    def label(ids: pa.Array, feats: pa.Array) -> pa.Array:
        x, rid = rows_of(feats), ids.to_numpy(zero_copy_only=False)
        cols = [
            np.where(poisson_weights(rid, rate, s) > 0, nearest_rows(x, c)[0], -1) for c, (rate, s) in zip(centers, draws)
        ]
        m = np.column_stack(cols).astype(np.int32)
        flat = pa.array(m.ravel(), mask=(m.ravel() < 0))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), flat)

    return sample.withColumn("labels", label("row_id", "features"))


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per pair of rows: resamples that put them together, and that drew both."""
    co = np.zeros((len(a), len(b)), dtype=np.int64)
    drawn = np.zeros_like(co)
    for r in range(a.shape[1]):
        x, y = a[:, r], b[:, r]
        both = (x[:, None] >= 0) & (y[None, :] >= 0)
        drawn += both
        co += both & (x[:, None] == y[None, :])
    return co, drawn


def _label_matrix(column: pa.ChunkedArray) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = col.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def co_association_counts(labels: DataFrame, *, n: int | None = None) -> DataFrame:
    """``(co, drawn, pairs)``: how many row pairs share ``co`` of the ``drawn`` resamples with both.

    Exact for any number of rows; a task reduces its block pair to at most R x R counts.
    """

    def kernel(left: Block, right: Block, same: bool) -> pa.Table:
        cells: dict[tuple, int] = {}
        if left.rows and right.rows:
            a, b = _label_matrix(left.table.column("labels")), _label_matrix(right.table.column("labels"))
            co, drawn = _shared(a, b)
            keep = np.triu(np.ones(co.shape, bool), 1) if same else np.ones(co.shape, bool)
            code, count = np.unique(co[keep] * 100_000 + drawn[keep], return_counts=True)
            cells = {(int(c) // 100_000, int(c) % 100_000): int(m) for c, m in zip(code, count)}
        return pa.table(
            {
                "co": pa.array([c for c, _ in cells], pa.int64()),
                "drawn": pa.array([d for _, d in cells], pa.int64()),
                "pairs": pa.array(list(cells.values()), pa.int64()),
            }
        )

    parts = pair_map(labels, kernel, "co bigint, drawn bigint, pairs bigint", extra=["labels"], n=n, merge=grouped(["co", "drawn"], pairs="sum"))
    return parts.groupBy("co", "drawn").agg(F.sum("pairs").alias("pairs"))


def consensus_labels(labels: DataFrame, k: int, *, threshold: float = 0.5, max_n: int = MAX_CONSENSUS) -> DataFrame:
    """``(row_id, cluster)``: average linkage on whether two rows are together often enough.

    Runs on the bounded sample that was labelled; a larger table is refused.
    """
    n = labels.count()
    if n > max_n:
        raise TooLarge(f"{n} rows exceed the consensus limit of {max_n}; sample first")
    t = labels.select("row_id", "labels").orderBy("row_id").toArrow()
    m = _label_matrix(t.column("labels"))
    co, drawn = _shared(m, m)
    together = np.where(drawn > 0, co / np.maximum(drawn, 1), 0.0) >= threshold
    np.fill_diagonal(together, True)
    tree = chain(1.0 - together.astype(float), np.ones(n), "average")
    flat = _exact_k(tree, k)
    rows = [(int(r), int(c)) for r, c in zip(t.column("row_id").to_numpy(), flat)]
    return labels.sparkSession.createDataFrame(rows, "row_id bigint, cluster int")


def _exact_k(tree: np.ndarray, k: int) -> np.ndarray:
    """Undo the last k - 1 merges, which gives k groups even among equal heights."""
    return cut(tree, merges=[max(0, len(tree) + 1 - k)]).groups[:, 0]


def stability_summary(name: str, df: DataFrame, k: int, *, n_seeds: int, n_resamples: int = 20, fraction: float = 0.8, threshold: float = 0.5, max_n: int = 2000, seed: int = 0) -> dict:
    labels = resample_labels(df, k, n_resamples=n_resamples, fraction=fraction, seed=seed, max_n=max_n)
    consensus = consensus_labels(labels, k, threshold=threshold)
    return {
        "algorithm": name,
        "k": k,
        "mean_seed_ari": seed_stability(name, df, k, n_seeds=n_seeds),
        "consensus_labels": consensus,
        "co_association": co_association_counts(labels),
        "n_consensus": consensus.count(),
    }


