"""Putting clusters to use: anomaly ranking and one model per cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import batches_of, list_array, matrix, total_vectors, values
from ..session import SINGLE_TASK_ROWS, TooLarge, bounded_rows, check_broadcast, checkpoint
from .geometry import Centroids, own_centroid_distance, rows_of
from .ordering import rank_cutoffs, within_cutoff
from .ranking import ranking_scores
from .sampling import half_even, stratified_split


def centroid_distances(df: DataFrame, *, cluster: str = "cluster") -> DataFrame:
    """Add the distance to the row's own centroid; noise is measured against the nearest one."""
    return own_centroid_distance(df, Centroids.fit(df, cluster=cluster), cluster=cluster)


def flag_top(df: DataFrame, score: str = "distance", *, fraction: float = 0.01, row_id: str = "row_id", limit: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Add boolean ``flagged`` for the highest ``max(1, round(fraction n))`` scores; ties by row id."""
    n = df.count()
    quota = max(1, half_even(fraction * n))
    keyed = df.withColumn("_key", -F.col(score))
    cut = rank_cutoffs(keyed, "_key", row_id, {(): quota}, sizes={(): n}, limit=limit)
    return keyed.withColumn("flagged", within_cutoff("_key", row_id, cut)).drop("_key")


def anomaly_scores(scored: DataFrame, *, label: str | None, score: str = "distance", fraction: float = 0.01, limit: int = SINGLE_TASK_ROWS) -> DataFrame:
    """One row that says how well the flagged tail finds the label; NaN without labels."""
    flagged = flag_top(scored, score, fraction=fraction, limit=limit)
    hit = F.col(label).cast("double") if label else F.lit(float("nan"))
    base = flagged.agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_if("flagged").alias("n_flagged"),
        F.lit(fraction).alias("top_fraction"),
        F.avg(F.when(F.col("flagged"), hit)).alias("precision_at_k"),
        (F.sum(F.when(F.col("flagged"), hit)) / F.nullif(F.sum(hit), F.lit(0.0))).alias("recall_at_k"),
        F.avg(hit).alias("base_rate"),
    )
    out = base.withColumn("enrichment", F.col("precision_at_k") / F.nullif(F.col("base_rate"), F.lit(0.0)))
    if label is None:
        nan = F.lit(float("nan"))
        return out.withColumn("roc_auc", nan).withColumn("average_precision", nan)
    ranks = ranking_scores(scored, score, label, limit=limit).first()
    return out.withColumn("roc_auc", F.lit(ranks["roc_auc"]).cast("double")).withColumn(
        "average_precision", F.lit(ranks["average_precision"]).cast("double")
    )


# --- one logistic model per cluster ---------------------------------------------------------

GLOBAL = -(2**40)  # key of the model over all rows


def fit_logistic(df: DataFrame, *, key: str = "cluster", label: str = "class", c: float = 1.0, max_iter: int = 25) -> dict[int, np.ndarray]:
    """Balanced, L2-regularised logistic models: one over all rows and one per key, all at once.

    Every Newton step is one pass in which a task adds up a gradient and a curvature matrix per
    model, so a cluster may be as large as it likes. A key with ten rows or fewer, or with one
    class, gets no model. The weights are ``(intercept, coefficients)``; the intercept is free.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("p"))
    info = {r[key]: (r["n"], r["p"]) for r in bounded_rows(counts, 20_000, "models")}
    total, pos = sum(n for n, _ in info.values()), sum(p for _, p in info.values())
    if pos in (0, total):
        raise ValueError("the global model needs both classes in the training rows")
    sizes = {GLOBAL: (total, pos)}
    sizes.update({k: v for k, v in info.items() if v[0] > 10 and 0 < v[1] < v[0]})
    balance = {k: (n / (2 * (n - p)), n / (2 * p)) for k, (n, p) in sizes.items()}
    d = len(df.select("features").first()["features"])
    beta = {k: np.zeros(d + 1) for k in sizes}
    if len(beta) * (d + 1) ** 2 > 20_000_000:
        raise TooLarge("too many models for one pass")
    source = checkpoint(df.select("features", F.col(label).cast("int").alias(label), F.col(key).cast("bigint").alias(key)))
    live = set(beta)
    penalty = np.r_[0.0, np.full(d, 1.0)]
    for _ in range(max_iter):
        at = {k: beta[k] for k in live}
        check_broadcast(sum(b.size for b in at.values()), "model weights")

        def kernel(batches):
            acc: dict[int, np.ndarray] = {}
            for b in batches_of(batches):
                x_all, y_all, keys = matrix(b), values(b, label).astype(float), values(b, key)
                x_all = np.column_stack([np.ones(len(x_all)), x_all])
                for k, w in at.items():
                    pick = slice(None) if k == GLOBAL else keys == k
                    x, y = x_all[pick], y_all[pick]
                    if not len(x):
                        continue
                    z = x @ w
                    p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
                    s = np.where(y > 0, balance[k][1], balance[k][0])
                    loss = float((s * (np.logaddexp(0.0, z) - y * z)).sum())
                    hess = (x * (s * p * (1 - p))[:, None]).T @ x
                    part = np.concatenate([[loss], x.T @ (s * (p - y)), hess.ravel()])
                    acc[k] = acc[k] + part if k in acc else part
            yield from acc.items()

        found = total_vectors(source, kernel, ["model"], cells=sum((d + 1) * (d + 2) + 1 for _ in at))
        for k in list(live):
            vec = found[(k,)]
            g = c * vec[1 : d + 2] + penalty * beta[k]
            h = c * vec[d + 2 :].reshape(d + 1, d + 1) + np.diag(penalty + 1e-10)
            step = np.linalg.solve(h, g)
            size = float(np.abs(step).max())
            # a long Newton step is shortened, which keeps separable data from overshooting
            beta[k] = beta[k] - step * min(1.0, 5.0 / max(size, 1e-12))
            if size < 1e-6:
                live.discard(k)
        if not live:
            break
    return beta


def predict_logistic(df: DataFrame, beta: dict[int, np.ndarray], *, key: str = "cluster") -> DataFrame:
    """Add ``global_score`` and ``cluster_score``; a key without a model falls back to the global one."""
    keys = np.array([k for k in sorted(beta) if k != GLOBAL], dtype=np.int64)
    table = np.array([beta[int(k)] for k in keys]) if len(keys) else np.zeros((0, len(beta[GLOBAL])))
    base = beta[GLOBAL]

    @F.arrow_udf("array<double>")
    def score(feats: pa.Array, group: pa.Array) -> pa.Array:
        x = rows_of(feats)
        x = np.column_stack([np.ones(len(x)), x])
        cl = group.to_numpy(zero_copy_only=False)
        z = np.column_stack([x @ base, x @ base])
        if len(keys):
            at = np.minimum(np.searchsorted(keys, cl), len(keys) - 1)
            own = keys[at] == cl
            z[own, 1] = (x[own] * table[at[own]]).sum(1)
        return list_array(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))

    out = df.withColumn("_s", score("features", F.col(key).cast("bigint")))
    return out.select(*df.columns, F.col("_s")[0].alias("global_score"), F.col("_s")[1].alias("cluster_score"))


def conditional_bookkeeping(split: DataFrame, *, key: str = "cluster", label: str = "class") -> DataFrame:
    """Per cluster with test rows: row and positive counts on both sides, and whether it was modelled."""
    y, test = F.col(label).cast("int"), F.col("is_test")
    per = split.groupBy(key).agg(
        F.count_if(~test).alias("n_train"),
        F.count_if(test).alias("n_test"),
        F.sum(F.when(~test, y).otherwise(0)).alias("positives_train"),
        F.sum(F.when(test, y).otherwise(0)).alias("positives_test"),
    )
    modelled = (F.col("n_train") > 10) & (F.col("positives_train") > 0) & (F.col("positives_train") < F.col("n_train"))
    return per.where("n_test > 0").withColumn("modelled", modelled)


def conditional_modelling(df: DataFrame, *, test_fraction: float = 0.3, seed: int = 0, label: str = "class") -> tuple[DataFrame, DataFrame]:
    """``(scores, per_cluster)``: per-cluster models against one global model on one shared holdout."""
    split = stratified_split(df, test_fraction, strata=label, seed=seed)
    train, test = split.where("not is_test"), split.where("is_test")
    beta = fit_logistic(train, label=label)
    scored = predict_logistic(test, beta).select(label, "global_score", "cluster_score")
    long = scored.select(
        label,
        F.inline(
            F.array(
                F.struct(F.lit("global").alias("model"), F.col("global_score").alias("score")),
                F.struct(F.lit("clustered").alias("model"), F.col("cluster_score").alias("score")),
            )
        ),
    )
    ranks = {r["model"]: r for r in ranking_scores(long, "score", label, ["model"]).collect()}
    per = conditional_bookkeeping(split, label=label)
    g, k = ranks["global"], ranks["clustered"]
    sizes = split.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"))
    lift = k["average_precision"] / g["average_precision"] if g["average_precision"] else float("nan")
    scores = sizes.select(
        "n_train", "n_test",
        F.lit(g["average_precision"]).alias("global_average_precision"),
        F.lit(k["average_precision"]).alias("clustered_average_precision"),
        F.lit(g["roc_auc"]).alias("global_roc_auc"),
        F.lit(k["roc_auc"]).alias("clustered_roc_auc"),
        F.lit(lift).alias("lift"),
    )
    return scores, per
