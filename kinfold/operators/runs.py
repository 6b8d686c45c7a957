"""Fitting, timing, scoring and comparing clusterings."""

from __future__ import annotations

import time
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, kept
from .algorithms import fit_algorithm
from .contingency import agreement, contingency
from .internal_scores import EXTERNAL, INTERNAL, DegenerateClustering, higher_is_better, score_external, score_internal, silhouette_rows


@dataclass
class RunRecord:
    algorithm: str
    k: int
    labels: DataFrame
    runtime_s: float
    n_clusters: int
    n_noise: int
    n_rows: int
    scores: dict[str, float] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.algorithm}(k={self.n_clusters})"


def run_algorithm(name: str, df: DataFrame, k: int, *, seed: int = 0, **options) -> RunRecord:
    """Fit, materialise the labels, and count clusters and noise."""
    start = time.perf_counter()
    labels = checkpoint(fit_algorithm(name, df, k, seed=seed, **options).select("row_id", "cluster"))
    return record(name, k, labels, time.perf_counter() - start)


def record(name: str, k: int, labels: DataFrame, runtime: float) -> RunRecord:
    row = labels.agg(
        F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("c"),
        F.count_if(F.col("cluster") == -1).alias("noise"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return RunRecord(name, k, labels, runtime, row["c"], row["noise"], row["n"])


def score_run(run: RunRecord, df: DataFrame, truth: DataFrame | None = None, *, metrics=INTERNAL, sample_size: int | None = None, seed: int = 0) -> RunRecord:
    """Add scores; one that is undefined becomes NaN and the sweep goes on."""
    # joined once for all metrics
    with kept(df.select("row_id", "features").join(run.labels, "row_id")) as joined:
        for m in metrics:
            try:
                run.scores[m] = score_internal(m, joined, sample_size=sample_size, seed=seed)
            except DegenerateClustering:
                run.scores[m] = float("nan")
    if truth is not None:
        cells = contingency(run.labels.join(truth, "row_id"), "class", "cluster")
        run.scores.update(score_external(EXTERNAL, cells))
    return run


def performance_table(spark, runs: list[RunRecord]) -> DataFrame:
    names = [*INTERNAL, *EXTERNAL]
    rows = [
        (r.algorithm, r.k, r.n_clusters, r.n_noise, r.n_rows, round(r.runtime_s, 3), *[r.scores.get(m, float("nan")) for m in names])
        for r in runs
    ]
    fixed = "algorithm string, k_requested int, n_clusters int, n_noise bigint, n_rows bigint, runtime_s double"
    return spark.createDataFrame(rows, fixed + "".join(f", {m} double" for m in names))


def rank(runs: list[RunRecord], metric: str) -> list[RunRecord]:
    """Best first; undefined scores last whichever way the metric points."""
    up = higher_is_better(metric)

    def key(r: RunRecord):
        v = r.scores.get(metric, float("nan"))
        return (1, 0.0) if v != v else (0, -v if up else v)

    return sorted(runs, key=key)


def agreement_matrix(runs: list[RunRecord]) -> DataFrame:
    """Pairwise ARI of all labellings in long form, noise kept as a label.

    Runs that share a name are told apart by their place among them: the second is ``name#2``.
    """
    out, seen = None, Counter()
    for r in runs:
        seen[r.name] += 1
        name = r.name if seen[r.name] == 1 else f"{r.name}#{seen[r.name]}"
        one = r.labels.select("row_id", F.lit(name).alias("run"), F.col("cluster").cast("bigint").alias("cluster"))
        out = one if out is None else out.unionByName(one)
    return agreement(out)


def worst_rows(df: DataFrame, *, n_worst: int = 200, sample_size: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """All scored rows, and the ``n_worst`` with the lowest silhouette."""
    scored = checkpoint(silhouette_rows(df, sample_size=sample_size, seed=seed))
    return scored, scored.orderBy("silhouette", "row_id").limit(n_worst)


def error_analysis(df: DataFrame, *, label: str | None = None, n_worst: int = 200, sample_size: int | None = None, seed: int = 0) -> DataFrame:
    """One row on the worst-fitting points, with the label's rate among them and in the whole table."""
    scored, worst = worst_rows(df, n_worst=n_worst, sample_size=sample_size, seed=seed)
    worst = checkpoint(worst)
    all_rows = scored.agg(
        F.avg("silhouette").alias("mean_silhouette"),
        F.avg(F.when(F.col("silhouette") < 0, 1.0).otherwise(0.0)).alias("frac_negative_silhouette"),
    ).first()
    per_cluster = worst.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    counts = per_cluster.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cluster", "n")))).alias("m"))
    base = worst.agg(F.count(F.lit(1)).alias("n_inspected"), F.max("silhouette").alias("threshold"))
    out = base.select(
        "n_inspected",
        "threshold",
        F.lit(all_rows["mean_silhouette"]).alias("mean_silhouette"),
        F.lit(all_rows["frac_negative_silhouette"]).alias("frac_negative_silhouette"),
        counts.scalar().alias("per_cluster_counts"),
    )
    if label is None:
        return out.withColumn("label_rate_worst", F.lit(None).cast("double")).withColumn("label_rate_overall", F.lit(None).cast("double"))
    y = F.col(label).cast("double")
    # the worst rows are few, so they are the side that travels
    hit = df.select("row_id", label).join(F.broadcast(worst.select("row_id")), "row_id").agg(F.avg(y).alias("r"))
    return out.withColumn("label_rate_worst", hit.scalar()).withColumn("label_rate_overall", df.agg(F.avg(y)).scalar())
