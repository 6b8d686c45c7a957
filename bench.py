"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Shapes follow the published single-node timings: full-table fits, fits on a stratified sample of
20,000 rows, representation learning on up to 40,000 rows, and the audit steps on whole tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kinfold.functions.vectors import pack  # noqa: E402
from kinfold.operators import density, kmeans, linkage, mixture, pairs, sampling  # noqa: E402
from kinfold.operators.choose_k import sweep  # noqa: E402
from kinfold.operators.deep import training as deep  # noqa: E402
from kinfold.plans.catalog import QUERIES  # noqa: E402
from kinfold.plans.views import LINE_FEATURES, feat_vectors, lines  # noqa: E402
from kinfold.session import prepare_session, spread  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
CATALOG = [
    "anomaly_scoreboard", "scale_hybrid", "dedupe_stats", "strat_split", "external_scores", "agreement", "silhouette_mean",
    "davies_bouldin", "dunn", "error_analysis", "feature_drift", "composition_audit", "cluster_profiles", "ranking_by_group",
    "bootstrap_ci", "permutation", "tree_rules", "shap_importance", "conditional_model", "knn", "hopkins",
]


def done(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("kinfold-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    times: dict[str, float] = {}
    shapes: dict[str, str] = {}

    def timed(name: str, fn, shape: str = "") -> None:
        start = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - start, 3)
        if shape:
            shapes[name] = shape
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    done(QUERIES["label_counts"](spark, SF_DIR))  # start the workers
    # copies of the inputs as the algorithms take them; preparation is not timed
    raw = spread(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    num = pack(lines(spark, SF_DIR).withColumn("row_id", F.monotonically_increasing_id()), LINE_FEATURES, "row_id")
    num = num.repartition(max(CPUS, raw.rdd.getNumPartitions())).persist()
    n = num.count()
    ev = feat_vectors(spark, SF_DIR, "class").persist()
    ev.count()
    sample = sampling.stratified_sample(ev, 20_000).persist()
    s = sample.count()
    train = sampling.stratified_sample(ev, 40_000, seed=1).persist()
    t = train.count()

    timed("kmeans_full", lambda: kmeans.fit_kmeans(num, 2, n_init=20), f"{n}x4 k=2 n_init=20")
    timed("gmm_full", lambda: mixture.fit_mixture(num, 2), f"{n}x4 k=2 full")
    timed("kmeans_sweep", lambda: sweep(num, [2, 3, 4, 5, 6, 7, 8]), f"{n}x4 k=2..8")
    timed("ward_full", lambda: done(linkage.fit_agglomerative(num, 2, m=linkage.MAX_PROTOTYPES)), f"{n}x4 k=2 over {linkage.MAX_PROTOTYPES} groups")
    timed("kmeans_sample", lambda: kmeans.fit_kmeans(sample, 2, n_init=20), f"{s}x4 k=2 n_init=20")
    timed("ward_sample", lambda: done(linkage.fit_agglomerative(sample, 2)), f"{s}x4 k=2, all rows")
    timed("gmm_sample", lambda: mixture.fit_mixture(sample, 2), f"{s}x4 k=2 full")
    timed("hdbscan_sample", lambda: done(density.fit_density(sample, min_cluster_size=100, min_samples=10).labels), f"{s}x4")
    timed("ae_kmeans", lambda: done(deep.fit_ae_kmeans(train, 2).labels(train)), f"{t}x4 100+50 epochs")
    timed("dec", lambda: done(deep.fit_dec(train, 2).labels(train)), f"{t}x4 100+150 epochs")
    timed("dec_contrastive", lambda: done(deep.fit_dec_contrastive(train, 2).labels(train)), f"{t}x4 100+150 epochs")
    timed("nearest_pairs", lambda: done(pairs.self_neighbours(sample, 10)), f"{s}x4 k=10")
    for name in CATALOG:
        timed(name, lambda: done(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": CPUS, "shapes": shapes,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
