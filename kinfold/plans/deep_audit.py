"""Representation learning on a sample, then significance, interpretation, use, audit and registry."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, downstream, drift, geometry, profiles, registry, runs, sampling, significance, surrogate
from ..operators.deep import training
from ..session import checkpoint
from ..sources import files
from .portfolio import reload
from .settings import Settings


def deep_and_audit(
    df: DataFrame, labels: DataFrame, names: list[str], preferred: DataFrame, clock: DataFrame, out: str, settings: Settings = Settings(),
    *, attribute: str | None = None, data_version: str | None = None,
) -> dict[str, DataFrame]:
    """``df`` is ``(row_id, features)`` named by ``names``; ``preferred`` holds the earlier winner's
    labels and ``clock`` is ``(row_id, time)``. Returns result tables, also written to ``out``.

    The composition audit is by ``attribute``, one of ``names`` (else the first). The registered model is
    the best of the learned ones, as its cluster centres; ``data_version`` is that of the source's manifest,
    or else follows from the content of ``df``.
    """
    s, spark = settings, df.sparkSession
    keyed = checkpoint(df.select("row_id", "features").join(labels, "row_id"))
    train = checkpoint(sampling.stratified_sample(keyed, s.train_n, seed=s.seed))
    k = max(2, preferred.where("cluster <> -1").select("cluster").distinct().count())
    shape = {"latent": s.latent, "hidden": s.hidden, "seed": s.seed}
    fitters = {
        "ae_kmeans": lambda: training.fit_ae_kmeans(train, k, ae_epochs=s.ae_epochs, ft_epochs=s.ft_epochs, **shape),
        "dec": lambda: training.fit_dec(train, k, init_epochs=s.ae_epochs, dec_epochs=s.dec_epochs, **shape),
        "dec_contrastive": lambda: training.fit_dec_contrastive(train, k, init_epochs=s.ae_epochs, dec_epochs=s.dec_epochs, **shape),
    }
    found, losses = [], []
    for name, fit in fitters.items():
        start = time.perf_counter()
        model = fit()
        found.append(runs.record(name, k, checkpoint(model.labels(train)), time.perf_counter() - start))
        losses += [(name, i, float(v)) for i, v in enumerate(model.losses)]
    earlier = checkpoint(preferred.join(train.select("row_id"), "row_id").select("row_id", "cluster"))
    found.append(runs.record("earlier_winner", k, earlier, 0.0))
    for run in found:
        runs.score_run(run, train, labels, sample_size=s.silhouette_sample, seed=s.seed)
    learned = found[:-1]  # the earlier winner is there to compare with
    best = runs.rank(learned, "silhouette")[0]
    labelled = checkpoint(train.join(best.labels, "row_id"))
    cis = None
    for run in found:
        pair = run.labels.join(labels, "row_id")
        one = significance.bootstrap_ci(pair, "ari", replicates=s.replicates).withColumn("run", F.lit(run.algorithm))
        cis = one if cis is None else cis.unionByName(one)
    wide = labelled.select("row_id", "cluster", "class", *[F.col("features")[i].alias(n) for i, n in enumerate(names)])
    prof = profiles.cluster_profiles(wide, names, F.col("class"))
    tree = surrogate.fit_surrogate(labelled, names)
    scores, per_cluster = downstream.conditional_modelling(labelled, test_fraction=s.test_fraction, seed=s.seed)
    ranked = checkpoint(downstream.centroid_distances(labelled))
    strata = audit.quantile_strata(wide, attribute or names[0], n_strata=s.n_strata)
    timed = keyed.join(clock, "row_id").select("row_id", "time", *[F.col("features")[i].alias(n) for i, n in enumerate(names)])
    axis = drift.split_axis(timed)
    split = checkpoint(sampling.temporal_split(timed.withColumn("_axis", axis.column), "_axis"))
    drifts = drift.feature_drift(split.where("half = 'early'"), split.where("half = 'late'"), names, threshold=s.psi_threshold)
    variants = {"pca": (geometry.fit_pca(train).project(train), "principal axes of the same rows")}
    tables = {
        "track": runs.performance_table(spark, found),
        "losses": spark.createDataFrame(losses, "model string, step int, loss double"),
        "intervals": cis,
        "permutation": significance.permutation_test(labelled, "ari", permutations=s.replicates),
        "profiles": prof,
        "names": profiles.domain_labels(prof, wide.agg(F.avg("class")).scalar()),
        "exemplars": profiles.exemplars(labelled, sample_size=s.silhouette_sample, seed=s.seed),
        "rules": surrogate.tree_rules(spark, tree),
        "fidelity": surrogate.fidelity(labelled, tree),
        "attributions": surrogate.shap_importance(labelled, tree),
        "conditional": scores,
        "conditional_clusters": per_cluster,
        "anomalies": downstream.anomaly_scores(ranked, label="class", fraction=s.top_fraction),
        "composition": audit.composition(strata),
        "sensitivity": audit.preprocessing_sensitivity(variants, best.labels, k, seed=s.seed),
        "drift": drifts,
        "drift_report": drift.drift_report(drifts, threshold=s.psi_threshold).withColumn("axis", F.lit(str(axis))),
    }
    for name, t in tables.items():
        files.write_parquet(t, f"{out}/{name}")
    if data_version is None:
        content = files.table_fingerprint(df, ["row_id", "features"]).first()
        data_version = f"{content['row_count']}-{content['hash_total']}"
    centres = labelled.where("cluster <> -1").groupBy("cluster").agg(
        F.count("*").alias("size"), *[F.avg(F.col("features")[i]).alias(n) for i, n in enumerate(names)]
    )
    registry.register_model(
        spark, f"{out}/registry", name="clusters", algorithm=best.algorithm, k=k, data_version=data_version, n_rows=best.n_rows,
        n_features=len(names), feature_space="scaled", params={"k": k, **shape}, metrics={m: v for m, v in best.scores.items() if v == v},
        seeds={"seed": s.seed}, artifact=centres, tags=["audited"],
    )
    return reload(spark, out, list(tables))
