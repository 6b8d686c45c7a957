"""Choose k, fit several families on all rows and on one shared sample, compare and stress them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import choose_k, linkage, mixture, runs, sampling, stability
from ..session import checkpoint
from ..sources import files
from .settings import Settings


def compare_portfolio(df: DataFrame, labels: DataFrame, out: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """``df`` is ``(row_id, features)``, ``labels`` is ``(row_id, class)`` and is only used to score.

    Returns result tables, all of them also written to ``out``; :func:`reload` reads them back.
    """
    s, spark = settings, df.sparkSession
    df = checkpoint(df.select("row_id", "features"))
    keyed = df.join(labels, "row_id")
    small = checkpoint(sampling.stratified_sample(keyed, s.k_selection_n, seed=s.seed))
    shared = small if s.portfolio_n == s.k_selection_n else checkpoint(sampling.stratified_sample(keyed, s.portfolio_n, seed=s.seed))

    fits = choose_k.sweep(small, list(s.ks), seed=s.seed, n_init=s.n_init)
    choices = choose_k.choices_table(
        spark,
        [
            choose_k.by_elbow(fits),
            choose_k.by_silhouette(small, fits, sample_size=s.silhouette_sample, seed=s.seed),
            choose_k.by_gap(small, fits, n_refs=s.gap_refs, seed=s.seed),
            choose_k.by_bic(small, fits),
            choose_k.by_bootstrap(small, list(s.ks), n_resamples=s.resamples, fraction=s.resample_fraction, seed=s.seed),
        ],
    )
    k = choose_k.consensus_k(choices).where("chosen").first()["k"]

    def fit_all(names, table, regime):
        found = []
        for name in names:
            opts = {"n_init": s.n_init} if name == "kmeans" else s.options.get(name, {})
            run = runs.run_algorithm(name, table.select("row_id", "features"), k, seed=s.seed, **opts)
            runs.score_run(run, table, labels, sample_size=s.silhouette_sample, seed=s.seed)
            found.append(run)
        return found, runs.performance_table(spark, found).withColumn("regime", F.lit(regime))

    full, full_table = fit_all(s.full_algorithms, df, "full")
    sampled, sample_table = fit_all(s.sample_algorithms, shared, "sample")
    best = runs.rank(full, s.primary_metric)[0]
    errors = runs.error_analysis(
        keyed.join(best.labels, "row_id"), label="class", n_worst=s.n_worst, sample_size=s.silhouette_sample, seed=s.seed
    )
    resampled = stability.resample_labels(small, k, n_resamples=s.resamples, fraction=s.resample_fraction, seed=s.seed, max_n=s.consensus_n)
    consensus = stability.consensus_labels(checkpoint(resampled), k)
    seeds = spark.createDataFrame(
        [("kmeans", stability.seed_stability("kmeans", small, k, n_seeds=s.n_seeds, seed_offset=7000))], "algorithm string, mean_ari double"
    )
    long = None
    for run in full:
        one = run.labels.withColumn("algorithm", F.lit(run.algorithm))
        long = one if long is None else long.unionByName(one)
    files.write_labels(long, f"{out}/labellings")
    # scored against the very rows the consensus was built on
    scored = runs.score_run(runs.record("consensus", k, consensus, 0.0), small, labels, sample_size=s.silhouette_sample)
    tables = {
        "choices": choices,
        "performance": full_table.unionByName(sample_table).unionByName(
            runs.performance_table(spark, [scored]).withColumn("regime", F.lit("consensus"))
        ),
        "agreement": runs.agreement_matrix(sampled),
        "linkages": linkage.compare_linkages(shared, k),
        "covariances": mixture.compare_covariances(shared, k, seed=s.seed),
        "ablation": linkage.metric_ablation(shared, k, sample_size=s.silhouette_sample),
        "stability": seeds,
        "errors": errors,
        "preferred": best.labels.withColumn("algorithm", F.lit(best.algorithm)),
    }
    for name, t in tables.items():
        files.write_parquet(t, f"{out}/{name}")
    return reload(spark, out, list(tables))


def reload(spark, out: str, names: list[str]) -> dict[str, DataFrame]:
    """Stored result tables, without fitting anything again."""
    missing = [n for n in names if not files.path_exists(spark, f"{out}/{n}")]
    if missing:
        raise FileNotFoundError(f"no stored results for {', '.join(missing)} under {out}")
    return {n: files.read_parquet(spark, f"{out}/{n}") for n in names}
