"""The query catalogue: one entry per operator, on the given tables, as whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import u01
from ..functions.vectors import get_distance, literal_vector, pack
from ..operators import audit, choose_k, cleaning, contingency, density, downstream, drift, features as fe, geometry
from ..operators import internal_scores as inner
from ..operators import kmeans, linkage, merging, mixture, pairs, profiles, ranking, registry, runs, sampling, significance
from ..operators import stability, surrogate, tendency
from ..operators.deep import assignments as soft
from ..operators.deep import training as deep
from ..operators.ordering import exact_quantiles
from ..session import checkpoint, prepare_session, scratch_path
from ..sources import contracts, files
from ..streaming import assign as stream_assign
from ..streaming import drift as stream_drift
from . import deep_audit, portfolio, prepare, views
from .settings import Settings
from .views import FEATURES, LINE_FEATURES, emb, feat, feat_vectors, lines, suppliers, table, txn

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare_session(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double and fold -0.0 into 0.0, so that sums in another order compare equal."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.DoubleType):
            out.append((F.round(f.name, special.get(f.name, digits)) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# --- flagship ---------------------------------------------------------------------------------


def _scaled_groups(spark, sf_dir) -> DataFrame:
    """Scaled features as vectors, with the event group as the cluster and the rare label."""
    f = feat(spark, sf_dir)
    params = fe.fit_scaler(f, "hybrid", ["log_amount"], ["time_sin", "time_cos"])
    scaled = fe.apply_scaler(f, params, "row_id", F.col("grp").alias("cluster"), F.col("rare").alias("class"))
    return pack(scaled, ["log_amount", "time_sin", "time_cos"], "row_id", "cluster", "class")


@query
def anomaly_scoreboard(spark, sf_dir):
    """Which 1% of events are least typical of their group, and is the rare label enriched there?"""
    scored = checkpoint(downstream.centroid_distances(_scaled_groups(spark, sf_dir)).select("row_id", "class", "distance"))
    return rounded(downstream.anomaly_scores(scored, label="class"))


# --- sources and contracts ---------------------------------------------------------------------


@query
def schema_violations(spark, sf_dir):
    S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()
    schema = T.StructType([T.StructField(n, t, False) for n, t in (("amount", D), ("k", I), ("grp", S), ("gone", D))])
    rules = (
        contracts.Rule("amount", "min", (1.0,)),
        contracts.Rule("k", "in_range", (0, 90)),
        contracts.Rule("grp", "isin", ("click", "error")),
    )
    return contracts.violations(txn(spark, sf_dir).select("amount", "k", "grp", "class"), contracts.Contract(schema, rules))


@query
def source_expectations(spark, sf_dir):
    return contracts.expectation_report(table(spark, sf_dir, "orders"), contracts.Expectations(rows=15000, columns=7))


@query
def file_manifest(spark, sf_dir):
    """Size and hash of every table's file; the time of listing is left out, as it differs each time."""
    listed = files.file_manifest(spark, sf_dir, "local tables", pattern="*.parquet")
    return listed.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "size_bytes", "sha256", "source")


@query
def table_fingerprint(spark, sf_dir):
    return files.table_fingerprint(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query
def csv_ingest(spark, sf_dir):
    """Write as CSV, ingest it through schema, contract and row check, and read the stored table."""
    src = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path, out = scratch_path(spark, "orders-csv"), scratch_path(spark, "orders-ingest")
    src.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, False) for f in src.schema])
    contract = contracts.Contract(schema, (contracts.Rule("o_totalprice", "min", (0.0,)),))
    stored, _ = files.ingest_csv(spark, path, out, "orders", contract, contracts.Expectations(rows=src.count(), columns=4))
    return rounded(
        stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), total=2
    )


@query
def label_store(spark, sf_dir):
    """Labellings stored one folder per algorithm; reading one back touches only its folder."""
    t = txn(spark, sf_dir)
    long = t.select(
        "row_id",
        F.inline(
            F.array(
                F.struct(F.lit("tens").alias("algorithm"), F.expr("k div 10").cast("int").alias("cluster")),
                F.struct(F.lit("class").alias("algorithm"), F.col("class").alias("cluster")),
            )
        ),
    )
    path = scratch_path(spark, "labels")
    files.write_labels(long, path)
    return cleaning.label_counts(files.read_labels(spark, path, "tens"))


@query
def json_summary(spark, sf_dir):
    per = txn(spark, sf_dir).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("top"))
    return files.as_json(per.withColumn("score", F.lit(float("nan"))))


# --- projections, filters, distances ------------------------------------------------------------


@query
def engineered_features(spark, sf_dir):
    t = txn(spark, sf_dir)
    return rounded(fe.build_features(t, ["row_id"], time="time_s", amount="amount"))


@query
def cyclic_phase(spark, sf_dir):
    return rounded(feat(spark, sf_dir).select("row_id", fe.cyclic_phase().alias("phase")), 5)


@query
def isolated_labels(spark, sf_dir):
    _, labels = cleaning.isolate_label(txn(spark, sf_dir), "class")
    return labels


@query
def chosen_clusters(spark, sf_dir):
    sub = cleaning.labelled_subset(feat(spark, sf_dir), ["error", "click"], "grp", ("rare", 1))
    return sub.select("row_id", "grp", "rare")


@query
def distance_metrics(spark, sf_dir):
    """Every row's distance to its own cluster centre under each registered metric."""
    e = emb(spark, sf_dir)
    c = geometry.Centroids.fit(e)
    # ten centres of 64 numbers, checked when they were fitted
    joined = e.join(F.broadcast(c.table(spark).select("cluster", "centroid")), "cluster")
    cols = [get_distance(m)(F.col("features"), F.col("centroid")).alias(m) for m in ("euclidean", "manhattan", "cosine")]
    return rounded(joined.select("row_id", *cols))


@query
def mahalanobis(spark, sf_dir):
    li = pack(lines(spark, sf_dir), ["l_quantity", "l_extendedprice"], "l_returnflag")
    m = geometry.fit_moments(li)
    d = get_distance("mahalanobis", geometry.inverse_covariance(m))(F.col("features"), literal_vector(m.mean))
    return rounded(li.groupBy("l_returnflag").agg(F.avg(d).alias("mean_distance"), F.max(d).alias("max_distance")))


@query
def covariance(spark, sf_dir):
    m = geometry.fit_moments(pack(lines(spark, sf_dir), LINE_FEATURES))
    cov = m.covariance()
    rows = [(i, j, float(cov[i, j])) for i in range(len(cov)) for j in range(i, len(cov))]
    return rounded(spark.createDataFrame(rows, "i int, j int, cov double"), 3)


# --- duplicates, sets, samples --------------------------------------------------------------------


@query
def dedupe_rows(spark, sf_dir):
    return cleaning.drop_exact_duplicates(views.copies(spark, sf_dir))


@query
def dedupe_stats(spark, sf_dir):
    raw = views.copies(spark, sf_dir)
    return cleaning.cleaning_stats(raw, cleaning.drop_exact_duplicates(raw), "o_orderstatus", "F")


@query
def label_counts(spark, sf_dir):
    e = emb(spark, sf_dir).withColumn("cluster", F.when(F.col("cluster") == 0, -1).otherwise(F.col("cluster")))
    return cleaning.label_counts(e)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("class"))


@query
def strat_sample(spark, sf_dir):
    return sampling.stratified_sample(_orders(spark, sf_dir), 700, seed=3)


@query
def simple_sample(spark, sf_dir):
    return sampling.simple_sample(_orders(spark, sf_dir), 500, seed=4)


@query
def quota_sample(spark, sf_dir):
    return sampling.quota_sample(_orders(spark, sf_dir), {"F": 300, "P": 40}, seed=5)


@query
def sample_union(spark, sf_dir):
    o = _orders(spark, sf_dir)
    a, b = (sampling.quota_sample(o, {c: 100}, seed=6) for c in ("F", "O"))
    return cleaning.union_samples(a, b)


@query
def strat_split(spark, sf_dir):
    return sampling.stratified_split(_orders(spark, sf_dir), 0.3, seed=7)


@query
def bootstrap_rows(spark, sf_dir):
    return sampling.bootstrap_rows(_orders(spark, sf_dir), replicates=2, fraction=0.5, seed=8)


@query
def common_draws(spark, sf_dir):
    o = _orders(spark, sf_dir)
    b = sampling.bootstrap_rows(o, replicates=2, fraction=0.4, seed=9).join(o, "row_id")
    b = checkpoint(b.select("replicate", "row_id", F.col("class").alias("cluster")))
    return cleaning.common_draws(b.where("replicate = 0"), b.where("replicate = 1"))


@query
def temporal_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("t")
    )
    return sampling.temporal_split(o, "t", fraction=0.4).select("row_id", "half")


@query
def top_per_group(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return profiles.top_per_group(o, "o_orderpriority", 10, F.desc("o_totalprice"), F.col("o_orderkey"))


# --- joins and neighbours -------------------------------------------------------------------------


@query
def aligned_rows(spark, sf_dir):
    """Features and isolated labels brought back together on identity."""
    features, labels = cleaning.isolate_label(feat(spark, sf_dir), "class")
    joined = features.join(labels, "row_id")
    return rounded(joined.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.avg("log_amount").alias("mean_amount")))


@query
def nearest_centroid(spark, sf_dir):
    e = emb(spark, sf_dir)
    out = geometry.assign_nearest(e, geometry.Centroids.fit(e))
    return rounded(out.select("row_id", "assigned_cluster", "distance_to_centroid"))


@query
def centroid_rank(spark, sf_dir):
    e = emb(spark, sf_dir)
    return rounded(geometry.centroid_ranking(e, geometry.Centroids.fit(e)))


@query
def centroids(spark, sf_dir):
    c = geometry.Centroids.fit(emb(spark, sf_dir)).table(spark)
    long = c.select("cluster", "size", F.posexplode("centroid").alias("dim", "value"))
    return rounded(long.withColumn("dim", (F.col("dim") + 1).cast("bigint")))


@query
def pairwise_distance(spark, sf_dir):
    """All row pairs, summarised per pair of clusters."""
    p = pairs.pair_summary(emb(spark, sf_dir))
    return rounded(p.select("cluster_a", "cluster_b", "pairs", (F.col("total") / F.col("pairs")).alias("mean"), "nearest", "farthest"))


@query
def pairwise_manhattan(spark, sf_dir):
    p = pairs.pair_summary(emb(spark, sf_dir), metric="manhattan", extremes=False)
    return rounded(p.select("cluster_a", "cluster_b", "pairs", (F.col("total") / F.col("pairs")).alias("mean")))


@query
def knn(spark, sf_dir):
    return rounded(pairs.self_neighbours(emb(spark, sf_dir), 2))


# --- scaling, reduction, tendency -------------------------------------------------------------------


def _scale(spark, sf_dir, strategy):
    out = fe.scale(feat(spark, sf_dir), strategy, ["k25"], ["log_amount", "time_sin", "time_cos"], "row_id")
    return rounded(out)


@query
def scale_standard(spark, sf_dir):
    return _scale(spark, sf_dir, "standard")


@query
def scale_robust(spark, sf_dir):
    return _scale(spark, sf_dir, "robust")


@query
def scale_hybrid(spark, sf_dir):
    return _scale(spark, sf_dir, "hybrid")


@query
def scaling_compare(spark, sf_dir):
    return rounded(fe.compare_scalings(feat(spark, sf_dir), ["k25"], ["log_amount", "time_sin", "time_cos"]))


@query
def pca_curve(spark, sf_dir):
    return rounded(geometry.variance_curve(spark, geometry.fit_pca(emb(spark, sf_dir))))


@query
def pca_projection(spark, sf_dir):
    """Scores on the kept axes; their variances are the leading eigenvalues."""
    e = emb(spark, sf_dir)
    long = geometry.fit_pca(e, 5).project(e).select(F.posexplode("features").alias("axis", "score"))
    return rounded(long.groupBy("axis").agg(F.avg("score").alias("mean"), F.var_samp("score").alias("variance")))


@query
def total_variance(spark, sf_dir):
    m = geometry.fit_pca(emb(spark, sf_dir))
    return rounded(geometry.one_row(spark, total=float(m.variance.sum())))


@query
def hopkins(spark, sf_dir):
    f = feat_vectors(spark, sf_dir)
    return rounded(geometry.one_row(spark, hopkins=tendency.hopkins(f, sample_size=300, seed=1)))


@query
def hopkins_repeated(spark, sf_dir):
    out = rounded(tendency.repeated_hopkins(checkpoint(feat_vectors(spark, sf_dir)), repeats=3, sample_size=300))
    return out.withColumn("hopkins_values", F.transform("hopkins_values", lambda v: F.round(v, 6)))


@query
def hopkins_null(spark, sf_dir):
    return rounded(tendency.null_control(feat_vectors(spark, sf_dir), repeats=2, sample_size=300))


@query
def density_grid(spark, sf_dir):
    return geometry.density_grid(feat(spark, sf_dir), "log_amount", "time_sin", 60)


@query
def vat_order(spark, sf_dir):
    """The picture's order over prototypes of the whole table."""
    protos = linkage.prototypes(feat_vectors(spark, sf_dir), m=128)
    return tendency.vat_order(tendency.prototype_rows(spark, protos))


@query
def vat_image(spark, sf_dir):
    rows = tendency.prototype_rows(spark, linkage.prototypes(feat_vectors(spark, sf_dir), m=64))
    return rounded(tendency.reordered_image(rows, tendency.vat_order(rows)))


# --- clustering ----------------------------------------------------------------------------------

KS = [2, 3, 4, 5, 6]
RULES = (3.0, 1.0, 0.25)  # cuts of a small tree over log_amount, k25 and time_sin
STEPS = 5


def _vectors(spark, sf_dir, *keep):
    return checkpoint(feat_vectors(spark, sf_dir, *keep))


@query
def kmeans_steps(spark, sf_dir):
    """Five Lloyd updates from the lowest-hash rows, then each cluster's size and centre."""
    fit = kmeans.fit_fixed(_vectors(spark, sf_dir), [4], steps=STEPS)[4]
    c = kmeans.centers_table(spark, fit)
    return rounded(c.select("cluster", "size", *[F.col("centroid")[i].alias(n) for i, n in enumerate(FEATURES)]))


@query
def inertia_by_k(spark, sf_dir):
    fits = kmeans.fit_fixed(_vectors(spark, sf_dir), KS, steps=STEPS)
    rows = [(k, f.inertia, kmeans.log_inertia(f.inertia)) for k, f in fits.items()]
    return rounded(spark.createDataFrame(rows, "k int, inertia double, log_inertia double"), 5, inertia=3)


@query
def elbow(spark, sf_dir):
    fits = kmeans.fit_fixed(_vectors(spark, sf_dir), KS, steps=STEPS)
    return choose_k.choices_table(spark, [choose_k.by_elbow(fits)]).where("recommended").select("method", "k")


@query
def silhouette_by_k(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    fits = kmeans.fit_fixed(df, [2, 3, 4], steps=STEPS)
    choice = choose_k.by_silhouette(df, fits, sample_size=400, seed=2)
    return rounded(choose_k.choices_table(spark, [choice]).select("k", "score", "recommended"), 5)


@query
def k_selection(spark, sf_dir):
    """All five criteria over shared sweeps, and the vote."""
    df = _vectors(spark, sf_dir)
    fits = choose_k.sweep(df, [2, 3, 4, 5])
    choices = [
        choose_k.by_elbow(fits),
        choose_k.by_silhouette(df, fits, sample_size=1000),
        choose_k.by_gap(df, fits, n_refs=2, n_init=3),
        choose_k.by_bic(df, fits),
        choose_k.by_bootstrap(df, [2, 3, 4, 5], n_resamples=4),
    ]
    t = choose_k.choices_table(spark, choices)
    # at most one row per candidate k
    return rounded(t.join(F.broadcast(choose_k.consensus_k(t)), "k", "left"))


@query
def kmeans_fit(spark, sf_dir):
    fit = kmeans.fit_kmeans(_vectors(spark, sf_dir), 4, n_init=10)
    return rounded(kmeans.centers_table(spark, fit).select("cluster", "size"))


@query
def gmm_covariance(spark, sf_dir):
    return rounded(mixture.compare_covariances(_vectors(spark, sf_dir), 3), 3)


@query
def gmm_labels(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    return cleaning.label_counts(mixture.fit_mixture(df, 3).labels(df))


@query
def ward_labels(spark, sf_dir):
    return cleaning.label_counts(linkage.fit_agglomerative(_vectors(spark, sf_dir), 4))


@query
def linkage_compare(spark, sf_dir):
    return rounded(linkage.compare_linkages(_vectors(spark, sf_dir), 4))


@query
def silhouette_cut(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    labels, _, _ = linkage.cut_by_silhouette(df, linkage.fit_linkage(df), [2, 3, 4])
    return cleaning.label_counts(labels)


@query
def metric_ablation(spark, sf_dir):
    return rounded(linkage.metric_ablation(_vectors(spark, sf_dir), 3))


def _supplier_trees(spark, sf_dir):
    """Trees of all suppliers; most merges are made in rounds, the last ones from a matrix."""
    df = checkpoint(suppliers(spark, sf_dir))
    return df, {name: merging.fit_tree(df, linkage=name, finish=48) for name in linkage.LINKAGES}


def _all_linkages(trees, table):
    parts = [table(t).withColumn("linkage", F.lit(name)) for name, t in trees.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def linkage_labels(spark, sf_dir):
    """Four groups of suppliers by each linkage, numbered by their smallest member."""
    _, trees = _supplier_trees(spark, sf_dir)
    return _all_linkages(trees, lambda t: t.labels(4)).select("linkage", "row_id", "cluster")


@query
def linkage_heights(spark, sf_dir):
    """The height of every merge, lowest first."""
    _, trees = _supplier_trees(spark, sf_dir)
    w = Window.partitionBy("linkage").orderBy("height")
    return rounded(_all_linkages(trees, lambda t: t.merges()).select("linkage", F.row_number().over(w).alias("step"), "height"))


@query
def linkage_cut_heights(spark, sf_dir):
    """Groups of suppliers left at three heights, as shares of the tallest merge."""
    _, trees = _supplier_trees(spark, sf_dir)

    def cuts(t):
        top = t.tallest(1)[0]
        groups = t.groups_at([top * f for f in (0.2, 0.5, 0.9)])
        return groups.select(F.posexplode("groups").alias("cut", "g")).groupBy("cut").agg(F.countDistinct("g").alias("n_groups"))

    return _all_linkages(trees, cuts).select("linkage", "cut", "n_groups")


@query
def linkage_fidelity(spark, sf_dir):
    """Cophenetic correlation over all pairs of suppliers."""
    _, trees = _supplier_trees(spark, sf_dir)
    rows = [(name, t.cophenetic_correlation()) for name, t in trees.items()]
    return rounded(spark.createDataFrame(rows, "linkage string, cophenetic_corr double"))


@query
def linkage_distances(spark, sf_dir):
    """Smallest, largest and mean distance between the classes of embeddings."""
    df = checkpoint(emb(spark, sf_dir))
    tables = [
        merging.cluster_distances(df, linkage=name).withColumnRenamed("height", name) for name in ("single", "complete", "average")
    ]
    return rounded(tables[0].join(tables[1], ["a", "b"]).join(tables[2], ["a", "b"]))


@query
def hdbscan(spark, sf_dir):
    """Density clusters of all embeddings with their stability; copies of noise stay noise."""
    return rounded(density.fit_density(emb(spark, sf_dir), min_cluster_size=5).clusters)


@query
def hdbscan_labels(spark, sf_dir):
    return cleaning.label_counts(density.fit_density(emb(spark, sf_dir), min_cluster_size=5, min_samples=2).labels)


# --- scores ----------------------------------------------------------------------------------------


@query
def contingency_table(spark, sf_dir):
    return contingency.contingency(lines(spark, sf_dir), "l_linestatus", "l_returnflag")


@query
def external_scores(spark, sf_dir):
    cells = contingency.contingency(lines(spark, sf_dir), "l_linestatus", "l_returnflag")
    return rounded(contingency.external_scores(cells), 8)


@query
def external_by_group(spark, sf_dir):
    """The same scores within every event group, against the tens digit."""
    t = txn(spark, sf_dir).select("grp", F.expr("k div 25").alias("p"), F.expr("cast(floor(time_s / 3600) as bigint) % 4").alias("t"))
    return rounded(contingency.external_scores(contingency.contingency(t, "t", "p", ["grp"]), ["grp"], ami=False))


def _runs(spark, sf_dir):
    t = txn(spark, sf_dir)
    cells = [
        F.struct(F.lit(n).alias("run"), c.cast("bigint").alias("cluster"))
        for n, c in (
            ("class", F.col("class")),
            ("hours", F.floor(F.col("time_s") / 3600)),
            ("tens", F.expr("k div 10")),
        )
    ]
    return t.select("row_id", F.inline(F.array(*cells)))


@query
def agreement(spark, sf_dir):
    return rounded(contingency.agreement(_runs(spark, sf_dir)), 8)


@query
def silhouette_mean(spark, sf_dir):
    return rounded(inner.silhouette(emb(spark, sf_dir)))


@query
def silhouette_rows(spark, sf_dir):
    return rounded(inner.silhouette_rows(emb(spark, sf_dir)))


@query
def silhouette_squared(spark, sf_dir):
    return rounded(inner.silhouette_squared(emb(spark, sf_dir)))


@query
def davies_bouldin(spark, sf_dir):
    return rounded(inner.davies_bouldin(emb(spark, sf_dir)), 5)


@query
def calinski_harabasz(spark, sf_dir):
    return rounded(inner.calinski_harabasz(emb(spark, sf_dir)), 5)


@query
def dunn(spark, sf_dir):
    return rounded(inner.dunn(emb(spark, sf_dir)))


@query
def error_analysis(spark, sf_dir):
    e = emb(spark, sf_dir).withColumn("y", F.when(F.col("cluster") >= 5, 1).otherwise(0))
    out = runs.error_analysis(e, label="y", n_worst=50, sample_size=None)
    counts = F.transform(F.map_entries("per_cluster_counts"), lambda x: F.concat_ws(":", x["key"], x["value"]))
    return rounded(out.withColumn("per_cluster_counts", F.array_join(counts, ",")))


@query
def ranked_scores(spark, sf_dir):
    """Groups ranked on a score that is undefined for some of them; those come last."""
    per = txn(spark, sf_dir).groupBy("grp").agg(
        F.when(F.max("class") == 1, F.lit(float("nan"))).otherwise(F.avg("amount")).alias("score")
    )
    # a handful of groups; the score is shown as null where it is undefined
    places = ranking.rank_runs(per, "score", True).agg(F.collect_list(F.struct("grp", "score")).alias("all"))
    ranked = places.select(F.posexplode("all").alias("place", "run"))
    return rounded(ranked.select("run.grp", F.nanvl("run.score", F.lit(None)).alias("score"), "place"))


@query
def coassociation(spark, sf_dir):
    """How many row pairs share how many of five hashed labellings, drawn with gaps."""
    e = emb(spark, sf_dir)
    labels = F.array(
        *[
            F.when(u01("row_id", "drawn", r) >= 0.3, F.floor(u01("row_id", "lab", r) * 3).cast("int"))
            for r in range(5)
        ]
    )
    return stability.co_association_counts(e.withColumn("labels", labels))


@query
def consensus(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    labels = stability.resample_labels(df, 3, n_resamples=8, fraction=0.8, max_n=500)
    return cleaning.label_counts(stability.consensus_labels(labels, 3))


@query
def seed_stability(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    return rounded(geometry.one_row(spark, mean_ari=stability.seed_stability("kmeans", df, 4, n_seeds=5)))


def _labelled(spark, sf_dir):
    return lines(spark, sf_dir).select(
        F.col("l_linestatus").alias("class"), F.col("l_returnflag").alias("cluster"), F.col("l_linestatus").alias("a"),
        F.col("l_returnflag").alias("b"),
    )


@query
def bootstrap_ci(spark, sf_dir):
    return rounded(significance.bootstrap_ci(_labelled(spark, sf_dir), "ari", replicates=500))


@query
def permutation(spark, sf_dir):
    return rounded(significance.permutation_test(_labelled(spark, sf_dir), "nmi", permutations=500), 8)


@query
def compare_models(spark, sf_dir):
    return rounded(significance.compare_models(_labelled(spark, sf_dir), "purity", replicates=500))


# --- representation learning -----------------------------------------------------------------------


def _soft(spark, sf_dir):
    e = emb(spark, sf_dir)
    c = geometry.Centroids.fit(e)
    return soft.target_arrays(soft.soft_arrays(e, c), len(c.ids)), c


@query
def soft_assign(spark, sf_dir):
    s, c = _soft(spark, sf_dir)
    return rounded(soft.long_form(s, c, "q", "p"), 8)


@query
def soft_labels(spark, sf_dir):
    s, c = _soft(spark, sf_dir)
    return soft.hard_labels(s, c)


@query
def kl_loss(spark, sf_dir):
    s, _ = _soft(spark, sf_dir)
    return rounded(soft.divergence(s), 8)


@query
def batch_neighbours(spark, sf_dir):
    return soft.batch_neighbours(emb(spark, sf_dir), batch_rows=128)


@query
def contrastive_loss(spark, sf_dir):
    return rounded(soft.batch_contrastive_loss(emb(spark, sf_dir), batch_rows=128, n_negatives=16))


_SMALL = {"latent": 8, "hidden": (32,), "batch": 64}


@query
def autoencoder(spark, sf_dir):
    e = emb(spark, sf_dir)
    shards = deep.make_shards(e)
    net, losses = deep.train_autoencoder(shards, epochs=20, **_SMALL)
    err = F.aggregate(F.zip_with("features", "back", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    both = e.select("row_id", "features").join(deep.reconstruct(e, net).withColumnRenamed("features", "back"), "row_id")
    return rounded(both.agg(F.avg(err).alias("squared_error"), F.lit(losses[0]).alias("first"), F.lit(losses[-1]).alias("last")))


@query
def ae_kmeans(spark, sf_dir):
    e = emb(spark, sf_dir)
    return cleaning.label_counts(deep.fit_ae_kmeans(e, 4, ae_epochs=10, ft_epochs=5, **_SMALL).labels(e))


@query
def dec(spark, sf_dir):
    e = emb(spark, sf_dir)
    return cleaning.label_counts(deep.fit_dec(e, 4, init_epochs=10, dec_epochs=6, **_SMALL).labels(e))


@query
def dec_contrastive(spark, sf_dir):
    e = emb(spark, sf_dir)
    return cleaning.label_counts(deep.fit_dec_contrastive(e, 4, init_epochs=10, dec_epochs=6, **_SMALL).labels(e))


# --- interpretation ----------------------------------------------------------------------------------


@query
def cluster_profiles(spark, sf_dir):
    f = feat(spark, sf_dir).withColumnRenamed("grp", "cluster")
    return rounded(profiles.cluster_profiles(f, FEATURES, F.col("rare")))


@query
def domain_labels(spark, sf_dir):
    f = feat(spark, sf_dir).withColumnRenamed("k", "cluster")
    p = profiles.cluster_profiles(f, ["log_amount", "time_sin", "time_cos"], F.col("class"))
    return rounded(profiles.domain_labels(p, f.agg(F.avg("class")).scalar()))


@query
def feature_means(spark, sf_dir):
    return rounded(profiles.feature_means(feat(spark, sf_dir).withColumn("cluster", F.col("k") - 1), FEATURES, F.col("class")))


@query
def feature_summary(spark, sf_dir):
    return rounded(profiles.feature_summary(lines(spark, sf_dir), LINE_FEATURES), 4)


@query
def overview(spark, sf_dir):
    f = feat(spark, sf_dir).withColumn("cluster", F.col("k") - 1)
    return rounded(profiles.overview(f, FEATURES, F.col("class")))


@query
def exemplars(spark, sf_dir):
    return rounded(profiles.exemplars(emb(spark, sf_dir), sample_size=None))


def _tree(spark, sf_dir):
    """A tree that mimics a clustering of all events."""
    df = _vectors(spark, sf_dir)
    fit = kmeans.fit_fixed(df, [4], steps=STEPS)[4]
    labelled = checkpoint(fit.labels(df, "row_id", "features"))
    return labelled, surrogate.fit_surrogate(labelled, FEATURES)


@query
def tree_rules(spark, sf_dir):
    return rounded(surrogate.tree_rules(spark, _tree(spark, sf_dir)[1]))


@query
def tree_fidelity(spark, sf_dir):
    return rounded(surrogate.fidelity(*_tree(spark, sf_dir)))


@query
def shap_importance(spark, sf_dir):
    return rounded(surrogate.shap_importance(*_tree(spark, sf_dir)))


@query
def counterfactuals(spark, sf_dir):
    """For every event outside cluster 0, the nearest changed copies that would land there."""
    df, tree = _tree(spark, sf_dir)
    found = surrogate.counterfactuals(df.where("cluster <> 0"), tree, 0, tendency.box_of(df))
    return rounded(found.groupBy("found", "rank").agg(F.count(F.lit(1)).alias("n"), F.avg("distance").alias("distance")))


@query
def counterfactual_rules(spark, sf_dir):
    """The same for a tree of known rules, with k25 kept as it is."""
    df = _vectors(spark, sf_dir)
    paths = [
        ((0, True, RULES[0]), (3, True, RULES[1])), ((0, True, RULES[0]), (3, False, RULES[1])),
        ((0, False, RULES[0]), (1, True, RULES[2])), ((0, False, RULES[0]), (1, False, RULES[2])),
    ]
    leaves = tuple(surrogate.Leaf(i, p, np.eye(2)[c]) for i, (p, c) in enumerate(zip(paths, (0, 1, 1, 0))))
    tree = surrogate.SurrogateTree((0, 1), tuple(FEATURES), leaves)
    found = surrogate.counterfactuals(df, tree, 1, [(0.0, 1.0)] * 4, vary=FEATURES[:3])
    return rounded(found.select("row_id", "found", "rank", "distance"))


# --- downstream, audit, drift -----------------------------------------------------------------------


@query
def centroid_distance(spark, sf_dir):
    """Distance to the own centroid; label 0 plays noise and is measured against the nearest one."""
    e = emb(spark, sf_dir).withColumn("cluster", F.when(F.col("cluster") == 0, F.lit(-1)).otherwise(F.col("cluster")))
    return rounded(downstream.centroid_distances(e).select("row_id", "distance"))


@query
def anomaly_ranking(spark, sf_dir):
    """The flagged rows themselves."""
    scored = downstream.centroid_distances(_scaled_groups(spark, sf_dir)).select("row_id", "class", "distance")
    return rounded(downstream.flag_top(checkpoint(scored)).where("flagged").select("row_id", "class", "distance"))


@query
def ranking_by_group(spark, sf_dir):
    t = lines(spark, sf_dir).withColumn("y", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return rounded(ranking.ranking_scores(t, "l_quantity", "y", ["l_linestatus"]))


@query
def conditional_split(spark, sf_dir):
    f = feat(spark, sf_dir).select("row_id", F.col("k").cast("bigint").alias("cluster"), "class")
    return downstream.conditional_bookkeeping(sampling.stratified_split(f, 0.3, strata="class", seed=11))


@query
def conditional_model(spark, sf_dir):
    f = _vectors(spark, sf_dir, F.expr("k div 25").alias("cluster"), "class")
    return rounded(downstream.conditional_modelling(f)[0])


@query
def quantile_strata(spark, sf_dir):
    out = audit.quantile_strata(feat(spark, sf_dir), "log_amount")
    return out.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"))


def _composition(spark, sf_dir):
    f = audit.quantile_strata(lines(spark, sf_dir), "l_extendedprice").withColumnRenamed("l_returnflag", "cluster")
    return audit.composition(f)


@query
def composition(spark, sf_dir):
    return rounded(_composition(spark, sf_dir))


@query
def composition_audit(spark, sf_dir):
    f = audit.quantile_strata(lines(spark, sf_dir), "l_extendedprice")
    f = f.withColumn("cluster", F.floor(F.col("l_quantity") / 10).cast("int"))
    a = audit.composition_audit(audit.composition(f), attribute="l_extendedprice", threshold=1.05)
    return rounded(a.withColumn("concentrated_clusters", F.array_join("concentrated_clusters", ",")))


@query
def preprocessing_sensitivity(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    ref = kmeans.fit_kmeans(df, 4).labels(df)
    f = feat(spark, sf_dir)
    std = pack(fe.scale(f, "standard", FEATURES, [], "row_id"), FEATURES, "row_id")
    variants = {
        "pca": (geometry.fit_pca(df).project(df), "principal axes"),
        "standard": (std, "all features standardised"),
    }
    return rounded(audit.preprocessing_sensitivity(variants, ref, 4))


@query
def psi(spark, sf_dir):
    return rounded(drift.stability_index(*views.halves(spark, sf_dir), LINE_FEATURES))


@query
def ks(spark, sf_dir):
    return rounded(drift.two_sample_ks(*views.halves(spark, sf_dir), LINE_FEATURES))


def _drifts(spark, sf_dir):
    early, late = views.halves(spark, sf_dir)
    # a known shift, so that something is flagged
    late = late.withColumn("l_tax", F.col("l_tax") * 1.5 + 0.01)
    return drift.feature_drift(early, late, LINE_FEATURES)


@query
def feature_drift(spark, sf_dir):
    return rounded(_drifts(spark, sf_dir))


@query
def drift_report(spark, sf_dir):
    r = drift.drift_report(_drifts(spark, sf_dir))
    return rounded(r.withColumn("drifted_features", F.array_join("drifted_features", ",")))


# --- registry ---------------------------------------------------------------------------------------


@query
def registry_id(spark, sf_dir):
    """Content ids of one model card per event group."""
    per = txn(spark, sf_dir).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"))
    params = F.format_string('{"k": %d, "n": %d}', "k", "n")
    return per.select("grp", registry.entry_id_column(F.col("grp"), F.lit("v1"), params).alias("entry_id"))


@query
def registry_latest(spark, sf_dir):
    """Every event registers a card of its user and type; the last registration wins."""
    e = table(spark, sf_dir, "events")
    cards = e.select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("entry_id"),
        F.col("event_type").alias("name"),
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("registered_at"),
        F.col("user_id").cast("string").alias("fit_date"),
        "event_id",
    )
    return registry.latest_cards(cards).select("entry_id", "name", "event_id")


@query
def registry_store(spark, sf_dir):
    """Register a fitted model twice, load its centroids back."""
    df = _vectors(spark, sf_dir)
    fit = kmeans.fit_fixed(df, [3], steps=2)[3]
    root = scratch_path(spark, "registry")
    card = None
    for note in ("first", "second"):
        card = registry.register_model(
            spark, root, name="events-kmeans", algorithm="kmeans", k=3, data_version="v1", n_rows=int(fit.sizes.sum()), n_features=len(FEATURES),
            feature_space="engineered", params={"k": 3, "steps": 2}, metrics={"inertia": fit.inertia}, seeds={"init": 0},
            artifact=kmeans.centers_table(spark, fit), notes=note, fit_date="2026-01-01T00:00:00+00:00",
        )
    stored = registry.load_artifact(spark, root, card["entry_id"])
    notes = registry.list_models(spark, root).select("notes").first()["notes"]
    centre = [F.col("centroid")[i].alias(n) for i, n in enumerate(FEATURES)]
    return rounded(stored.select("cluster", "size", *centre, F.lit(notes).alias("notes")))


# --- streams -----------------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    """The events file as a stream; one file, so one batch."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return raw.select(
        F.col("event_id").alias("row_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("amount"), "event_type",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


@query
def stream_scoring(spark, sf_dir):
    """Events scored against group centroids as they arrive."""
    f = feat(spark, sf_dir)
    base = pack(f, ["log_amount", "k25"], "row_id", F.col("grp").alias("cluster"))
    c = geometry.Centroids.fit(base)
    s = _event_stream(spark, sf_dir)
    s = s.select("row_id", stream_assign.feature_vector(F.log1p("amount"), F.col("k") / 25.0).alias("features"))
    out, progress = scratch_path(spark, "scored"), scratch_path(spark, "scored-progress")
    stream_assign.run_to_table(stream_assign.score_stream(s, c, threshold=2.0), out, progress)
    got = spark.read.parquet(out)
    return rounded(got.select("row_id", "assigned_cluster", "distance_to_centroid", "anomalous"))


@query
def stream_monitor(spark, sf_dir):
    """Daily stability index of arriving events against the shares of the whole table."""
    t = txn(spark, sf_dir)
    edges = {c: audit.distinct_edges(q) for c, q in exact_quantiles(t, ["amount", "k"], [i / 4 for i in range(5)]).items()}
    counts = {f: [0] * (len(e) - 1) for f, e in edges.items()}
    for r in drift.bin_counts(t, edges, "ref").collect():  # features x bins
        counts[r["feature"]][r["bin"]] = r["ref"]
    watched = stream_drift.windowed_drift(_event_stream(spark, sf_dir), edges, stream_drift.reference_shares(counts))
    out, progress = scratch_path(spark, "drift"), scratch_path(spark, "drift-progress")
    stream_assign.run_to_table(watched, out, progress)
    got = spark.read.parquet(out)
    return rounded(got.select(F.unix_seconds("window_start").alias("window_start"), "rows", "feature", "psi", "drifted"))




# --- whole compositions --------------------------------------------------------------------------------

_BRIEF = Settings(
    hopkins_probes=200, hopkins_repeats=2, vat_prototypes=64, ks=(2, 3), n_init=3, full_algorithms=("kmeans",),
    sample_algorithms=("ward", "gmm", "hdbscan"), options={"hdbscan": {"min_cluster_size": 25, "min_samples": 5}},
    portfolio_n=1000, k_selection_n=1000, silhouette_sample=500, gap_refs=1, resamples=3, n_seeds=2, consensus_n=200, n_worst=50,
)


def _prepared(spark, sf_dir, out):
    t = txn(spark, sf_dir)
    return prepare.prepare_tables(
        t.select("row_id", F.col("k").cast("double").alias("k"), "time_s", "amount", "class"), out, columns=["k"], time="time_s",
        amount="amount", label="class", settings=_BRIEF,
    )


@query
def prepared_tables(spark, sf_dir):
    """All events, from raw rows to reduced features; one line per stored table."""
    return prepare.row_counts(_prepared(spark, sf_dir, scratch_path(spark, "prepared")))


@query
def portfolio_comparison(spark, sf_dir):
    """Fits on all events and on a shared sample, scored side by side."""
    f = feat_vectors(spark, sf_dir, "class")
    out = portfolio.compare_portfolio(f.drop("class"), f.select("row_id", "class"), scratch_path(spark, "portfolio"), _BRIEF)
    return rounded(out["performance"].drop("runtime_s"))


@query
def deep_comparison(spark, sf_dir):
    """Learned representations against an earlier winner, trained to their end on the same rows of a sample."""
    f = checkpoint(feat_vectors(spark, sf_dir, "class"))
    settings = Settings()
    earlier = kmeans.fit_kmeans(f, 2, n_init=settings.n_init).labels(f)
    clock = txn(spark, sf_dir).select("row_id", F.col("time_s").alias("time"))
    out = deep_audit.deep_and_audit(
        f.drop("class"), f.select("row_id", "class"), FEATURES, earlier, clock, scratch_path(spark, "deep"), settings
    )
    return rounded(out["track"].drop("runtime_s"))
