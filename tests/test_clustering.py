import numpy as np
import pandas as pd
import pytest
from conftest import ari_of, blobs, frame
from pyspark.sql import functions as F

from kinfold.operators import algorithms, choose_k, density, internal_scores, kmeans, linkage, mixture, runs, stability


@pytest.fixture(scope="module")
def three(spark):
    x, y = blobs()
    return frame(spark, x, truth=y).cache()


@pytest.mark.parametrize("name", ["kmeans", "gmm", "ward", "hdbscan"])
def test_every_algorithm_recovers_blobs(three, name):
    labels = algorithms.fit_algorithm(name, three, 3, seed=1, min_cluster_size=10)
    assert ari_of(labels.join(three, "row_id")) > 0.95


def test_registry_contract(three):
    with pytest.raises(KeyError):
        algorithms.fit_algorithm("nope", three, 3)
    with pytest.raises(ValueError):
        algorithms.register("kmeans")(lambda df, k, seed: df)
    for fit in (kmeans.fit_kmeans, mixture.fit_mixture, linkage.fit_agglomerative):
        with pytest.raises(ValueError):
            fit(three, 1)


def test_kmeans_repeats_and_does_not_depend_on_partitions(three):
    a, b = kmeans.fit_kmeans(three, 3, seed=5), kmeans.fit_kmeans(three.repartition(7), 3, seed=5)
    assert np.allclose(a.centers, b.centers) and a.inertia == pytest.approx(b.inertia)


@pytest.mark.parametrize("method", linkage.LINKAGES)
def test_merge_tree_against_brute_force(method):
    x = np.random.default_rng(1).normal(size=(14, 2))
    tree = linkage.merge_tree(x, np.ones(14), method)
    groups = {i: [i] for i in range(14)}
    d = lambda a, b: {
        "single": lambda m: m.min(), "complete": lambda m: m.max(), "average": lambda m: m.mean(),
        "ward": lambda m: np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(x[a].mean(0) - x[b].mean(0)),
    }[method](np.linalg.norm(x[a][:, None] - x[b][None], axis=2))
    heights = []
    while len(groups) > 1:
        h, i, j = min((d(groups[i], groups[j]), i, j) for i in groups for j in groups if i < j)
        groups[i] = groups[i] + groups.pop(j)
        heights.append(h)
    assert np.allclose(sorted(heights), tree[:, 2])


def test_cuts():
    x = np.array([[0.0], [1.0], [10.0], [11.5]])
    tree = linkage.merge_tree(x, np.ones(4), "average")
    cuts = linkage.cut(tree, heights=[1.2, 0.0], fractions=[0.7], ks=[1, 2, 4, 9], merges=[0, 1, 3])
    assert cuts.sizes.tolist() == [3, 4, 2, 1, 2, 4, 4, 4, 3, 1]
    assert cuts.heights[2] == pytest.approx(0.7 * tree[-1, 2])
    assert cuts.groups[:, 0].tolist() == [0, 0, 1, 2] and cuts.groups[:, 2].tolist() == [0, 0, 1, 1]
    assert linkage.cut_to_k(tree, 2).tolist() == [0, 0, 1, 1]


def test_silhouettes_of_nested_cuts_equal_those_of_each_cut(three):
    fit = linkage.fit_linkage(three, m=40)
    _, best, scores = linkage.cut_by_silhouette(three, fit, [2, 3, 5, 8])
    got = {r["k"]: r["silhouette"] for r in scores.collect()}
    for k, v in got.items():
        alone = fit.labels(three, linkage.cut_to_k(fit.tree, k), "row_id", "features")
        assert v == pytest.approx(internal_scores.silhouette(alone).first()[0])
    assert best == 3 == max(got, key=got.get)


def test_more_centres_than_rows_are_refused(spark):
    rows = frame(spark, np.arange(6.0).reshape(3, 2))
    with pytest.raises(ValueError, match="exceeds"):
        kmeans.fit_kmeans(rows, 5)
    assert sorted(kmeans.fit_kmeans(rows, 3).sizes.tolist()) == [1, 1, 1]


def test_average_linkage_is_most_faithful(three):
    rows = {r["linkage"]: r for r in linkage.compare_linkages(three, 3).collect()}
    assert max(rows, key=lambda m: rows[m]["cophenetic_corr"]) == "average"
    assert sum(rows["ward"]["cluster_sizes"]) == 300
    assert set(r["linkage"] for r in linkage.compare_linkages(three, 3, metric="manhattan").collect()) == {"single", "complete", "average"}


def test_prototypes_stand_in_for_all_rows(three):
    labels = linkage.fit_agglomerative(three, 3, m=40)
    assert labels.count() == 300 and ari_of(labels.join(three, "row_id")) == 1.0


def test_cosine_differs_on_radial_data(spark):
    rng = np.random.default_rng(0)
    angle, radius = rng.choice([0.2, 1.2], 200) + rng.normal(0, 0.02, 200), rng.choice([1.0, 20.0], 200)
    df = frame(spark, np.c_[radius * np.cos(angle), radius * np.sin(angle)])
    rows = {r["metric"]: r["ari_vs_reference"] for r in linkage.metric_ablation(df, 2).collect()}
    assert rows["euclidean"] == 1.0 and rows["cosine"] < 0.9


def test_parameter_counts_of_mixtures():
    want = {"full": 869, "tied": 463, "diag": 113, "spherical": 59}
    for kind, n in want.items():
        m = mixture.Mixture(2, kind, np.ones(2) / 2, np.zeros((2, 28)), np.zeros((2, 28, 28)))
        assert m.n_parameters == n


def test_mixture_likelihood_is_the_density_of_its_parameters(three):
    m = mixture.fit_mixture(three, 3)
    x = np.array([r["features"] for r in three.select("features").collect()])
    dens = np.zeros(len(x))
    for w, mu, c in zip(m.weights, m.means, m.covariances):
        q = ((x - mu) @ np.linalg.inv(c) * (x - mu)).sum(1)
        dens += w * np.exp(-0.5 * q) / np.sqrt((2 * np.pi) ** x.shape[1] * np.linalg.det(c))
    assert m.log_likelihood == pytest.approx(np.log(dens).sum(), rel=1e-9)


@pytest.fixture(scope="module")
def dense_and_sparse(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (160, 2)), rng.uniform(-10, 10, (40, 2)), rng.normal(6, 0.3, (60, 2))])
    return frame(spark, x).cache()


def test_density_clusters_mark_noise_and_ignore_k(dense_and_sparse):
    a = density.fit_density(dense_and_sparse, min_cluster_size=15)
    noise = {r["row_id"] for r in a.labels.where("cluster = -1").collect()}
    assert a.n_clusters == 2 and 10 < len(noise & set(range(160, 200)))
    assert a.clusters.where("persistence > 0 and persistence <= 1").count() == 2


def test_density_in_rounds_equals_one_task(dense_and_sparse):
    df = dense_and_sparse.where("row_id < 90")
    a = density.fit_density(df, min_cluster_size=8)
    b = density.fit_density(df, min_cluster_size=8, finish_edges=80, block_rows=40, max_edges=200)
    pairs = a.labels.join(b.labels.withColumnRenamed("cluster", "other"), "row_id").select("cluster", "other").distinct().collect()
    assert len(pairs) == len({r["cluster"] for r in pairs}) == len({r["other"] for r in pairs})
    assert np.allclose(sorted(r["stability"] for r in a.clusters.collect()), sorted(r["stability"] for r in b.clusters.collect()))


def test_criteria_find_the_number_of_blobs(spark):
    x, _ = blobs(n=300, d=4, k=4, seed=3)
    df = frame(spark, x).cache()
    fits = choose_k.sweep(df, [2, 3, 4, 5, 6])
    choices = [choose_k.by_elbow(fits), choose_k.by_silhouette(df, fits), choose_k.by_gap(df, fits, n_refs=2), choose_k.by_bic(df, fits)]
    picked = choose_k.consensus_k(choose_k.choices_table(spark, choices)).where("chosen").first()["k"]
    assert picked == 4 and choices[1].recommended == 4
    boot = choose_k.by_bootstrap(df, [4, 6], n_resamples=4)
    assert boot.scores[4] > boot.scores[6] - 1e-9 and boot.scores[4] > 0.95


def test_gap_rule_and_flat_curves():
    c = choose_k.gap_choice({2: 5.0, 3: 2.0, 4: 1.9}, {2: [5.5, 5.6], 3: [5.0, 5.1], 4: [4.8, 4.9]})
    assert c.recommended == 3
    assert choose_k.elbow_point({2: 5.0, 3: 5.0, 4: 5.0}) == 2
    assert np.isfinite(kmeans.log_inertia(0.0))


def test_identical_points_keep_the_sweep_finite(spark):
    df = frame(spark, np.ones((40, 2)))
    fits = choose_k.sweep(df, [2, 3])
    assert all(np.isfinite(choose_k.by_gap(df, fits, n_refs=1).scores[k]) for k in (2, 3))


def test_stability_and_consensus(three):
    assert stability.seed_stability("kmeans", three, 3, n_seeds=1) == 1.0
    assert stability.seed_stability("kmeans", three, 3, n_seeds=4) > 0.95
    labels = stability.resample_labels(three, 3, n_resamples=6, fraction=0.8, max_n=120)
    consensus = stability.consensus_labels(labels, 3)
    assert consensus.count() == 120 and ari_of(consensus.join(three, "row_id")) > 0.9


def test_runs_score_compare_and_rank(spark, three):
    good = runs.run_algorithm("kmeans", three, 3)
    flat = runs.record("flat", 1, three.select("row_id", F.lit(0).alias("cluster")), 0.0)
    truth = three.select("row_id", F.col("truth").alias("class"))
    for r in (good, flat):
        runs.score_run(r, three, truth)
    assert np.isnan(flat.scores["silhouette"]) and good.scores["ari"] == 1.0
    assert [r.algorithm for r in runs.rank([flat, good], "davies_bouldin")] == ["kmeans", "flat"]
    matrix = {(r["run_a"], r["run_b"]): r["ari"] for r in runs.agreement_matrix([good, flat]).collect()}
    assert len(matrix) == 4 and matrix[good.name, good.name] == 1.0
    other = runs.record("kmeans", 3, three.select("row_id", (F.col("row_id") % 3).alias("cluster")), 0.0)
    matrix = {(r["run_a"], r["run_b"]): r["ari"] for r in runs.agreement_matrix([good, other]).collect()}
    assert len(matrix) == 4 and abs(matrix[good.name, f"{good.name}#2"]) < 0.2  # same name, other labels
    err = runs.error_analysis(three.join(good.labels, "row_id"), label="truth", n_worst=20).first()
    assert err["n_inspected"] == 20 and err["threshold"] <= err["mean_silhouette"] and sum(err["per_cluster_counts"].values()) == 20


@pytest.mark.parametrize("far,at", [(6, 1000.0), (20, 300.0)])
def test_kmeans_finds_a_few_rows_far_away(spark, far, at):
    rng = np.random.default_rng(0)
    near = rng.normal(size=(60_000, 2))
    df = spark.createDataFrame(
        pd.DataFrame({"row_id": np.arange(60_000 + far), "features": [*near.tolist(), *[[at, at]] * far]})
    ).repartition(8)
    fit = kmeans.fit_kmeans(df, 2, n_init=3)
    assert sorted(fit.sizes.tolist()) == [far, 60_000]
    assert fit.inertia == pytest.approx(((near - near.mean(0)) ** 2).sum())


def test_seeding_rows_come_from_all_rows_and_weigh_them(spark):
    x = np.r_[np.zeros((900, 2)), np.full((90, 2), 50.0), [[500.0, 0.0]] * 9, [[0.0, 9000.0]]]
    df = frame(spark, x)
    rows, weights = kmeans.seeding_rows(df, 4)
    again, _ = kmeans.seeding_rows(df.repartition(2), 4)
    assert weights.sum() == 1000 and {tuple(r) for r in rows} == {(0.0, 0.0), (50.0, 50.0), (500.0, 0.0), (0.0, 9000.0)}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_rows_without_a_distance_are_named(spark):
    from pyspark.sql import types as T

    from kinfold.operators.geometry import UnsoundRows

    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])
    for bad in (None, [1.0, None], [1.0, float("nan")], [1.0]):
        df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)] + [(9, bad)], schema)
        for fit in (lambda: kmeans.fit_kmeans(df, 2), lambda: linkage.fit_agglomerative(df, 2), lambda: density.fit_density(df)):
            with pytest.raises(UnsoundRows):
                fit()


def test_misspelt_options_are_refused(three):
    with pytest.raises(TypeError, match="min_cluster_sise"):
        algorithms.fit_algorithm("hdbscan", three, 2, min_cluster_sise=20)
