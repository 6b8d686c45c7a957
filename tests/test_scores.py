import numpy as np
import pytest
from conftest import blobs, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions import cells
from kinfold.functions.vectors import get_distance, pair_distances
from kinfold.operators import contingency, geometry, internal_scores, pairs, significance, stability, tendency
from kinfold.session import TooLarge

VECTORS = st.lists(st.floats(-10, 10), min_size=4, max_size=4)


@given(VECTORS, VECTORS, VECTORS)
@settings(max_examples=60, deadline=None)
def test_metric_axioms(a, b, c):
    for m in ("euclidean", "manhattan"):
        d = lambda x, y: pair_distances(np.array([x]), np.array([y]), m)[0, 0]
        assert d(a, b) == pytest.approx(d(b, a)) and d(a, a) == 0
        assert d(a, c) <= d(a, b) + d(b, c) + 1e-9


def test_distance_registry(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    at = lambda name, **k: df.select(get_distance(name, **k)(F.col("a"), F.col("b"))).first()[0]
    assert at("euclidean") == 5.0 and at("manhattan") == 7.0 and at("cosine") == 1.0
    assert at("mahalanobis", inverse_covariance=np.eye(2)) == 5.0
    with pytest.raises(ValueError):
        get_distance("mahalanobis")
    with pytest.raises(KeyError):
        get_distance("nope")


def test_purity_and_ari_of_literal_labels(spark):
    rows = list(zip([0, 0, 1, 1, 0, 1], [0, 0, 0, 1, 0, 1]))
    got = contingency.external_scores(contingency.contingency(spark.createDataFrame(rows, "t int, p int"), "t", "p")).first()
    assert got["purity"] == pytest.approx(5 / 6)
    m = np.array([[3, 0], [1, 2]])
    assert got["ari"] == pytest.approx(cells.ari(m)) and got["nmi"] == pytest.approx(cells.nmi(m))


def test_ami_matches_a_brute_force_expectation(spark):
    rng = np.random.default_rng(0)
    t, p = rng.integers(0, 3, 40), rng.integers(0, 4, 40)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(t, p)], "t int, p int")
    emi = contingency.expected_mutual_information(contingency.contingency(df, "t", "p")).first()["emi"]

    def mi(a, b):
        c = np.zeros((3, 4))
        np.add.at(c, (a, b), 1)
        q = c / c.sum()
        live = q > 0
        return (q[live] * np.log(q[live] / np.outer(q.sum(1), q.sum(0))[live])).sum()

    null = [mi(t, rng.permutation(p)) for _ in range(20000)]
    assert emi == pytest.approx(np.mean(null), abs=4 * np.std(null) / np.sqrt(20000))


def test_internal_scores_on_blobs_and_guard(spark):
    x, y = blobs()
    df = frame(spark, x, cluster=y).cache()
    assert internal_scores.score_internal("silhouette", df) > 0.8
    assert internal_scores.score_internal("davies_bouldin", df) < 0.3
    assert internal_scores.score_internal("dunn", df) > 1
    for m in internal_scores.INTERNAL:
        with pytest.raises(internal_scores.DegenerateClustering):
            internal_scores.score_internal(m, df.withColumn("cluster", F.lit(1)))
    with pytest.raises(KeyError):
        internal_scores.score_internal("nope", df)
    with pytest.raises(TypeError):
        internal_scores.score_internal("dunn", df, diameter_kap=5)
    counted = contingency.contingency(df.withColumn("t", F.col("cluster")), "t", "cluster")
    assert internal_scores.score_external(["ari", "ami"], counted) == {"ari": pytest.approx(1.0), "ami": pytest.approx(1.0)}
    with pytest.raises(KeyError):
        internal_scores.score_external(["silhouette"], counted)
    noisy = df.withColumn("cluster", F.when(F.col("row_id") < 5, -1).otherwise(F.col("cluster")))
    assert internal_scores.silhouette_rows(noisy).count() == 295


def test_blocks_do_not_change_pair_results(spark):
    x, y = blobs(n=250, d=3)
    df = frame(spark, x, cluster=y)
    key = lambda d: sorted((r["row_id"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in d.collect())
    one = key(pairs.self_neighbours(df, 3))
    assert one == key(pairs.self_neighbours(df, 3, block_rows=40))
    assert one == key(pairs.query_neighbours(df, df, 3, budget=1, block_rows=40))
    d = pair_distances(x, x)
    np.fill_diagonal(d, np.inf)
    assert [r[2] for r in one if r[1] == 1] == list(d.argmin(1))


def test_assignment_rules(spark):
    x = np.array([[0.0, 0.0], [0.0, 2.0], [10.0, 0.0], [10.0, 2.0], [9.0, 1.0]])
    df = frame(spark, x, cluster=[0, 0, 1, 1, -1])
    c = geometry.Centroids.fit(df)
    assert c.ids == (0, 1) and np.allclose(c.points, [[0, 1], [10, 1]])
    dist = {r["row_id"]: r["distance"] for r in geometry.own_centroid_distance(df, c).collect()}
    assert dist[0] == 1.0 and dist[4] == 1.0
    with pytest.raises(ValueError):
        geometry.assign_nearest(frame(spark, np.ones((2, 3))), c)
    with pytest.raises(ValueError):
        geometry.Centroids.fit(df.withColumn("cluster", F.lit(-1)))
    many = geometry.Centroids(tuple(range(200)), np.random.default_rng(0).normal(size=(200, 2)))
    near = geometry.assign_nearest(df, many).orderBy("row_id").collect()
    want = ((x[:, None] - many.points[None]) ** 2).sum(2).argmin(1)
    assert [r["assigned_cluster"] for r in near] == list(want)


def test_pca_reaches_its_target(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4)) * [5, 2, 0.1, 0.1] + 7
    m = geometry.fit_pca(frame(spark, x), 0.95)
    assert m.n_components == 2
    z = np.array([r["features"] for r in m.project(frame(spark, x)).collect()])
    assert np.allclose(z.mean(0), 0, atol=1e-9) and np.allclose(z.var(0, ddof=1), m.variance[:2])


def test_hopkins_and_order(spark):
    flat = tendency.uniform_rows(spark, 1500, [(0.0, 1.0)] * 4, tag="t")
    assert 0.4 < tendency.hopkins(flat, sample_size=150) < 0.6
    x, _ = blobs(n=600, k=4)
    df = frame(spark, x).cache()
    assert tendency.hopkins(df, sample_size=100) > 0.75
    small = df.where("row_id < 120")
    d = pair_distances(x[:120], x[:120])
    order = [int(d.sum(1).argmax())]
    near, rest = d[order[0]].copy(), set(range(120)) - set(order)
    while rest:
        left = sorted(rest)
        j = left[int(np.argmin(near[left]))]
        order.append(j)
        rest.discard(j)
        near = np.minimum(near, d[j])
    got = [r["row_id"] for r in tendency.vat_order(small).orderBy("position").collect()]
    assert got == order
    with pytest.raises(TooLarge):
        tendency.vat_order(df, max_rows=100)


def test_significance(spark):
    rng = np.random.default_rng(0)
    t = rng.integers(0, 3, 400)
    good = np.where(rng.random(400) < 0.8, t, rng.integers(0, 3, 400))
    bad = rng.integers(0, 3, 400)
    df = spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in zip(t, good, bad)], "t int, g int, b int")
    ci = significance.bootstrap_ci(df, "ari", true="t", pred="g", replicates=200).first()
    assert ci["lower"] <= ci["observed"] <= ci["upper"]
    assert significance.permutation_test(df, "ari", true="t", pred="g", permutations=200).first()["p_value"] < 0.01
    assert significance.permutation_test(df, "ari", true="t", pred="b", permutations=200).first()["p_value"] > 0.01
    cmp = significance.compare_models(df, "nmi", true="t", pred_a="g", pred_b="b", replicates=200).first()
    assert cmp["significant"] and cmp["observed_diff"] > 0

    def accuracy(c):
        return float(np.trace(c) / c.sum())

    assert significance.bootstrap_ci(df, accuracy, true="t", pred="g", replicates=20).first()["metric"] == "accuracy"


def test_fixed_margins_hold_for_huge_counts():
    rng = np.random.default_rng(0)
    rows, cols = np.array([3 * 10**9, 10**9]), np.array([2 * 10**9, 2 * 10**9])
    m = cells.fixed_margins(rng, rows, cols)
    assert (m.sum(1) == rows).all() and (m.sum(0) == cols).all()


def test_co_association_counts_every_pair_once(spark):
    labels = spark.createDataFrame(
        [(0, [0.0], [0, 1, None]), (1, [0.0], [0, 1, 0]), (2, [0.0], [1, 1, 0])], "row_id long, features array<double>, labels array<int>"
    )
    got = {(r["co"], r["drawn"]): r["pairs"] for r in stability.co_association_counts(labels).collect()}
    assert got == {(2, 2): 1, (1, 2): 1, (2, 3): 1}


def test_distances_of_wide_rows_keep_their_digits():
    x = np.random.default_rng(0).normal(size=(40, 64)) * 100
    x[1] = x[0]
    x[2] = x[0]
    x[2, 0] += 4e-7
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.allclose(pair_distances(x, x), want, rtol=1e-9, atol=0)
    assert pair_distances(x, x)[0, 1] == 0 and (np.diag(pair_distances(x, x)) == 0).all()


def test_neighbours_at_equal_distance_come_by_id(spark):
    x = np.zeros((12, 64))
    x[6:] = 1.0
    for order in (np.arange(12), np.arange(12)[::-1]):
        df = spark.createDataFrame([(int(i), x[i].tolist()) for i in order], "row_id bigint, features array<double>")
        rows = pairs.self_neighbours(df, 2, block_rows=4).collect()
        found = sorted((r["row_id"], r["rank"], r["neighbour"], r["distance"]) for r in rows)
        want = [(i, k + 1, j, 0.0) for i in range(12) for k, j in enumerate([j for j in range(12) if j != i and j // 6 == i // 6][:2])]
        assert found == want


@pytest.mark.parametrize("columns", [3, 300])
def test_labels_without_a_centroid_have_no_distance(spark, columns):
    x = np.zeros((4, columns))
    x[1:, 0] = 2.0
    df = frame(spark, x, cluster=np.array([0, 1, -1, 7]))
    centroids = geometry.Centroids([0, 1], np.stack([x[0], x[1]]))
    rows = geometry.own_centroid_distance(df, centroids).orderBy("row_id").collect()
    assert [r["distance"] for r in rows] == [0.0, 0.0, 0.0, None]


def test_adjusted_information_of_a_matrix_equals_that_of_a_table(spark):
    rng = np.random.default_rng(4)
    for shape in ((3, 4), (12, 2), (1, 5)):
        m = rng.integers(0, 9, shape)
        rows = [(i, j, int(v)) for (i, j), v in np.ndenumerate(m) if v]
        want = contingency.external_scores(spark.createDataFrame(rows, "t int, p int, n long")).first()["ami"]
        assert cells.ami(m) == pytest.approx(want, abs=1e-12)
    assert cells.ami(np.diag([5, 7, 9])) == pytest.approx(1.0)
    df = spark.createDataFrame([(i % 3, (i % 3) if i % 5 else 0) for i in range(300)], "class int, cluster int")
    r = significance.bootstrap_ci(df, "ami", replicates=50).first()
    assert r["metric"] == "ami" and r["lower"] <= r["observed"] <= r["upper"]


def test_diameters_look_at_far_rows_only(spark, monkeypatch):
    """The diameter of every row's pairs, from few rows; a cluster of other shape and one of equal rows do not disturb."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.uniform(0, 1, (1500, 3)) * [9, 1, 1], rng.normal(20, 0.5, (900, 3)), np.full((100, 3), -5.0)])
    df = frame(spark, x, cluster=np.repeat([0, 1, 2], [1500, 900, 100])).cache()
    whole = internal_scores.score_internal("dunn", df)
    seen = []
    pairs = internal_scores.pair_summary
    monkeypatch.setattr(internal_scores, "PAIRED_ROWS", 200)
    monkeypatch.setattr(internal_scores, "pair_summary", lambda m, **o: seen.append((m.count(), o["n"])) or pairs(m, **o))
    assert internal_scores.score_internal("dunn", df) == whole
    assert seen[0][0] == seen[0][1] < 300
