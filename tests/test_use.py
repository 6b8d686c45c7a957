import numpy as np
import pytest
from conftest import ari_of, blobs, frame
from pyspark.sql import functions as F

from kinfold.operators import audit, downstream, drift, profiles, surrogate
from kinfold.operators.deep import network, training
from kinfold.operators.tendency import box_of


@pytest.fixture(scope="module")
def opposite(spark):
    """Two clusters in which the class depends on different features."""
    rng = np.random.default_rng(0)
    y = np.repeat([0, 1], 400)
    x = rng.normal(0, 1, (800, 3))
    x[y == 1, 0] += 8
    cls = np.where(y == 0, x[:, 1] > 1, x[:, 2] > 1).astype(int)
    return frame(spark, x, cluster=y, **{"class": cls}).cache()


def test_conditional_models_beat_the_global_one(opposite):
    scores, per = downstream.conditional_modelling(opposite)
    row = scores.first()
    assert row["lift"] > 1.3 and row["n_train"] + row["n_test"] == 800
    assert {r["modelled"] for r in per.collect()} == {True}
    with pytest.raises(ValueError):
        downstream.fit_logistic(opposite.withColumn("class", F.lit(0)))


def test_logistic_fit_is_a_stationary_point(opposite):
    beta = downstream.fit_logistic(opposite)[downstream.GLOBAL]
    rows = opposite.collect()
    x = np.array([[1.0, *r["features"]] for r in rows])
    y = np.array([r["class"] for r in rows])
    s = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    g = x.T @ (s * (1 / (1 + np.exp(-x @ beta)) - y)) + np.r_[0.0, beta[1:]]
    assert np.abs(g).max() < 1e-4


def test_anomaly_ranking_flags_exactly_the_quota(opposite):
    scored = downstream.centroid_distances(opposite)
    for limit in (50, 10**6):
        row = downstream.anomaly_scores(scored, label="class", fraction=0.05, limit=limit).first()
        assert row["n_flagged"] == 40 and row["enrichment"] > 1
    assert np.isnan(downstream.anomaly_scores(scored, label=None).first()["precision_at_k"])


def test_tree_rules_cover_all_rows_and_attributions_add_up(spark, opposite):
    df = opposite.withColumn("cluster", F.col("class"))
    tree = surrogate.fit_surrogate(df, ["a", "b", "c"], min_leaf=20)
    rules = surrogate.tree_rules(spark, tree).collect()
    assert sum(r["support"] for r in rules) == 800 and all(0.5 <= r["precision"] <= 1 for r in rules)
    assert surrogate.fidelity(df, tree).first()["accuracy"] > 0.9
    bg = surrogate.background_rows(df, 50)
    x = np.array([r["features"] for r in df.limit(20).collect()])
    phi = surrogate.attributions(x, surrogate._leaf_tables(tree, bg), 3, 2)

    def share(z):
        out = np.zeros((len(z), 2))
        for leaf in tree.leaves:
            hit = np.ones(len(z), bool)
            for f, low, cut in leaf.path:
                hit &= (z[:, f] <= cut) if low else (z[:, f] > cut)
            out[hit] = leaf.shares / leaf.shares.sum()
        return out

    assert np.allclose(phi.sum(1), share(x) - share(bg).mean(0))
    start = {r["row_id"]: np.array(r["features"]) for r in df.collect()}
    box = box_of(df)
    width = np.array([b - a for a, b in box])
    found = surrogate.counterfactuals(df.where("cluster = 0").limit(5), tree, 1, box, vary=["b", "c"]).collect()
    assert len({r["row_id"] for r in found}) == 5
    moved = [r for r in found if r["found"]]
    assert moved and all(r["features"][0] == start[r["row_id"]][0] for r in moved)
    assert set(tree.predict(np.array([r["features"] for r in moved]))) == {1}
    rng = np.random.default_rng(0)
    for r in surrogate.counterfactuals(df.where("cluster = 0").limit(5), tree, 1, box).where("rank = 1").collect():
        draws = start[r["row_id"]] + rng.normal(0, 0.3, (20_000, 3)) * width  # none of the target is nearer
        away = np.sqrt((((draws - start[r["row_id"]]) / width) ** 2).sum(1))[tree.predict(draws) == 1]
        assert r["distance"] <= away.min() + 1e-9
    none = surrogate.counterfactuals(df.limit(3), tree, 7, box).collect()
    assert [(r["found"], r["rank"], r["distance"]) for r in none] == [(False, None, None)] * 3


def test_strata_and_composition(spark):
    tiled = spark.createDataFrame([(i % 4, i % 4 if i < 400 else 0) for i in range(400)], "stratum int, x int")
    even = audit.composition(tiled.withColumn("cluster", (F.rand(1) * 0).cast("int")))
    assert {round(r["ratio"], 9) for r in even.collect()} == {1.0}
    alone = audit.composition(tiled.withColumn("cluster", F.col("stratum")))
    a = audit.composition_audit(alone, attribute="x").first()
    assert a["max_representation_ratio"] == 4.0 and a["concentrated_clusters"] == [0, 1, 2, 3] and a["n_strata"] == 4
    constant = audit.quantile_strata(tiled.withColumn("v", F.lit(3.0)), "v")
    assert constant.select("stratum").distinct().collect()[0][0] == 0
    quarters = audit.quantile_strata(spark.range(400).withColumn("v", F.col("id").cast("double")), "v").groupBy("stratum").count()
    assert [r["count"] for r in quarters.collect()] == [100] * 4


def test_drift(spark):
    rng = np.random.default_rng(0)
    make = lambda shift: spark.createDataFrame(
        [(float(a), float(b), 1.0) for a, b in zip(rng.normal(0, 1, 1500), rng.normal(shift, 1, 1500))], "a double, b double, c double"
    )
    ref, cur = make(0.0), make(3.0)
    for limit in (200, 10**6):
        rows = {r["feature"]: r for r in drift.feature_drift(ref, cur, ["a", "b", "c"], limit=limit).collect()}
        assert rows["b"]["drifted"] and not rows["a"]["drifted"] and rows["c"]["psi"] == 0
        assert rows["b"]["ks_pvalue"] < 1e-9 < rows["a"]["ks_pvalue"]
    psi = {r["feature"]: r["psi"] for r in drift.stability_index(ref, cur, ["a", "b", "c"]).collect()}
    assert all(psi[f] == pytest.approx(rows[f]["psi"]) for f in psi)
    report = drift.drift_report(drift.feature_drift(ref, cur, ["a", "b"])).first()
    assert report["drifted_features"] == ["b"] and report["refit_required"]
    far = drift.stability_index(ref, make(50.0), ["b"]).first()["psi"]
    assert np.isfinite(far) and far > 1
    with pytest.raises(ValueError):
        drift.feature_drift(ref, cur.drop("b"), ["a", "b"])
    clocked = ref.withColumnRenamed("a", "time_sin").withColumnRenamed("b", "time_cos").withColumn("time", F.lit(1.0))
    assert str(drift.split_axis(clocked)) == "clock:time"
    assert str(drift.split_axis(clocked.drop("time"))) == "phase:time_sin+time_cos"
    gap = clocked.withColumn("time", F.when(F.col("time_sin") > 0, 1.0))
    assert drift.split_axis(gap).kind == "phase"


def test_names_follow_the_rules(spark):
    rows = [(0, 0.0, 0, 0.5), (1, 0.2, 5, 0.1), (2, 0.05, 5, 0.1), (3, 0.01, 5, 0.6), (4, 0.01, 1, 0.1)]
    p = spark.createDataFrame([(c, 10, s, r, n, "x") for c, r, n, s in rows], "cluster int, size long, share double, label_rate double, label_count long, top_deviations string")
    got = [r["proposed_label"] for r in profiles.domain_labels(p, 0.01).orderBy("cluster").collect()]
    assert got == ["Clean bulk", "Fraud hotspot", "Elevated-risk pocket", "Mainstream traffic", "Ordinary niche"]


@pytest.fixture(scope="module")
def tight(spark):
    x, y = blobs(n=300, d=8, sigma=0.3)
    return frame(spark, x / 5, truth=y).cache()


SHAPE = {"latent": 4, "hidden": (16,), "batch": 32}


def test_autoencoder_learns_and_repeats(tight):
    shards = training.make_shards(tight)
    net, losses = training.train_autoencoder(shards, epochs=40, latent=4, hidden=(16,), batch=32)
    again, _ = training.train_autoencoder(shards, epochs=40, latent=4, hidden=(16,), batch=32)
    assert losses[-1] < 0.3 * losses[0] and np.allclose(net.flat, again.flat)
    x = np.array([r["features"] for r in tight.orderBy("row_id").collect()])
    back = np.array([r["features"] for r in training.reconstruct(tight, net).orderBy("row_id").collect()])
    assert np.corrcoef(x.ravel(), back.ravel())[0, 1] > 0.7


@pytest.mark.parametrize("fit,epochs", [(training.fit_ae_kmeans, {"ae_epochs": 30, "ft_epochs": 4}), (training.fit_dec, {"init_epochs": 30, "dec_epochs": 7}), (training.fit_dec_contrastive, {"init_epochs": 30, "dec_epochs": 7})])
def test_deep_models_recover_blobs(tight, fit, epochs):
    model = fit(tight, 3, **epochs, **SHAPE)
    assert ari_of(model.labels(tight, "row_id", "truth")) > 0.85
    assert model.codes(tight).first()["features"].__len__() == 4


def test_training_options(tight):
    kept = training.fit_dec(tight, 3, init_epochs=5, dec_epochs=3, gamma=0.5, **SHAPE)
    moved = training.fit_dec(tight, 3, init_epochs=5, dec_epochs=3, train_centers=True, **SHAPE)
    assert len(kept.losses) == 3 and kept.losses[-1] < kept.losses[0] and np.abs(moved.centers - kept.centers).max() > 0


def test_gradients():
    rng = np.random.default_rng(1)
    net, x, c = network.AutoEncoder.start(4, [6], 2, 0), rng.normal(size=(9, 4)), rng.normal(size=(3, 2))

    def numeric(f, w, eps=1e-6):
        g = np.zeros_like(w)
        for i in range(len(w)):
            a, b = w.copy(), w.copy()
            a[i] += eps
            b[i] -= eps
            g[i] = (f(a) - f(b)) / (2 * eps)
        return g

    z = net.encode(x)
    p = network.sharpened(network.soft_assignment(z, c), np.ones(3))
    near = network.nearest_other(z)
    assert np.allclose(net.reconstruction(x, 0.1)[1], numeric(lambda v: net.with_flat(v).reconstruction(x, 0.1)[0], net.flat), atol=1e-6)
    for f in (lambda v: network.divergence_gradient(v, c, p), lambda v: network.info_nce(v, near, n_negatives=3)):
        assert np.allclose(f(z)[1].ravel(), numeric(lambda v: f(v.reshape(z.shape))[0], z.ravel()), atol=1e-6)


def test_contrastive_loss_excludes_self_and_grows_with_negatives():
    z = np.random.default_rng(0).normal(size=(20, 3))
    near = network.nearest_other(z)
    few, many = (network.info_nce(z, near, n_negatives=n)[0] for n in (2, 18))
    assert many > few > 0
    unit = z / np.linalg.norm(z, axis=1)[:, None]
    sim = unit @ unit.T / 0.5
    np.fill_diagonal(sim, -np.inf)
    want = np.mean(np.log(np.exp(sim).sum(1)) - sim[np.arange(20), near])
    assert network.info_nce(z, near)[0] == pytest.approx(want)
