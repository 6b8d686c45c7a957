import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.operators import sampling
from kinfold.operators.ordering import exact_quantiles, rank_cutoffs, running_totals
from kinfold.operators.ranking import ranking_scores
from kinfold.session import checkpoint


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(6000).select(
        F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("class"), F.floor(F.rand(3) * 20).alias("tied"),
        F.rand(4).alias("free"),
    )
    return checkpoint(df)


@pytest.mark.parametrize("column", ["tied", "free"])
@pytest.mark.parametrize("rank", [1, 2999, 6000])
def test_cutoffs_with_narrowing_equal_a_sort(rows, column, rank):
    want = rows.toPandas().sort_values([column, "row_id"]).iloc[rank - 1]
    got = rank_cutoffs(rows, column, "row_id", {(): rank}, limit=100)[()]
    assert got == (want[column], want["row_id"])


def test_quantiles_agree_with_numpy_on_both_paths(rows):
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    want = np.quantile(rows.toPandas()["free"], probs)
    for limit in (100, 10**6):
        got = exact_quantiles(rows, ["free", "tied"], probs, limit=limit)
        assert np.allclose(got["free"], want)
        assert np.allclose(got["tied"], np.quantile(rows.toPandas()["tied"], probs))


def test_running_totals_do_not_depend_on_the_path(rows):
    per = rows.groupBy("class", "tied").agg(F.count(F.lit(1)).alias("n"))
    a = running_totals(per, "tied", ["n"], ["class"]).orderBy("class", "tied").collect()
    b = running_totals(per, "tied", ["n"], ["class"], limit=7).orderBy("class", "tied").collect()
    assert a == b


def test_stratified_sample_is_proportional_and_repeats(rows):
    one = {r["row_id"] for r in sampling.stratified_sample(rows, 601, seed=1).collect()}
    two = {r["row_id"] for r in sampling.stratified_sample(rows.repartition(3), 601, seed=1).collect()}
    assert one == two and abs(len(one) - 601) <= 1


def test_sample_is_exact_when_the_group_is_large(rows):
    quotas = {(0,): 500, (1,): 13}
    small = sampling.lowest_hash(rows, quotas, groups=["class"], limit=200)
    plain = sampling.lowest_hash(rows, quotas, groups=["class"])
    assert {r["row_id"] for r in small.collect()} == {r["row_id"] for r in plain.collect()}
    assert small.count() == 513


def test_bootstrap_draws_the_wanted_number(rows):
    drawn = sampling.bootstrap_rows(rows, replicates=2, fraction=0.5).groupBy("replicate").agg(F.sum("multiplicity").alias("n"))
    assert [r["n"] for r in drawn.collect()] == [3000, 3000]


def test_temporal_split_orders_by_time_not_position(spark):
    df = spark.createDataFrame([(i, float(9 - i)) for i in range(10)], "row_id long, t double")
    early = sampling.temporal_split(df, "t").where("half = 'early'").collect()
    assert {r["row_id"] for r in early} == {5, 6, 7, 8, 9}


def test_ranking_scores_against_brute_force(spark):
    rng = np.random.default_rng(0)
    s, y = rng.integers(0, 12, 200) / 4.0, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    ap, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        recall, precision = (pos >= t).mean(), (y[s >= t]).mean()
        ap, last = ap + (recall - last) * precision, recall
    for limit in (5, 10**6):
        got = ranking_scores(df, "s", "y", limit=limit).first()
        assert got["roc_auc"] == pytest.approx(auc) and got["average_precision"] == pytest.approx(ap)
