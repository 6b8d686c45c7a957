"""Nearest neighbours against every exact distance, the error bounds, and awkward vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import one_bit_search as o

VEC = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("id", T.StringType()),
    T.StructField("raw", T.StringType()), T.StructField("dim", T.StringType()), T.StructField("rank", T.LongType()), T.StructField("cb", T.StringType()),
])
ASKS = "vec_id % 100 = 0"


def plain(ids, x, asks, k):
    out = {}
    for i in np.flatnonzero(asks):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", 1, "d") for i, v in rows], VEC).repartition(3)


def recall(got, expected):
    pairs = [(q, v) for q, near in expected.items() for v, _ in near]
    return sum(v in {x for x, _ in got[q]} for q, v in pairs) / len(pairs)


def test_given_vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    t = rows.toPandas()
    ids, x = t["vec_id"].to_numpy(), np.stack(t["embedding"]).astype(float)
    expected = plain(ids, x, ids % 100 == 0, 10)
    got = o.search(rows, F.expr(ASKS))
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = found(got)
    assert recall(got, expected) >= 0.99
    for q, near in got.items():
        assert [s for _, s in near] == pytest.approx([s for _, s in expected[q]])


@pytest.mark.parametrize("dim,shift", [(1, 0.0), (2, 5.0), (24, 100.0), (130, 0.0)])
def test_recall_in_other_dimensions_and_off_the_origin(spark, dim, shift):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(600, dim)) + shift
    ids = np.arange(600)
    rows = table(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)])
    expected = plain(ids, x, ids % 20 == 0, 10)
    assert recall(found(o.search(rows, F.col("vec_id") % 20 == 0, query_block=8, candidate_block=100)), expected) >= 0.95


def test_copies_tie_to_the_smaller_id_and_few_candidates_are_all_returned(spark):
    rows = table(spark, [(100, [1.0, 2.0])] + [(i, [1.0, 2.0]) for i in range(1, 40)] + [(300, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 4.0])])
    got = found(o.search(rows, F.expr(ASKS)))
    assert got == {100: [(i, 0.0) for i in range(1, 11)], 300: [(5, 1.0)]}


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(spark, [
        (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]),
        (7, [3.0, 0.0]), (7, [3.0, 0.0]), (8, [1e200, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [2.0, 0.0]), (300, [2.0, 0.0]), (400, [5.0]),
    ])
    got = found(o.search(rows, F.expr(ASKS), k=3))
    assert got == {0: [(300, 1.0), (300, 1.0), (7, 2.0)], 300: [(0, 1.0), (7, 1.0), (7, 1.0)]}
    assert found(o.search(rows, F.expr(ASKS), k=9))[0][-1] == (8, inf)
    assert o.search(rows.limit(0), F.expr(ASKS)).count() == 0
    assert o.search(rows, F.lit(False)).count() == 0


def test_bounds_hold_nearly_always_and_spare_most_vectors():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(4000, 256)), rng.normal(size=(20, 256))
    turn = o.rotation(256, 7)
    assert np.allclose(turn @ turn.T, np.eye(256))
    center = x.mean(axis=0)
    exact = ((x[None] - q[:, None]) ** 2).sum(axis=2)
    codes = o.encode(x, center, turn)
    for epsilon, share in ((2.0, 0.94), (4.0, 0.9998)):
        low, high = o.bounds((q - center) @ turn.T, *codes, epsilon)
        assert ((low <= exact) & (exact <= high)).mean() >= share
    near = x[:20] + 0.3 * rng.normal(size=(20, 256))
    low, high = o.bounds((near - center) @ turn.T, *codes, 4.0)
    limit = np.partition(high, 9, axis=1)[:, 9:10]
    assert (low[:, :20].diagonal() < low.mean(axis=1)).all() and (low <= limit).mean() < 1
