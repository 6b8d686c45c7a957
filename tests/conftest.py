import os
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from kinfold.session import prepare_session

    session = (
        SparkSession.builder.master("local[8]")
        .appName("kinfold-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return prepare_session(session)


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def frame(spark, x, **columns):
    """``(row_id, features, columns...)`` from arrays."""
    from pyspark.sql import types as T

    fields = [T.StructField("row_id", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))]
    for name, v in columns.items():
        kind = T.DoubleType() if np.asarray(v).dtype.kind == "f" else T.LongType()
        fields.append(T.StructField(name, kind))
    rows = [
        (i, [float(v) for v in x[i]], *[np.asarray(c)[i].item() for c in columns.values()]) for i in range(len(x))
    ]
    return spark.createDataFrame(rows, T.StructType(fields)).repartition(4)


def blobs(n=300, d=5, k=3, sigma=0.4, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.uniform(-10, 10, (k, d))
    y = rng.integers(0, k, n)
    return centers[y] + rng.normal(0, sigma, (n, d)), y


def ari_of(labels, truth="truth"):
    from kinfold.operators.contingency import contingency, external_scores

    return external_scores(contingency(labels, truth, "cluster"), ami=False).first()["ari"]
