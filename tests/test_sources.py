import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.operators import cleaning, features, registry
from kinfold.sources import contracts, files


def raw(spark, n=3, **changes):
    names = [f"V{i}" for i in range(1, 29)]
    base = {**{c: 0.0 for c in names}, "Time": 0.0, "Amount": 1.0, "Class": 0, **changes}
    return spark.createDataFrame([tuple(base.values())] * n, list(base))


@pytest.mark.parametrize("change,column", [({"Class": 2}, "Class"), ({"Amount": -1.0}, "Amount"), ({"Extra": 1.0}, "Extra")])
def test_contract_rejects(spark, change, column):
    with pytest.raises(contracts.ContractError, match=column):
        contracts.validate(raw(spark, **change), contracts.raw_contract())


def test_contract_accepts_and_coerces(spark):
    out = contracts.validate(raw(spark, Amount=1), contracts.raw_contract())
    assert out.schema["Amount"].dataType == T.DoubleType() and out.schema["Class"].dataType == T.IntegerType()


def test_processed_contract_forbids_the_label(spark):
    found = {(r["rule"], r["column"]) for r in contracts.violations(raw(spark), contracts.processed_contract()).where("violations > 0").collect()}
    assert ("unexpected", "Class") in found and ("missing", "log_amount") in found


def test_ingest_checks_rows_and_checksum(spark, tmp_path):
    src = tmp_path / "in.csv"
    src.write_text("a,b\n1.5,x\n2.5,y\n")
    schema = T.StructType([T.StructField("a", T.DoubleType(), False), T.StructField("b", T.StringType(), False)])
    digest = hashlib.sha256(src.read_bytes()).hexdigest()
    ok = contracts.Expectations(rows=2, columns=2, sha256=digest)
    table, manifest = files.ingest_csv(spark, str(src), str(tmp_path / "out"), "test", contracts.Contract(schema), ok)
    assert table.count() == 2
    row = manifest.first()
    assert row["sha256"] == digest and row["row_count"] == 2 and row["size_bytes"] == src.stat().st_size
    assert registry.data_version(spark, str(tmp_path / "out" / "manifest")) == digest[:12]
    assert registry.data_version(spark, str(tmp_path / "none")) == "unknown"
    for bad in (contracts.Expectations(rows=3), contracts.Expectations(columns=1), contracts.Expectations(sha256="0")):
        with pytest.raises(contracts.ContractError):
            files.ingest_csv(spark, str(src), str(tmp_path / "bad"), "test", contracts.Contract(schema), bad)
    assert not (tmp_path / "bad" / "table").exists()


def test_malformed_csv_stops_the_read(spark, tmp_path):
    src = tmp_path / "bad.csv"
    src.write_text("a\nnot a number\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(src), T.StructType([T.StructField("a", T.DoubleType())])).collect()


def test_json_turns_nan_into_null_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan"))], "name string, score double")
    path = str(tmp_path / "s")
    assert files.read_json(spark, path, df.schema) is None
    files.write_json(df, path)
    assert files.read_json(spark, path, df.schema).first()["score"] is None


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    a = files.table_fingerprint(df, ["id", "x"]).first()
    b = files.table_fingerprint(df.orderBy(F.desc("id")).repartition(7), ["id", "x"]).first()
    assert a == b


def test_dedupe_keeps_the_first_row_and_counts(spark):
    df = spark.createDataFrame([(0, 1.0, 0), (1, 1.0, 0), (2, 2.0, 1)], "row_id long, v double, class int")
    clean = cleaning.drop_exact_duplicates(df)
    assert {r["row_id"] for r in clean.collect()} == {0, 2}
    stats = cleaning.cleaning_stats(df, clean, "class").first()
    assert (stats["input_rows"], stats["dropped_rows"], stats["positive_rows"], stats["negative_rows"]) == (3, 1, 1, 1)


def test_features_and_scaling(spark, tmp_path):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (21600.0, 9.0, 3.0)], "time double, amount double, v double")
    rows = features.FeatureBuilder(["v"]).transform(df).collect()
    assert rows[0]["log_amount"] == 0.0 and rows[0]["time_cos"] == pytest.approx(1.0)
    assert rows[1]["time_sin"] == pytest.approx(1.0) and rows[1]["time_cos"] == pytest.approx(0.0, abs=1e-12)
    path = str(tmp_path / "stage")
    features.FeatureBuilder(["v"], time="v", period=12.0).save(path)
    again = features.FeatureBuilder.load(path)
    assert again.feature_names_out()[0] == "v" and again.transform(df).first()["time_sin"] == pytest.approx(0.5)
    with pytest.raises(ValueError):
        features.scale(df, "nonsense", ["v"], [])
    scaled = features.scale(df, "hybrid", ["v"], ["amount"]).collect()
    assert sorted(r["v"] for r in scaled) == [-1.0, 1.0] and scaled[0].__fields__ == ["v", "amount"]


def test_registry_upserts_and_reports_what_is_missing(spark, tmp_path):
    root = str(tmp_path / "reg")
    assert registry.list_models(spark, root).count() == 0
    args = dict(name="m", algorithm="kmeans", k=2, data_version="v", n_rows=1, n_features=1, feature_space="s", metrics={"a": 0.5, "b": None}, seeds={})
    one = registry.register_model(spark, root, params={"k": 2}, artifact=spark.range(3), **args)
    registry.register_model(spark, root, params={"k": 2}, notes="again", **args)
    other = registry.register_model(spark, root, params={"k": 3}, **args)
    assert registry.list_models(spark, root).count() == 2
    assert registry.load_card(spark, root, one["entry_id"])["notes"] == "again"
    with pytest.raises(KeyError):
        registry.load_card(spark, root, "nope")
    with pytest.raises(ValueError):
        registry.load_artifact(spark, root, other["entry_id"])
