"""Base tables and the derived views that the query catalogue works on."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import pack
from ..session import prepare_session, spread

FEATURES = ["log_amount", "time_sin", "time_cos", "k25"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of a transaction table; seconds count from the first event."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first = events.agg(F.min(micros)).scalar()
    return events.select(
        F.col("event_id").alias("row_id"),
        ((micros - first) / F.lit(1e6)).alias("time_s"),
        F.col("value").alias("amount"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.col("event_type").alias("grp"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("class"),
    )


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered features with the group, the class and a rare label."""
    from ..operators.features import engineered

    cols = engineered("time_s", "amount")
    return txn(spark, sf_dir).select(
        "row_id",
        *[c.alias(n) for n, c in cols.items()],
        (F.col("k") / F.lit(25.0)).alias("k25"),
        "k",
        "grp",
        "class",
        F.when(F.col("k") == 7, 1).otherwise(0).alias("rare"),
    )


def feat_vectors(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Vectors spread over all cores; a large scan keeps the partitions it has."""
    return pack(_spread_scan(spark, sf_dir, feat), FEATURES, "row_id", *keep)


def _spread_scan(spark, sf_dir, view) -> DataFrame:
    # the number of scan partitions decides, so look at the plain scan
    parts = table(spark, sf_dir, "events").rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    df = view(spark, sf_dir)
    return df.repartition(cores) if parts < cores else df


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: four numeric features, two label columns and a clock."""
    li = table(spark, sf_dir, "lineitem")
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    return li.select(
        "l_quantity",
        "l_extendedprice",
        (F.col("l_discount") + 0.0).alias("l_discount"),
        (F.col("l_tax") + 0.0).alias("l_tax"),
        "l_returnflag",
        "l_linestatus",
        micros.alias("ship_us"),
    )


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("bigint").alias("cluster"),
    )
    return spread(e)


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vector per supplier: the balance, and means over the lines that the supplier delivered."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal").cast("double") / 1000).alias("balance"))
    li = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.avg(F.col("l_quantity").cast("double")).alias("quantity"), (F.avg(F.col("l_discount").cast("double")) * 500).alias("discount")
    )
    joined = s.join(li, F.col("s_suppkey") == F.col("l_suppkey")).withColumn("row_id", F.col("s_suppkey").cast("bigint"))
    return pack(joined, ["balance", "quantity", "discount"], "row_id")


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with exact copies of the urgent ones, told apart only by row id."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    first = o.select((F.col("o_orderkey") * 2).alias("row_id"), "*")
    again = o.where(F.col("o_orderpriority") == "1-URGENT").select((F.col("o_orderkey") * 2 + 1).alias("row_id"), "*")
    return first.unionByName(again)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items before the median ship time, and from it on."""
    from ..operators.ordering import exact_quantiles

    li = lines(spark, sf_dir)
    cut = exact_quantiles(li, ["ship_us"], [0.5])["ship_us"][0]
    return li.where(F.col("ship_us") < F.lit(cut)), li.where(F.col("ship_us") >= F.lit(cut))


# --- the same views for the SQL side ----------------------------------------------------------

SQL_TXN = """txn AS (SELECT event_id AS row_id,
  (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 1e6 AS time_s, value AS amount,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, event_type AS grp,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS class FROM events)"""
SQL_FEAT = SQL_TXN + f""", feat AS (SELECT row_id, ln(1 + amount) AS log_amount,
  sin({2 * math.pi!r} * time_s / 86400.0) AS time_sin, cos({2 * math.pi!r} * time_s / 86400.0) AS time_cos,
  k / 25.0 AS k25, k, grp, class, CASE WHEN k = 7 THEN 1 ELSE 0 END AS rare FROM txn),
  fv AS (SELECT row_id, [log_amount, time_sin, time_cos, CAST(k25 AS DOUBLE)] AS f, grp, class, rare FROM feat)"""
SQL_LINES = """li AS (SELECT l_quantity, l_extendedprice, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax,
  l_returnflag, l_linestatus, epoch_us(l_shipdate) AS ship_us FROM lineitem)"""
SQL_EMB = """emb AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS f, CAST(label AS BIGINT) AS cluster FROM embeddings),
  dims AS (SELECT row_id, cluster, unnest(f) AS x, generate_subscripts(f, 1) AS i FROM emb),
  cen AS (SELECT cluster, list(m ORDER BY i) AS c, any_value(n) AS n FROM
    (SELECT cluster, i, avg(x) AS m, count(*) AS n FROM dims GROUP BY 1, 2) GROUP BY 1)"""
SQL_SUPPLIERS = """sup AS MATERIALIZED (SELECT CAST(s_suppkey AS BIGINT) AS i, CAST(s_acctbal AS DOUBLE) / 1000 AS x, q AS y, e * 500 AS z
  FROM supplier JOIN (SELECT l_suppkey, avg(CAST(l_quantity AS DOUBLE)) AS q, avg(CAST(l_discount AS DOUBLE)) AS e FROM lineitem GROUP BY 1)
  ON s_suppkey = l_suppkey)"""
SQL_COPIES = """copies AS (SELECT o_orderkey * 2 AS row_id, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
  WHERE o_orderpriority = '1-URGENT')"""


def sql_u01(row_id: str, tag: str, seed: int = 0) -> str:
    return f"(CAST('0x' || substr(md5({row_id} || ':{tag}:{seed}'), 1, 8) AS BIGINT) / 4294967296.0)"
