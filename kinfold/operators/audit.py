"""Who ends up in which cluster, and does it survive other preprocessing?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contingency import contingency, external_scores
from .kmeans import fit_kmeans
from .ordering import exact_quantiles


def distinct_edges(edges: list[float]) -> list[float]:
    return sorted(set(edges))


def bin_column(value: Column, edges: list[float]) -> Column:
    """Index of the half-open bin ``[e_i, e_i+1)``, the last one closed; a constant has bin 0."""
    out = F.lit(0)
    for i, e in enumerate(edges[1:-1], start=1):
        out = F.when(value >= F.lit(e), F.lit(i)).otherwise(out)
    return out


def quantile_strata(df: DataFrame, column: str, *, n_strata: int = 4, out: str = "stratum") -> DataFrame:
    """Quantile strata from exact quantiles; tied edges collapse into fewer strata."""
    edges = exact_quantiles(df, [column], [i / n_strata for i in range(n_strata + 1)])[column]
    return df.withColumn(out, bin_column(F.col(column), distinct_edges(edges)))


def composition(df: DataFrame, *, cluster: str = "cluster", stratum: str = "stratum") -> DataFrame:
    """``(cluster, size, stratum, share, ratio)`` for every cluster and every stratum.

    The ratio is the cluster's share of a stratum over the population's. All arithmetic is on the
    contingency table; combinations that do not occur have share and ratio 0.
    """
    cells = contingency(df, cluster, stratum)
    sizes = cells.groupBy("t").agg(F.sum("n").cast("double").alias("size"))
    strata = cells.groupBy("p").agg(F.sum("n").cast("double").alias("pop"))
    # strata are few by construction (quantile bins or levels of an attribute); they travel as one array
    every = strata.agg(F.collect_list(F.struct("p", "pop"))).scalar()
    grid = sizes.withColumn("_s", every).select("t", "size", F.inline("_s"), F.aggregate("_s.pop", F.lit(0.0), lambda x, y: x + y).alias("_all"))
    share = F.coalesce(F.col("n").cast("double"), F.lit(0.0)) / F.col("size")
    return grid.join(cells, ["t", "p"], "left").select(
        F.col("t").alias("cluster"), F.col("size").cast("bigint").alias("size"), F.col("p").alias("stratum"), share.alias("share"),
        (share / (F.col("pop") / F.col("_all"))).alias("ratio"),
    )


def composition_audit(cells: DataFrame, *, attribute: str, threshold: float = 2.0) -> DataFrame:
    """One row: number of strata, the largest ratio, and the clusters at or above the threshold."""
    peaks = cells.groupBy("cluster").agg(F.max("ratio").alias("peak"))
    strata = cells.agg(F.count_distinct("stratum"))
    return peaks.agg(
        F.lit(attribute).alias("attribute"),
        F.max("peak").alias("max_representation_ratio"),
        F.array_sort(F.collect_list(F.when(F.col("peak") >= threshold, F.col("cluster")))).alias("concentrated_clusters"),
    ).withColumn("n_strata", strata.scalar())


def preprocessing_sensitivity(variants: dict[str, tuple[DataFrame, str]], reference: DataFrame, k: int, *, seed: int = 0, n_init: int = 10) -> DataFrame:
    """Re-cluster each variant with the same algorithm and k; agreement with the reference labels."""
    spark, rows = reference.sparkSession, []
    base = reference.select("row_id", F.col("cluster").alias("_ref"))
    for name, (df, text) in variants.items():
        labels = fit_kmeans(df, k, seed=seed, n_init=n_init).labels(df)
        joined = labels.join(base, "row_id")
        ari = external_scores(contingency(joined, "_ref", "cluster"), ami=False).first()["ari"]
        used = labels.agg(F.count_distinct("cluster").alias("c")).first()["c"]
        rows.append((name, int(used), float(ari), text))
    return spark.createDataFrame(rows, "variant string, n_clusters int, ari_vs_reference double, description string")
