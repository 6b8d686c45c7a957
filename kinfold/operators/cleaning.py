"""Exact duplicates, label isolation and the numbers that describe a cleaning step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Keep the first row, by row id, of rows equal in every other column.

    Written as an aggregate so that copies collapse before the shuffle, however many there are.
    """
    others = [c for c in df.columns if c != row_id]
    return df.groupBy(*others).agg(F.min(row_id).alias(row_id)).select(*df.columns)


def cleaning_stats(raw: DataFrame, clean: DataFrame, label: str, positive=1) -> DataFrame:
    """One row: input, dropped and output rows, and how the output splits by label."""
    before = raw.agg(F.count(F.lit(1)).alias("input_rows"))
    after = clean.agg(
        F.count(F.lit(1)).alias("output_rows"),
        F.count_if(F.col(label) == F.lit(positive)).alias("positive_rows"),
        F.count_if(F.col(label) != F.lit(positive)).alias("negative_rows"),
    )
    # the input count enters as a scalar subquery, not as a join
    return after.select(
        before.scalar().alias("input_rows"),
        (before.scalar() - F.col("output_rows")).alias("dropped_rows"),
        "output_rows",
        "positive_rows",
        "negative_rows",
    )


def isolate_label(df: DataFrame, label: str, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """Split into a table without the label, for fitting, and ``(row_id, label)``."""
    return df.drop(label), df.select(row_id, label)


def without_noise(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.where(F.col(cluster) != -1)


def label_counts(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster, noise included."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))


def labelled_subset(df: DataFrame, clusters: list, cluster: str = "cluster", only: tuple | None = None) -> DataFrame:
    """Rows of the chosen clusters, optionally only those with ``only = (column, value)``."""
    test = F.col(cluster).isin(clusters)
    if only is not None:
        test = test & (F.col(only[0]) == F.lit(only[1]))
    return df.where(test)


def common_draws(a: DataFrame, b: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows drawn by both of two resamples, once each, with both labels."""
    left = a.groupBy(row_id).agg(F.min("cluster").alias("cluster_a"))
    right = b.groupBy(row_id).agg(F.min("cluster").alias("cluster_b"))
    return left.join(right, row_id)


def union_samples(*samples: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Union of index sets in row order."""
    out = samples[0]
    for s in samples[1:]:
        out = out.unionByName(s)
    return out.orderBy(row_id)
