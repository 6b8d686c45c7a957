"""What each cluster looks like: sizes, rates, deviations, exemplars, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geometry import Centroids, own_centroid_distance
from .internal_scores import DegenerateClustering, silhouette_rows
from .ordering import exact_quantiles
from .sampling import simple_sample


def cluster_profiles(
    df: DataFrame, features: list[str], label: Column, *, cluster: str = "cluster", top: int = 3, keep_noise: bool = True
) -> DataFrame:
    """``(cluster, size, share, label_rate, label_count, top_deviations)``, highest rate first.

    Deviations are cluster means in population standard deviations from the global mean; a
    constant feature counts as deviation 1 wide. Only per-cluster means meet the global moments,
    which enter as one scalar subquery.
    """
    y = label.cast("double")
    moments = df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(c).alias(f"m_{c}") for c in features],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in features],
        )
    )
    source = df if keep_noise else df.where(F.col(cluster) != -1)
    per = source.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg(y).alias("label_rate"),
        F.sum(y).cast("bigint").alias("label_count"),
        *[F.avg(c).alias(f"c_{c}") for c in features],
    )
    g = per.withColumn("g", moments.scalar())

    def z(c: str) -> Column:
        spread = F.when(F.col(f"g.s_{c}") == 0, 1.0).otherwise(F.col(f"g.s_{c}"))
        return (F.col(f"c_{c}") - F.col(f"g.m_{c}")) / spread

    zs = F.array(*[F.struct((-F.abs(z(c))).alias("o"), F.lit(i).alias("i"), F.lit(c).alias("f"), z(c).alias("z")) for i, c in enumerate(features)])
    lead = F.slice(F.array_sort(zs), 1, top)
    text = F.array_join(F.transform(lead, lambda s: F.format_string("%s (%+.2fσ)", s["f"], s["z"])), ", ")
    return g.select(
        cluster, "size", (F.col("size") / F.col("g.n")).alias("share"), "label_rate", "label_count", text.alias("top_deviations")
    ).orderBy(F.desc("label_rate"), cluster)


def domain_labels(profiles: DataFrame, base_rate: Column | float) -> DataFrame:
    """A reproducible name per cluster, justified by the numbers it was derived from."""
    base = base_rate if isinstance(base_rate, Column) else F.lit(float(base_rate))
    p = profiles.withColumn("_b", base)
    p = p.withColumn("enrichment_vs_base", F.when(F.col("_b") > 0, F.col("label_rate") / F.col("_b")).otherwise(F.lit(float("nan"))))
    none, hot = F.col("label_count") == 0, F.col("enrichment_vs_base")
    # NaN compares as the largest double in SQL, while an undefined enrichment must match no threshold
    ok = ~F.isnan(hot)
    # fixed values: the names and their wording
    name = (
        F.when(none, "Clean bulk")
        .when(ok & (hot >= 10), "Fraud hotspot")
        .when(ok & (hot >= 2), "Elevated-risk pocket")
        .when(F.col("share") >= 0.4, "Mainstream traffic")
        .otherwise("Ordinary niche")
    )
    why = (
        F.when(none, "no fraud at all; the benign core of the portfolio")
        .when(ok & (hot >= 10), F.format_string("fraud rate %.0fx the population rate (%.2f%%)", hot, F.col("label_rate") * 100))
        .when(ok & (hot >= 2), F.format_string("fraud rate %.1fx the population rate", hot))
        .when(F.col("share") >= 0.4, F.format_string("%.0f%% of all transactions, near base rate", F.col("share") * 100))
        .otherwise("distinct geometry but unremarkable fraud rate")
    )
    return p.select(
        "cluster",
        name.alias("proposed_label"),
        "size",
        "label_rate",
        "enrichment_vs_base",
        F.concat(why, F.lit("; driven by "), F.col("top_deviations")).alias("justification"),
    )


def feature_means(df: DataFrame, features: list[str], label: Column | None = None, *, cluster: str = "cluster") -> DataFrame:
    """Per non-noise cluster: size, label rate (0 without a label) and the mean of every feature."""
    rate = F.avg(label.cast("double")) if label is not None else F.lit(0.0)
    return (
        df.where(F.col(cluster) != -1)
        .groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("size"), rate.alias("label_rate"), *[F.avg(c).alias(c) for c in features])
    )


def feature_summary(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, mean, std, min, max, median)``; the median is exact."""
    medians = {c: q[0] for c, q in exact_quantiles(df, features, [0.5]).items()}
    wide = df.agg(
        *[f(F.col(c)).alias(f"{n}_{c}") for c in features for n, f in (("a", F.avg), ("s", F.stddev_pop), ("l", F.min), ("h", F.max))]
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"a_{c}").alias("mean"), F.col(f"s_{c}").alias("std"),
            F.col(f"l_{c}").alias("min"), F.col(f"h_{c}").alias("max"), F.lit(medians[c]).alias("median"),
        )
        for c in features
    ]
    return wide.select(F.inline(F.array(*rows)))


def overview(df: DataFrame, features: list[str], label: Column, *, cluster: str = "cluster") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(features)).alias("n_features"),
        F.avg(label.cast("double")).alias("label_rate"),
        F.count_distinct(F.when(F.col(cluster) != -1, F.col(cluster))).alias("n_clusters"),
    )


def exemplars(df: DataFrame, *, sample_size: int | None = None, seed: int = 0) -> DataFrame:
    """Per cluster: the row nearest the centroid, the best-placed row and the most marginal one.

    Works on all non-noise rows, or on ``sample_size`` of them; empty when fewer than two clusters are left.
    """
    live = df.where("cluster <> -1").select("row_id", "features", F.col("cluster").cast("bigint").alias("cluster"))
    if sample_size is not None:
        live = simple_sample(live, sample_size, tag="exemplar", seed=seed)
    try:
        sil = silhouette_rows(live)
    except DegenerateClustering:
        return df.sparkSession.createDataFrame(
            [], "cluster bigint, medoid_id bigint, best_id bigint, best_silhouette double, boundary_id bigint, boundary_silhouette double"
        )
    placed = own_centroid_distance(live, Centroids.fit(live))
    medoid = placed.groupBy("cluster").agg(F.min_by("row_id", F.struct("distance", "row_id")).alias("medoid_id"))
    ends = sil.groupBy("cluster").agg(
        F.max_by(F.struct("row_id", "silhouette"), F.struct("silhouette", -F.col("row_id"))).alias("b"),
        F.min_by(F.struct("row_id", "silhouette"), F.struct("silhouette", "row_id")).alias("w"),
    )
    return medoid.join(ends, "cluster").select(
        "cluster", "medoid_id", F.col("b.row_id").alias("best_id"), F.col("b.silhouette").alias("best_silhouette"),
        F.col("w.row_id").alias("boundary_id"), F.col("w.silhouette").alias("boundary_silhouette"),
    )


def top_per_group(df: DataFrame, group: str, n: int, *order) -> DataFrame:
    """First ``n`` rows of every group; the limit is applied before the shuffle as well as after."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
