"""Score a stream against fitted centroids: nearest cluster, distance, anomaly flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.geometry import Centroids, assign_nearest


def score_stream(rows: DataFrame, centroids: Centroids, *, threshold: float, features: str = "features") -> DataFrame:
    """Row-local and stateless, so it needs no watermark and scales with the input partitions."""
    scored = assign_nearest(rows, centroids, features=features, checked=True)
    return scored.withColumn("anomalous", F.col("distance_to_centroid") > F.lit(threshold))


def feature_vector(*columns: Column) -> Column:
    return F.array(*[c.cast("double") for c in columns])


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available now and stop; output and progress live on shared storage."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
