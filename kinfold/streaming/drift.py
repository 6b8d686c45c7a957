"""Watch a stream for drift: bin counts per window against stored reference shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.audit import bin_column
from ..operators.drift import EPSILON


def reference_shares(counts: dict[str, list[int]]) -> dict[str, list[float]]:
    return {f: [c / max(1, sum(cs)) for c in cs] for f, cs in counts.items()}


def windowed_drift(
    stream: DataFrame, edges: dict[str, list[float]], shares: dict[str, list[float]], *, time: str = "ts",
    window: str = "1 day", delay: str = "1 hour", threshold: float = 0.2,
) -> DataFrame:
    """``(window_start, window_end, rows, feature, psi, drifted)``, emitted when a window closes.

    One aggregation per window: a handful of counters per feature, whatever the traffic. Rows
    later than ``delay`` are dropped by the watermark.
    """
    counters = [
        F.count_if(bin_column(F.col(f), e) == i).alias(f"n_{f}_{i}") for f, e in edges.items() for i in range(max(1, len(e) - 1))
    ]
    per = (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("rows"), *counters)
    )

    def index(f: str):
        bins = max(1, len(edges[f]) - 1)
        if bins < 2:
            return F.lit(0.0)
        total = F.lit(0.0)
        for i in range(bins):
            cur = F.greatest(F.col(f"n_{f}_{i}") / F.col("rows"), F.lit(EPSILON))
            ref = F.lit(max(shares[f][i], EPSILON))
            total = total + (cur - ref) * F.log(cur / ref)
        return total

    cells = F.array(*[F.struct(F.lit(f).alias("feature"), index(f).alias("psi")) for f in edges])
    out = per.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rows", F.inline(cells))
    return out.withColumn("drifted", F.col("psi") >= threshold)
