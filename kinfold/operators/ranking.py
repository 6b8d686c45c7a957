"""Scores of a ranking against a binary label, exact and tie-aware, from distinct scores only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import SINGLE_TASK_ROWS
from .ordering import running_totals


def ranking_scores(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None, limit: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """``(groups..., roc_auc, average_precision)``; null where a class is absent."""
    groups = groups or []
    y = F.col(label).cast("double")
    # descending order, with -0.0 and 0.0 as one value
    by_score = df.groupBy(*groups, (0.0 - F.col(score)).alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1.0 - y).alias("neg")
    )
    run = running_totals(by_score, "s", ["pos", "neg"], groups, limit)
    totals = run.groupBy(*groups).agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    # positives seen strictly before a score beat its negatives; ties count one half
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    hits = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    sums = run.groupBy(*groups).agg(area.alias("area"), hits.alias("hits"))
    if groups:
        joined = sums.join(totals, groups)
    else:
        joined = sums.select("*", totals.select("p").scalar().alias("p"), totals.select("q").scalar().alias("q"))
    return joined.select(
        *groups,
        F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("area") / (F.col("p") * F.col("q"))).alias("roc_auc"),
        F.when(F.col("p") > 0, F.col("hits") / F.col("p")).alias("average_precision"),
    )


def rank_runs(scores: DataFrame, metric: str, higher_is_better: bool) -> DataFrame:
    """Best first; undefined scores last whichever way the metric points."""
    bad = F.col(metric).isNull() | F.isnan(metric)
    return scores.orderBy(bad, F.col(metric).desc() if higher_is_better else F.col(metric).asc())
