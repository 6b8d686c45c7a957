"""Deterministic samples and splits: the rows with the lowest hashed number are taken."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import u01
from ..session import SINGLE_TASK_ROWS, bounded_rows
from .ordering import rank_cutoffs, within_cutoff


def half_even(x: float) -> int:
    return int(round(x))


def group_sizes(df: DataFrame, groups: list[str]) -> dict[tuple, int]:
    counts = df.groupBy(*groups).count() if groups else df.agg(F.count(F.lit(1)).alias("count"))
    return {tuple(r[g] for g in groups): r["count"] for r in bounded_rows(counts, 10_000, "strata")}


def lowest_hash(
    df: DataFrame,
    quotas: Mapping[tuple, int],
    *,
    row_id: str = "row_id",
    groups: list[str] | None = None,
    tag: str = "sample",
    seed: int = 0,
    sizes: dict[tuple, int] | None = None,
    limit: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Exactly ``quota`` rows per group, chosen by hash; all rows where the quota covers them.

    The result is one filtered scan: no shuffle of the data and no window over a large group.
    """
    groups = groups or []
    sizes = sizes if sizes is not None else group_sizes(df, groups)
    keyed = df.withColumn("_u", u01(row_id, tag, seed))
    whole = [g for g, q in quotas.items() if q >= sizes.get(g, 0)]
    part = {g: q for g, q in quotas.items() if 0 < q < sizes.get(g, 0)}
    # a hash is uniform, so the answer lies below a known threshold with overwhelming odds
    loose = {g: min(1.0, (q + 8 * math.sqrt(q) + 64) / sizes[g]) for g, q in part.items()}
    near = F.lit(False)
    for g, t in loose.items():
        near = near | (_is(groups, g) & (F.col("_u") < F.lit(t)))
    cut = {}
    if part:
        # a row at the wanted rank below the threshold has that rank in the whole group
        expected = {g: math.ceil(1.2 * loose[g] * sizes[g]) for g in part}
        cut = rank_cutoffs(keyed.where(near), "_u", row_id, part, groups, expected, limit) if max(expected.values()) <= limit else {}
        if len(cut) < len(part):
            cut = rank_cutoffs(keyed, "_u", row_id, part, groups, sizes, limit)
    keep = within_cutoff("_u", row_id, cut, groups)
    for g in whole:
        keep = keep | _is(groups, g)
    return keyed.where(keep).drop("_u")


def _is(groups: list[str], g: tuple):
    test = F.lit(True)
    for c, v in zip(groups, g):
        test = test & F.col(c).eqNullSafe(F.lit(v))
    return test


def simple_sample(df: DataFrame, n: int, *, row_id: str = "row_id", tag: str = "simple", seed: int = 0) -> DataFrame:
    """``n`` rows without replacement; the whole table when it is not larger."""
    return lowest_hash(df, {(): n}, row_id=row_id, tag=tag, seed=seed)


def stratified_sample(
    df: DataFrame, n: int, *, strata: str = "class", row_id: str = "row_id", seed: int = 0
) -> DataFrame:
    """Proportional sample with at least one row per class; shares round half to even."""
    sizes = group_sizes(df, [strata])
    total = sum(sizes.values())
    quotas = {g: min(c, max(1, half_even(n * c / total))) for g, c in sizes.items()}
    return lowest_hash(df, quotas, row_id=row_id, groups=[strata], tag="strat", seed=seed, sizes=sizes)


def quota_sample(
    df: DataFrame, quotas: Mapping[object, int], *, strata: str = "class", row_id: str = "row_id", seed: int = 0
) -> DataFrame:
    """A fixed number of rows per class; classes without a quota are left out."""
    return lowest_hash(
        df, {(k,): v for k, v in quotas.items()}, row_id=row_id, groups=[strata], tag="quota", seed=seed
    )


def stratified_split(
    df: DataFrame, test_fraction: float, *, strata: str = "class", row_id: str = "row_id", seed: int = 0
) -> DataFrame:
    """Add boolean ``is_test``: in every class the same fraction of rows is held out."""
    sizes = group_sizes(df, [strata])
    quotas = {g: half_even(test_fraction * c) for g, c in sizes.items()}
    keyed = df.withColumn("_u", u01(row_id, "split", seed))
    cut = rank_cutoffs(keyed, "_u", row_id, quotas, [strata], sizes)
    return keyed.withColumn("is_test", within_cutoff("_u", row_id, cut, [strata])).drop("_u")


def temporal_split(
    df: DataFrame, time: str, *, fraction: float = 0.5, row_id: str = "row_id", limit: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Add ``half``: 'early' for the first ``int(n * fraction)`` rows by time, else 'late'."""
    n = df.count()
    cut = rank_cutoffs(df, time, row_id, {(): int(n * fraction)}, sizes={(): n}, limit=limit)
    return df.withColumn("half", F.when(within_cutoff(time, row_id, cut), "early").otherwise("late"))


def bootstrap_rows(
    df: DataFrame, *, replicates: int, fraction: float = 1.0, row_id: str = "row_id", seed: int = 0
) -> DataFrame:
    """Draws with replacement as ``(replicate, row_id, multiplicity)``, ``int(n * fraction)`` draws each.

    Rows are numbered by a distributed rank, draws are hashed to positions, and the two are
    joined on the position. Drawing happens on executors from a range, so nothing is collected.
    """
    spark = df.sparkSession
    positions = dense_positions(df.select(row_id), row_id)
    n = positions.count()
    size = int(n * fraction)
    draws = spark.range(replicates * size).select(
        F.expr(f"id div {max(1, size)}").alias("replicate"), F.expr(f"id % {max(1, size)}").alias("draw")
    )
    drawn = draws.select(
        "replicate",
        F.floor(u01(F.concat_ws("-", "replicate", "draw"), "boot", seed) * n).cast("bigint").alias("position"),
    )
    counts = drawn.groupBy("replicate", "position").agg(F.count(F.lit(1)).alias("multiplicity"))
    return counts.join(positions, "position").select("replicate", row_id, "multiplicity")


def dense_positions(df: DataFrame, row_id: str = "row_id", limit: int = SINGLE_TASK_ROWS) -> DataFrame:
    """0-based position of every row in row_id order."""
    from .ordering import running_totals

    ones = df.groupBy(row_id).agg(F.lit(1).cast("bigint").alias("one"))
    return running_totals(ones, row_id, ["one"], limit=limit).select(
        row_id, (F.col("cum_one") - 1).alias("position")
    )
