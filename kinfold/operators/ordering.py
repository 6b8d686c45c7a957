"""Exact order statistics, rank cut-offs and running totals without a single-task sort.

Every global-order question here is answered in two moves: shrink the range of values that can
hold the answer with mergeable sketches and counts, then sort only what is left in that range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import SINGLE_TASK_ROWS, bounded_rows, checkpoint

# Resolution of the quantile sketch used to narrow a range; affects speed only.
_SKETCH = 10_000


def _narrow(df: DataFrame, column: str, ranks: dict[tuple, int], groups: list[str], limit: int, sizes: dict):
    """Per group, a closed value range that holds the wanted rank, and the rows below it.

    Each pass is one sketch and one counting scan, both with map-side aggregation. The sketch
    proposes a range around the rank and a pivot inside it; exact counts decide which of the
    proposed range, the pivot value alone, or one side of the pivot holds the rank. Every pass
    strictly shrinks the range, and a range of one value ends the search.
    """
    state = {g: {"lo": None, "hi": None, "below": 0, "inside": sizes[g]} for g in ranks}
    keys = [F.col(c) for c in groups]
    slack = 4.0 / _SKETCH
    while True:
        todo = [g for g, s in state.items() if s["inside"] > limit and (s["lo"] is None or s["lo"] < s["hi"])]
        if not todo:
            return state
        scoped = df.where(_in_ranges(column, groups, {g: state[g] for g in todo}))
        at = {g: (ranks[g] - state[g]["below"]) / state[g]["inside"] for g in todo}
        wanted = sorted({min(1.0, max(0.0, p + e)) for p in at.values() for e in (-slack, 0.0, slack)})
        sketch = scoped.groupBy(*keys).agg(
            F.percentile_approx(column, wanted, _SKETCH).alias("q"),
            F.min(column).alias("mn"),
            F.max(column).alias("mx"),
        )
        found = {tuple(r[c] for c in groups): r for r in bounded_rows(sketch, 10_000, "rank groups")}
        trial, pivot = {}, {}
        for g in todo:
            r, p = found[g], at[g]
            look = lambda x: r["q"][wanted.index(min(1.0, max(0.0, x)))]
            trial[g] = {
                "lo": r["mn"] if p - slack <= 0 else look(p - slack),
                "hi": r["mx"] if p + slack >= 1 else look(p + slack),
            }
            pivot[g] = {"lo": look(p), "hi": look(p)}
        tests = scoped.groupBy(*keys).agg(
            F.count_if(_below(column, groups, trial)).alias("b"),
            F.count_if(_in_ranges(column, groups, trial)).alias("i"),
            F.count_if(_below(column, groups, pivot)).alias("pb"),
            F.count_if(_in_ranges(column, groups, pivot)).alias("pi"),
            F.max(F.when(_below(column, groups, pivot), F.col(column))).alias("before"),
            F.min(F.when(_above(column, groups, pivot), F.col(column))).alias("after"),
        )
        for r in bounded_rows(tests, 10_000, "rank groups"):
            g = tuple(r[c] for c in groups)
            s, mn, mx = state[g], found[g]["mn"], found[g]["mx"]
            want, base = ranks[g] - s["below"], s["below"]
            upto = r["pb"] + r["pi"]
            if r["pb"] < want <= upto:
                options = [(r["pi"], pivot[g]["lo"], pivot[g]["hi"], r["pb"])]
            elif want <= r["pb"]:
                options = [(r["pb"], mn, r["before"], 0)]
            else:
                options = [(s["inside"] - upto, r["after"], mx, upto)]
            if r["b"] < want <= r["b"] + r["i"]:
                options.append((r["i"], trial[g]["lo"], trial[g]["hi"], r["b"]))
            inside, lo, hi, below = min(options, key=lambda o: o[0])
            state[g] = {"lo": lo, "hi": hi, "below": base + below, "inside": inside}


def _group_test(groups: list[str], g: tuple):
    test = F.lit(True)
    for c, v in zip(groups, g):
        test = test & F.col(c).eqNullSafe(F.lit(v))
    return test


def _any(groups: list[str], ranges: dict, bound):
    test = F.lit(False)
    for g, s in ranges.items():
        test = test | (_group_test(groups, g) & bound(s))
    return test


def _in_ranges(column: str, groups: list[str], ranges: dict):
    c = F.col(column)
    return _any(
        groups, ranges, lambda s: F.lit(True) if s["lo"] is None else (c >= F.lit(s["lo"])) & (c <= F.lit(s["hi"]))
    )


def _below(column: str, groups: list[str], ranges: dict):
    return _any(groups, ranges, lambda s: F.col(column) < F.lit(s["lo"]))


def _above(column: str, groups: list[str], ranges: dict):
    return _any(groups, ranges, lambda s: F.col(column) > F.lit(s["hi"]))


def rank_cutoffs(
    df: DataFrame,
    key: str,
    row_id: str,
    quotas: dict[tuple, int],
    groups: list[str] | None = None,
    sizes: dict[tuple, int] | None = None,
    limit: int = SINGLE_TASK_ROWS,
) -> dict[tuple, tuple]:
    """For each group, the ``(key, row_id)`` of the row at the wanted 1-based rank.

    Order is by key, then row_id. Only rows whose key could be the answer are ever sorted, and
    groups larger than ``limit`` are narrowed first, on the key and then, inside one tied key,
    on the row id.
    """
    groups = groups or []
    df = df.select(*groups, key, row_id)
    if sizes is None:
        counts = df.groupBy(*groups).count() if groups else df.agg(F.count(F.lit(1)).alias("count"))
        sizes = {tuple(r[c] for c in groups): r["count"] for r in bounded_rows(counts, 10_000, "rank groups")}
    ranks = {g: q for g, q in quotas.items() if 0 < q <= sizes.get(g, 0)}
    if not ranks:
        return {}
    scoped, below = df, {g: 0 for g in ranks}
    if max(sizes[g] for g in ranks) > limit:
        state = _narrow(df, key, ranks, groups, limit, sizes)
        below = {g: s["below"] for g, s in state.items()}
        scoped = df.where(_in_ranges(key, groups, state))
        tied = {g: s for g, s in state.items() if s["inside"] > limit}
        if tied and key != row_id:  # one key value shared by very many rows: decide on the row id
            inner = {g: ranks[g] - s["below"] for g, s in tied.items()}
            id_state = _narrow(
                df.where(_in_ranges(key, groups, tied)), row_id, inner, groups, limit,
                {g: s["inside"] for g, s in tied.items()},
            )
            keep = F.lit(False)
            for g in ranks:
                here = _group_test(groups, g)
                if g in id_state:
                    here = here & (F.col(row_id) >= id_state[g]["lo"]) & (F.col(row_id) <= id_state[g]["hi"])
                    below[g] += id_state[g]["below"]
                keep = keep | here
            scoped = scoped.where(keep)
    wanted = F.lit(False)
    for g, q in ranks.items():
        wanted = wanted | (_group_test(groups, g) & (F.col("_rn") == F.lit(q - below[g])))
    # with one group the window has one partition, which the narrowing above has bounded
    window = Window.partitionBy(*[F.col(c) for c in groups]).orderBy(key, row_id)
    picked = scoped.withColumn("_rn", F.row_number().over(window)).where(wanted)
    return {tuple(r[c] for c in groups): (r[key], r[row_id]) for r in bounded_rows(picked, 10_000, "cut-offs")}


def within_cutoff(key: str, row_id: str, cutoffs: dict[tuple, tuple], groups: list[str] | None = None):
    """Row predicate: at or before its group's cut-off; groups without one are out."""
    groups = groups or []
    test = F.lit(False)
    for g, (k, i) in cutoffs.items():
        at = (F.col(key) < F.lit(k)) | ((F.col(key) == F.lit(k)) & (F.col(row_id) <= F.lit(i)))
        test = test | (_group_test(groups, g) & at)
    return test


# Values that the built-in exact percentile may hold in one buffer.
PERCENTILE_ROWS = 1_000_000
# Quantile brackets that one scan confirms; keeps the generated code of moderate size.
_COUNTS_PER_SCAN = 64


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], limit: int = PERCENTILE_ROWS
) -> dict[str, list[float]]:
    """Exact, linearly interpolated quantiles of several columns.

    Small inputs use the built-in exact percentile for all columns in one job. Larger ones take
    two scans for all columns and quantiles together, a sketch that brackets the two
    neighbouring order statistics of each quantile and a count that confirms the brackets, and
    then rank only the rows inside the brackets. No buffer ever holds a whole column.
    """
    as_double = {c: F.col(c).cast("double") for c in columns}
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    if max(counts[c] for c in columns) <= limit:
        row = df.agg(
            *[F.percentile(v, F.array(*[F.lit(float(p)) for p in probs])).alias(c) for c, v in as_double.items()]
        ).first()
        return {c: list(row[c]) for c in columns}
    targets = []  # (column, 0-based rank)
    for c in columns:
        n = counts[c]
        targets += [(c, r) for r in sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})]
    slack = 4.0 / _SKETCH
    around = {c: sorted({min(1.0, max(0.0, (r + 1) / counts[c] + e)) for d, r in targets if d == c for e in (-slack, slack)}) for c in columns}
    sketch = df.agg(*[F.percentile_approx(v, around[c], _SKETCH).alias(c) for c, v in as_double.items()]).first()
    ranges = []
    for c, r in targets:
        p, q = (r + 1) / counts[c], dict(zip(around[c], sketch[c]))
        lo = None if p - slack <= 0 else q[min(1.0, max(0.0, p - slack))]
        hi = None if p + slack >= 1 else q[min(1.0, max(0.0, p + slack))]
        ranges.append((lo, hi))

    def inside(i: int):
        v, (lo, hi) = as_double[targets[i][0]], ranges[i]
        test = v.isNotNull()
        test = test & (v >= F.lit(lo)) if lo is not None else test
        return test & (v <= F.lit(hi)) if hi is not None else test

    seen: dict[str, int] = {}
    for first in range(0, len(targets), _COUNTS_PER_SCAN):  # each scan reads only the columns it counts
        some = range(first, min(first + _COUNTS_PER_SCAN, len(targets)))
        below_lo = [
            F.count_if(as_double[targets[i][0]] < F.lit(ranges[i][0])) if ranges[i][0] is not None else F.max(F.lit(0).cast("bigint"))
            for i in some
        ]
        tests = [e for i, b in zip(some, below_lo) for e in (b.alias(f"b{i}"), F.count_if(inside(i)).alias(f"i{i}"))]
        seen.update(df.agg(*tests).first().asDict())
    quotas, sizes, stats = {}, {}, {}
    for i, (c, r) in enumerate(targets):
        below, within = seen[f"b{i}"], seen[f"i{i}"]
        if not below < r + 1 <= below + within:  # the sketch missed: search the whole column
            ranges[i], below, within = (None, None), 0, counts[c]
        if ranges[i][0] is not None and ranges[i][0] == ranges[i][1]:
            stats[c, r] = ranges[i][0]
        else:
            quotas[(i,)], sizes[(i,)] = r + 1 - below, within
    if quotas:
        tags = [
            F.when(inside(i), F.struct(F.lit(i).alias("t"), as_double[targets[i][0]].alias("v"))) for (i,) in quotas
        ]
        tagged = df.select(F.inline(F.array_compact(F.array(*tags)))).withColumn("_id", F.lit(0))
        for (i,), (v, _) in rank_cutoffs(tagged, "v", "_id", quotas, ["t"], sizes).items():
            stats[targets[i]] = v
    out = {}
    for c in columns:
        out[c] = []
        for p in probs:
            pos = p * (counts[c] - 1)
            lo, hi = stats[c, math.floor(pos)], stats[c, math.ceil(pos)]
            out[c].append(lo + (hi - lo) * (pos - math.floor(pos)))
    return out


def running_totals(
    df: DataFrame,
    key: str,
    sums: list[str],
    groups: list[str] | None = None,
    limit: int = SINGLE_TASK_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """Add ``cum_<s>``: the total of ``s`` over rows of the group with a key up to this one.

    ``df`` must hold one row per (group, key), which is what a prior groupBy gives, so a hot key
    is a single row here. Beyond ``limit`` rows the table is range-partitioned on (group, key)
    and written out, each part is totalled, and the few part totals become offsets.
    """
    groups = groups or []
    df = checkpoint(df)
    n = df.count()
    if n <= limit:
        w = Window.partitionBy(*[F.col(g) for g in groups]).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(s).over(w).alias(f"cum_{s}") for s in sums])
    parts = parts or max(2, math.ceil(n / (limit / 2)))
    # checkpointing pins the part number, which depends on sampled range bounds
    placed = checkpoint(df.repartitionByRange(parts, *groups, key).withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*groups, "_part").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*[F.col(g) for g in groups]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups, "_part", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    w = Window.partitionBy(*[F.col(g) for g in groups], "_part").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(offsets, [*groups, "_part"])
    return joined.select(*df.columns, *[(F.sum(s).over(w) + F.col(f"_o_{s}")).alias(f"cum_{s}") for s in sums])
