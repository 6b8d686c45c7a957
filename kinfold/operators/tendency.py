"""Is there any cluster structure at all? Hopkins statistics, a null control and the VAT order."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import u01
from ..functions.vectors import pair_distances
from ..session import TooLarge
from .geometry import log_sum_exp, width
from .pairs import query_neighbours, tree_edges
from .sampling import simple_sample
from .spanning import minimum_tree

MAX_PROBES = 20_000
MAX_IMAGE = 5_000
MAX_PIXELS = 1_000  # rows of a drawn picture, which has a cell per pair


def box_of(df: DataFrame) -> list[tuple[float, float]]:
    d = width(df)
    f = F.col("features")
    row = df.agg(*[g(f[i]).alias(f"{n}{i}") for i in range(d) for g, n in ((F.min, "a"), (F.max, "b"))]).first()
    return [(row[f"a{i}"], row[f"b{i}"]) for i in range(d)]


def uniform_rows(spark, n: int, box: list[tuple[float, float]], *, tag: str = "uniform", seed: int = 0) -> DataFrame:
    """``n`` points spread evenly over the box, made on executors from hashed row numbers."""
    cols = [F.lit(lo) + u01("row_id", f"{tag}{j}", seed) * F.lit(hi - lo) for j, (lo, hi) in enumerate(box)]
    return spark.range(n).select(F.col("id").alias("row_id")).withColumn("features", F.array(*cols))


def probe_count(n: int, wanted: int) -> int:
    return wanted if wanted < n else max(2, n // 10)


def hopkins_distances(df: DataFrame, m: int, *, seed: int = 0, n: int | None = None) -> DataFrame:
    """``(kind, row_id, distance)``: 'real' rows to their nearest other row, 'uniform' points to any row.

    Real and uniform probes are searched in one pass over the data.
    """
    spark = df.sparkSession
    real = simple_sample(df.select("row_id", "features"), m, tag="hopkins", seed=seed)
    fake = uniform_rows(spark, m, box_of(df), tag="probe", seed=seed).withColumn("row_id", -1 - F.col("row_id"))
    near = query_neighbours(real.unionByName(fake), df, 1)
    return near.select(
        F.when(F.col("row_id") < 0, "uniform").otherwise("real").alias("kind"), "row_id", "distance"
    )


def hopkins(df: DataFrame, *, sample_size: int | None = None, seed: int = 0) -> float:
    """Near 0.5 on evenly spread data, towards 1 when rows cluster.

    Distances are raised to the number of dimensions, so the sums are taken in log space.
    """
    n = df.count()
    m = probe_count(n, sample_size or min(MAX_PROBES, max(2, n // 10)))
    if m > MAX_PROBES:
        raise TooLarge(f"{m} probes exceed the limit of {MAX_PROBES}")
    d = width(df)
    rows = hopkins_distances(df, m, seed=seed, n=n).toArrow()
    kind, dist = np.array(rows.column("kind").to_pylist()), rows.column("distance").to_numpy()
    with np.errstate(divide="ignore"):
        u = log_sum_exp(d * np.log(dist[kind == "uniform"]))
        w = log_sum_exp(d * np.log(dist[kind == "real"]))
    if math.isinf(w) and w < 0:
        return 1.0 if not math.isinf(u) else 0.5
    return float(1.0 / (1.0 + math.exp(min(700.0, w - u))))


def null_control(df: DataFrame, *, repeats: int = 5, sample_size: int | None = None, seed: int = 0) -> DataFrame:
    """The same statistic on even noise in the data's own box: one row per repeat, with mean and population deviation."""
    n, box = df.count(), box_of(df)
    spark = df.sparkSession
    values = []
    for r in range(repeats):
        noise = uniform_rows(spark, n, box, tag="null", seed=seed + r)
        values.append(hopkins(noise, sample_size=sample_size, seed=seed + r))
    mean, std = float(np.mean(values)), float(np.std(values))
    return spark.createDataFrame(
        [(r, v, mean, std) for r, v in enumerate(values)], "repeat int, hopkins double, mean double, std double"
    )


def repeated_hopkins(df: DataFrame, *, repeats: int = 5, sample_size: int | None = None, threshold: float = 0.6, seed: int = 0) -> DataFrame:
    """One row: mean and population deviation over repeats, and whether the mean passes."""
    values = [hopkins(df, sample_size=sample_size, seed=seed + r) for r in range(repeats)]
    row = [(repeats, float(np.mean(values)), float(np.std(values)), threshold, bool(np.mean(values) >= threshold), values)]
    return df.sparkSession.createDataFrame(
        row, "repeats int, mean double, std double, threshold double, passed boolean, hopkins_values array<double>"
    )


def vat_order(df: DataFrame, *, max_rows: int = MAX_IMAGE) -> DataFrame:
    """``(row_id, position)``: the order in which a spanning tree grows from the most remote row.

    The order exists to draw an n x n picture, so a table beyond ``max_rows`` is refused: sample
    it, or pass prototypes of the whole table.
    """
    n = df.count()
    if n > max_rows:
        raise TooLarge(f"{n} rows make no readable picture; the limit is {max_rows}")
    spark = df.sparkSession
    start = most_remote(df, n)
    tree = minimum_tree(tree_edges(df, n=n)).toArrow().to_pydict()
    links: dict[int, list] = {}
    for u, v, w in zip(tree["u"], tree["v"], tree["w"]):
        links.setdefault(u, []).append((w, v))
        links.setdefault(v, []).append((w, u))
    order, seen, frontier = [], {start}, []
    here = start
    while True:
        order.append(here)
        for w, v in links.get(here, []):
            if v not in seen:
                heapq.heappush(frontier, (w, v))
        while frontier and frontier[0][1] in seen:
            heapq.heappop(frontier)
        if not frontier:
            break
        here = heapq.heappop(frontier)[1]
        seen.add(here)
    return spark.createDataFrame([(r, i) for i, r in enumerate(order)], "row_id bigint, position int")


def most_remote(df: DataFrame, n: int | None = None) -> int:
    """The row with the largest total distance to all others."""
    from .pairs import cluster_distance_sums

    sums = cluster_distance_sums(df.select("row_id", "features", F.lit(0).cast("bigint").alias("cluster")), n=n)
    return sums.orderBy(F.desc("total"), "row_id").first()["row_id"]


def prototype_rows(spark, protos) -> DataFrame:
    """Prototypes of a whole table as rows, for operators that draw one row per pixel."""
    return spark.createDataFrame(
        [(i, [float(v) for v in p]) for i, p in enumerate(protos.points)], "row_id bigint, features array<double>"
    )


def reordered_image(df: DataFrame, order: DataFrame, *, max_rows: int = MAX_PIXELS) -> DataFrame:
    """``(i, j, distance)`` for a bounded picture, both ends renumbered by position, i < j.

    The picture's rows are bounded by the check; its lines are drawn in parallel.
    """
    placed = df.join(order, "row_id").select("position", "features")
    n = placed.count()
    if n > max_rows:
        raise TooLarge(f"{n} rows make no readable picture; the limit is {max_rows}")
    t = placed.orderBy("position").toArrow()
    x = t.column("features").combine_chunks().flatten().to_numpy().astype(float).reshape(n, -1)

    def draw(batches):
        for b in batches:
            for i in b.column(0).to_pylist():
                d = pair_distances(x[i : i + 1], x[i + 1 :])[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(d), i)), pa.array(np.arange(i + 1, n)), pa.array(d)], names=["i", "j", "distance"]
                )

    return df.sparkSession.range(n).mapInArrow(draw, "i bigint, j bigint, distance double")
