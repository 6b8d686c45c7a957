"""How compact and how separate clusters are."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import batches_of, dot, literal_vector, matrix, pair_distances, total_vectors, values
from ..session import TooLarge, bounded_rows, checkpoint, stored
from .contingency import external_scores
from .geometry import Centroids, dispersion, one_row
from .pairs import cluster_distance_sums, pair_summary
from .regions import Boxes, boxes, fit_regions, with_region
from .sampling import lowest_hash, simple_sample

class DegenerateClustering(ValueError):
    """Fewer than two non-noise clusters."""


def summarise(df: DataFrame) -> Centroids:
    """Centroids and sizes, refused when fewer than two clusters are left without noise."""
    try:
        c = Centroids.fit(df)
    except TooLarge:
        raise
    except ValueError:
        raise DegenerateClustering("need at least 2 non-noise clusters, got 0") from None
    if len(c.ids) < 2:
        raise DegenerateClustering(f"need at least 2 non-noise clusters, got {len(c.ids)}")
    return c


def require_clusters(df: DataFrame) -> dict[int, int]:
    counts = df.where("cluster <> -1").groupBy("cluster").count()
    sizes = {r["cluster"]: r["count"] for r in bounded_rows(counts, 1_000_000, "clusters")}
    if len(sizes) < 2:
        raise DegenerateClustering(f"need at least 2 non-noise clusters, got {len(sizes)}")
    return sizes


def silhouette_rows(df: DataFrame, *, metric: str = "euclidean", sample_size: int | None = None, seed: int = 0) -> DataFrame:
    """``(row_id, cluster, silhouette)`` for non-noise rows, or for a hashed sample of them.

    Within the scored rows the value is exact; a cluster of one row scores 0.
    """
    scored = df.where("cluster <> -1").select("row_id", "features", F.col("cluster").cast("bigint").alias("cluster"))
    if sample_size is not None:
        scored = simple_sample(scored, sample_size, tag="silhouette", seed=seed)
    sizes = require_clusters(scored)
    count = F.create_map(*[F.lit(x).cast("bigint") for kv in sizes.items() for x in kv])
    sums = cluster_distance_sums(scored, metric=metric, n=sum(sizes.values()))
    own = F.col("cluster") == F.col("other")
    n_other = F.element_at(count, F.col("other"))
    parts = sums.groupBy("row_id", "cluster").agg(
        F.max(F.when(own & (n_other > 1), F.col("total") / (n_other - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / n_other)).alias("b"),
    )
    top = F.greatest("a", "b")
    value = F.when(F.col("a").isNull(), 0.0).when(top == 0, 0.0).otherwise((F.col("b") - F.col("a")) / top)
    return parts.select("row_id", "cluster", value.alias("silhouette"))


def scoring_sample(df: DataFrame, sample_size: int | None, seed: int = 0) -> DataFrame:
    """The rows a silhouette without noise would sample, stored once for many labellings of one table."""
    if sample_size is None:
        return df
    return checkpoint(simple_sample(df.select("row_id", "features"), sample_size, tag="silhouette", seed=seed))


def silhouette(df: DataFrame, **kwargs) -> DataFrame:
    return silhouette_rows(df, **kwargs).agg(F.avg("silhouette").alias("silhouette"))


def silhouette_squared(df: DataFrame) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, on all rows in linear time.

    The mean squared distance from x to a cluster is |x|^2 - 2 x.mu + mean |y|^2, so sums per
    cluster replace the pairs. A different number from :func:`silhouette`, hence its own name.
    """
    c = summarise(df)
    index = {k: i for i, k in enumerate(c.ids)}
    points, sizes, norms = c.points, c.sizes, c.norms

    def kernel(batches):
        acc = np.zeros(2)
        for b in batches_of(batches):
            x, cl = matrix(b), values(b, "cluster")
            names, code = np.unique(cl, return_inverse=True)
            own = np.array([index[v] for v in names.tolist()])[code]
            m = np.maximum((x * x).sum(1)[:, None] - 2.0 * (x @ points.T) + norms[None, :], 0.0)
            at = np.arange(len(x))
            n_own = sizes[own]
            a = m[at, own] * n_own / np.maximum(n_own - 1, 1)
            m[at, own] = np.inf
            rest = m.min(axis=1)
            top = np.maximum(a, rest)
            s = np.where((n_own > 1) & (top > 0), (rest - a) / np.where(top > 0, top, 1.0), 0.0)
            acc += (s.sum(), len(s))
        yield (acc,)

    total, n = total_vectors(df.where("cluster <> -1").select("features", "cluster"), kernel, [], cells=2)[()]
    return one_row(df.sparkSession, silhouette_squared=float(total / n))


def _centroid_gaps(points: np.ndarray):
    """Distances from each centroid to all others, a row at a time."""
    for p in points:
        yield np.sqrt(((points - p) ** 2).sum(1))


def davies_bouldin(df: DataFrame) -> DataFrame:
    c = summarise(df)
    spread = dispersion(df, c)
    s = spread[:, 1] / spread[:, 0]
    worst = []
    for i, gap in enumerate(_centroid_gaps(c.points)):
        ratio = np.divide(s + s[i], gap, out=np.zeros_like(gap), where=gap > 0)
        ratio[i] = -np.inf
        worst.append(ratio.max())
    return one_row(df.sparkSession, davies_bouldin=float(np.mean(worst)))


def calinski_harabasz(df: DataFrame) -> DataFrame:
    c = summarise(df)
    n, k = c.sizes.sum(), len(c.ids)
    mean = (c.sizes[:, None] * c.points).sum(0) / n
    between = float((c.sizes * ((c.points - mean) ** 2).sum(1)).sum())
    within = float(dispersion(df, c)[:, 2].sum())
    score = 1.0 if within == 0 else (between / (k - 1)) / (within / (n - k))
    return one_row(df.sparkSession, calinski_harabasz=float(score))


PAIRED_ROWS = 20_000  # rows whose pairs are all looked at for a diameter
MOST_BOXES = 1024
_DIRECTIONS = 16  # beside the axes


def _outermost(members: DataFrame, width: int) -> float:
    """The largest distance among rows of one cluster that lie outermost in some direction: no more than the diameter."""
    ways = np.random.default_rng(0).normal(size=(_DIRECTIONS, width))
    along = [F.col("features")[i] for i in range(min(width, 64))] + [dot(F.col("features"), literal_vector(w)) for w in ways]
    ends = [f("features", a).alias(f"{f.__name__}{i}") for i, a in enumerate(along) for f in (F.max_by, F.min_by)]
    return max(
        (pair_distances(x, x).max() for x in (np.array(r[1:], dtype=float) for r in members.groupBy("cluster").agg(*ends).collect())), default=0.0
    )


def wide_rows(members: DataFrame, n: int, n_clusters: int, passes: int = 2) -> tuple[DataFrame, int]:
    """The rows of ``(row_id, features, cluster)`` that a pair as far apart as a cluster's diameter can hold, and their number.

    A row goes when no box around rows of its cluster reaches as far from it as two rows that are known.
    """
    width = members.select(F.size("features")).first()[0]
    for at in range(passes):
        if n <= PAIRED_ROWS or n_clusters * 2 > MOST_BOXES:
            break
        if at == 0:
            least = _outermost(members, width) ** 2 * (1 - 1e-9)
        placed = stored(with_region(members, fit_regions(members, n, MOST_BOXES // n_clusters, seed=at)))
        around = boxes(placed, "cluster", "region")
        own = around.keys[:, 0]

        def run(batches, around=around, own=own):
            for b in batches_of(batches):
                x, cl = matrix(b), values(b, "cluster")
                keep = np.ones(len(x), bool)
                for c in np.unique(cl):
                    rows = np.flatnonzero(cl == c)
                    part = Boxes(own[own == c], around.low[own == c], around.high[own == c])
                    for i in range(0, len(rows), 4096):
                        at = rows[i : i + 4096]
                        keep[at] = ~(part.reach(x[at]).max(axis=1) < least)
                yield b.filter(pa.array(keep))

        members = stored(placed.drop("region").mapInArrow(run, members.schema))
        before, n = n, members.count()
        if 2 * n > before:
            break
    return members, n


def dunn(df: DataFrame, *, diameter_cap: int | None = None, seed: int = 0) -> DataFrame:
    """Smallest centroid distance over largest cluster diameter.

    Diameters are exact; with ``diameter_cap`` they come from a hashed sample of that many rows per cluster.
    """
    c = summarise(df)
    members = df.where("cluster <> -1").select("row_id", "features", F.col("cluster").cast("bigint").alias("cluster"))
    closest = min(np.delete(gap, i).min() for i, gap in enumerate(_centroid_gaps(c.points)))
    n = int(c.sizes.sum())
    if diameter_cap is not None:
        sizes = {(i,): int(m) for i, m in zip(c.ids, c.sizes)}
        members = lowest_hash(
            members, {g: diameter_cap for g in sizes}, groups=["cluster"], tag="diameter", seed=seed, sizes=sizes
        )
        n = sum(min(m, diameter_cap) for m in sizes.values())
    members, n = wide_rows(members, n, len(c.ids))
    widest = pair_summary(members, within_only=True, n=n).agg(F.max("farthest").alias("d"))
    return widest.select(
        F.when(F.coalesce(F.col("d"), F.lit(0.0)) == 0, 0.0).otherwise(F.lit(float(closest)) / F.col("d")).alias("dunn")
    )


@dataclass(frozen=True)
class Options:
    """What scores can be told; each takes what concerns it. Samples are the caller's choice."""

    metric: str = "euclidean"
    sample_size: int | None = None
    diameter_cap: int | None = None
    seed: int = 0


@dataclass(frozen=True)
class Score:
    """A score by name. ``of`` maps labelled vectors to one row; without it the score is read off contingency cells."""

    higher_is_better: bool = True
    of: Callable[[DataFrame, Options], DataFrame] | None = None


SCORES = {
    "silhouette": Score(of=lambda df, o: silhouette(df, metric=o.metric, sample_size=o.sample_size, seed=o.seed)),
    "davies_bouldin": Score(False, of=lambda df, o: davies_bouldin(df)),
    "calinski_harabasz": Score(of=lambda df, o: calinski_harabasz(df)),
    "dunn": Score(of=lambda df, o: dunn(df, diameter_cap=o.diameter_cap, seed=o.seed)),
    "ari": Score(),
    "nmi": Score(),
    "ami": Score(),
    "v_measure": Score(),
    "purity": Score(),
}
INTERNAL = tuple(n for n, s in SCORES.items() if s.of)
EXTERNAL = tuple(n for n, s in SCORES.items() if not s.of)


def _entry(name: str, among: tuple[str, ...]) -> Score:
    if name not in among:
        raise KeyError(f"unknown metric {name!r}; there are {', '.join(among)}")
    return SCORES[name]


def score_internal(name: str, df: DataFrame, **options) -> float:
    """One internal score of labelled vectors. An option that no score knows is an error."""
    return float(_entry(name, INTERNAL).of(df, Options(**options)).first()[0])


def score_external(names: Sequence[str], cells: DataFrame) -> dict[str, float]:
    """External scores of contingency cells ``(t, p, n)``, all from one pass."""
    for name in names:
        _entry(name, EXTERNAL)
    row = external_scores(cells, ami="ami" in names).first()
    return {name: float(row[name]) for name in names}


def higher_is_better(name: str) -> bool:
    return _entry(name, INTERNAL + EXTERNAL).higher_is_better
