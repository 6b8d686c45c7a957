"""Work over all pairs of rows, done block against block and reduced inside each task.

Rows are hashed into blocks of bounded size and every two blocks meet in exactly one task, so
the result is exact for any table size, no side is broadcast, and no pair is ever emitted: a task
returns sums, extremes, nearest neighbours or tree edges. A row is sent once per block, so blocks are
few and as large as a task can hold; inside a task they are worked through in tiles, whose
distances are held one at a time and whose results are merged as they come.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import batches_of, matrix, pair_distances, values
from ..session import BROADCAST_CELLS
from .sorted_pairs import MOST_CELLS, manhattan_totals

BLOCK_ROWS = 1024  # rows on either side of a tile
BLOCK_CELLS = 1 << 22  # doubles of features in a block (32 MiB), two of which meet in a task
FEW_BLOCKS = 16  # blocks that a table is dealt to, whatever its size, before they have to be larger than that
_PENDING_ROWS = 1 << 20  # rows of results that wait for being merged
_REACHED = 8  # edges per row of two tiles above which their tree is built at once


class Block:
    """One side of a block pair as arrays."""

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        self.rows = table.num_rows
        self.ids = self.column("row_id")
        col = self.table.column("features")
        flat = col.combine_chunks().flatten() if self.rows else pa.array([], pa.float64())
        self.x = flat.to_numpy(zero_copy_only=False).astype(float).reshape(self.rows, -1) if self.rows else np.empty((0, 0))

    def column(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()


def _tiles(table: pa.Table, rows: int, by: str) -> list[Block]:
    """A block cut into tiles; rows with one value of ``by`` stay together."""
    if table.num_rows <= rows:
        return [Block(table)]
    if by == "row_id":
        return [Block(table.slice(i, rows)) for i in range(0, table.num_rows, rows)]
    table = table.sort_by(by)
    key = table.column(by).to_numpy()
    starts, last = [0], 0
    for i in [*np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]:
        if i - starts[-1] > rows and last > starts[-1]:
            starts.append(last)
        last = int(i)
    return [Block(table.slice(i, j - i)) for i, j in zip(starts, [*starts[1:], len(key)])]


def tile_pairs(left: list[Block], right: list[Block], same: bool) -> Iterator[tuple[Block, Block, bool]]:
    """Every unordered pair of tiles; the last item tells whether both are one tile."""
    for i, a in enumerate(left):
        for b in left[i:] if same else right:
            yield a, b, a is b


def _block_count(df: DataFrame, n: int, block_rows: int) -> int:
    """One block per tile for a small table, else enough to keep all cores busy and each within ``BLOCK_CELLS``."""
    blocks = max(1, math.ceil(n / block_rows))
    few = max(FEW_BLOCKS, math.isqrt(8 * df.sparkSession.sparkContext.defaultParallelism))
    if blocks <= few:
        return blocks
    width = df.agg(F.max(F.size("features"))).first()[0] or 1
    return min(blocks, max(few, math.ceil(n * max(1, width) / BLOCK_CELLS)))


def block_map(
    df: DataFrame,
    work: Callable[[list[Block], list[Block], bool], pa.Table],
    schema: str,
    *,
    extra: list[str] | None = None,
    n: int | None = None,
    block_rows: int = BLOCK_ROWS,
    by: str = "row_id",
) -> DataFrame:
    """Run ``work(left, right, same)`` on the tiles of every unordered pair of blocks.

    Rows with one value of ``by`` share a block and a tile, so those of another column than the id may be larger.
    """
    n = df.count() if n is None else n
    blocks = _block_count(df, n, block_rows)
    columns = ["row_id", "features", *(extra or [])]
    mine = df.select(*columns, F.pmod(F.xxhash64(by), F.lit(blocks)).cast("int").alias("_b"))
    meet = mine.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keyed = meet.select(*columns, "_b", F.least("_b", "_o").alias("_gi"), F.greatest("_b", "_o").alias("_gj"))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        left = _tiles(table.filter(pc.equal(table.column("_b"), i)), block_rows, by)
        if i == j:
            return work(left, left, True)
        return work(left, _tiles(table.filter(pc.equal(table.column("_b"), j)), block_rows, by), False)

    return keyed.groupBy("_gi", "_gj").applyInArrow(run, schema)


def pair_map(
    df: DataFrame,
    kernel: Callable[[Block, Block, bool], pa.Table],
    schema: str,
    *,
    merge: Callable[[pa.Table], pa.Table] = lambda found: found,
    **options,
) -> DataFrame:
    """Run ``kernel(left, right, same)`` once for every unordered pair of tiles.

    ``merge`` shortens the results of several pairs of tiles to one that stands for all of them.
    """

    def work(left: list[Block], right: list[Block], same: bool) -> pa.Table:
        found, rows, merged = [], 0, 0
        for a, b, one in tile_pairs(left, right, same):
            found.append(kernel(a, b, one))
            rows += found[-1].num_rows
            if rows - merged > max(_PENDING_ROWS, merged):
                found = [merge(pa.concat_tables(found))]
                rows = merged = found[0].num_rows
        return found[0] if len(found) == 1 else merge(pa.concat_tables(found))

    return block_map(df, work, schema, **options)


def grouped(keys: list[str], **how: str) -> Callable[[pa.Table], pa.Table]:
    """A merge of results that keeps ``keys`` and takes the named sum, min or max of the other columns."""

    def merge(found: pa.Table) -> pa.Table:
        out = found.group_by(keys).aggregate(list(how.items()))
        return out.rename_columns([*keys, *how] if out.column_names[0] == keys[0] else [*how, *keys]).select(found.column_names)

    return merge


def _lowest(ids: np.ndarray, other: np.ndarray, dist: np.ndarray, k: int):
    """Per row the k nearest columns of a distance block; at equal distance the lower id comes first."""
    order = np.argsort(other, kind="stable")
    other, dist = other[order], dist[:, order]
    keep = np.isfinite(dist)
    if k < dist.shape[1]:
        kth = np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
        nearer, tied = dist < kth, dist == kth
        room = k - nearer.sum(axis=1, keepdims=True)
        keep &= nearer | (tied & (np.cumsum(tied, axis=1) <= room))
    at, near = np.nonzero(keep)
    return ids[at], other[near], dist[at, near]


def _top_k(found: DataFrame, k: int) -> DataFrame:
    """Merge per-task candidates; the window keeps only k rows per query before the shuffle."""
    w = Window.partitionBy("row_id").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


NEIGHBOUR_SCHEMA = "row_id bigint, neighbour bigint, distance double"


def _neighbour_table(parts) -> pa.Table:
    a, b, d = (np.concatenate(x) if x else np.empty(0) for x in zip(*parts)) if parts else (np.empty(0),) * 3
    return pa.table(
        {"row_id": pa.array(a.astype(np.int64)), "neighbour": pa.array(b.astype(np.int64)), "distance": pa.array(d.astype(float))}
    )


def self_neighbours(df: DataFrame, k: int, *, metric: str = "euclidean", n: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(row_id, neighbour, distance, rank)``: exact k nearest other rows of every row."""

    def work(left: list[Block], right: list[Block], same: bool) -> pa.Table:
        best = {id(t): _Best(t, k) for t in (left if same else left + right) if t.rows}
        for a, b, one in tile_pairs(left, right, same):
            if not a.rows or not b.rows:
                continue
            dist = pair_distances(a.x, b.x, metric)
            if one:
                np.fill_diagonal(dist, np.inf)
            best[id(a)].see(b.ids, dist)
            if not one:
                best[id(b)].see(a.ids, dist.T)
        return _neighbour_table([t.found() for t in best.values()])

    return _top_k(block_map(df, work, NEIGHBOUR_SCHEMA, n=n, block_rows=block_rows), k)


class _Best:
    """The k nearest of a tile's rows among all tiles seen so far, by distance and then id."""

    def __init__(self, tile: Block, k: int):
        self.ids, self.k = tile.ids, k
        self.near = np.full((tile.rows, k), np.iinfo(np.int64).max)
        self.dist = np.full((tile.rows, k), np.inf)

    def see(self, other: np.ndarray, dist: np.ndarray) -> None:
        last, k = self.dist[:, -1], self.k
        if np.isinf(last).any() and len(other) >= k:  # of k parts of the tile, each holds a row as near as its nearest
            parts = np.fmin.reduceat(dist, np.arange(k) * len(other) // k, axis=1).max(axis=1)
            last = np.fmin(last, parts)
        j, i = np.nonzero(dist.T <= last) if dist.T.flags.c_contiguous else np.nonzero(dist <= last[:, None])[::-1]
        if len(i) > 8 * k * len(last):  # many at one distance
            i, near, d = _lowest(np.arange(len(last)), other, dist, k)
        else:
            near, d = other[j], dist[i, j]
        last = self.dist[i, -1]
        better = (d < last) | ((d == last) & (near < self.near[i, -1]) & np.isfinite(d))
        i, near, d = i[better], near[better], d[better]
        if not len(i):
            return
        rows = np.unique(i)
        old = np.repeat(rows, k)
        parts = [(old, self.near[rows].ravel(), self.dist[rows].ravel()), (i, near, d)]
        _, near, d = _merge(parts, k)
        self.near[rows], self.dist[rows] = near.reshape(-1, k), d.reshape(-1, k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j = np.nonzero(np.isfinite(self.dist))
        return self.ids[i], self.near[i, j], self.dist[i, j]


def query_neighbours(
    queries: DataFrame, data: DataFrame, k: int, *, metric: str = "euclidean", exclude_self: bool = True,
    block_rows: int = BLOCK_ROWS, budget: int = BROADCAST_CELLS // 8,
) -> DataFrame:
    """Exact k nearest rows of ``data`` for every query.

    A query set within the budget travels to the data, which is then scanned once in place.
    A larger one is met block by block like any other pair of tables.
    """
    row = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("d")).first()
    if (row["n"] or 0) * (row["d"] or 0) <= budget:
        small = queries.select("row_id", "features").toArrow()
        qid = small.column("row_id").to_numpy()
        qx = small.column("features").combine_chunks().flatten().to_numpy().astype(float).reshape(len(qid), -1)

        def scan(batches):
            best: list[list] = []
            for b in batches_of(batches):
                x, ids = matrix(b), values(b, "row_id")
                for i in range(0, len(x), block_rows):
                    dist = pair_distances(qx, x[i : i + block_rows], metric)
                    if exclude_self:
                        dist[qid[:, None] == ids[None, i : i + block_rows]] = np.inf
                    best.append(_lowest(qid, ids[i : i + block_rows], dist, k))
                    if len(best) >= 16:
                        best = [_merge(best, k)]
            if best:
                yield from _neighbour_table([_merge(best, k)]).to_batches()

        return _top_k(data.select("row_id", "features").mapInArrow(scan, NEIGHBOUR_SCHEMA), k)

    n_data = data.count()
    qb, db = math.ceil(row["n"] / block_rows), max(1, math.ceil(n_data / block_rows))
    q = queries.select("row_id", "features", F.lit(True).alias("_q"), F.expr(f"pmod(xxhash64(row_id), {qb}L)").alias("_gi"))
    q = q.withColumn("_gj", F.explode(F.expr(f"sequence(0L, {db - 1}L)")))
    x = data.select("row_id", "features", F.lit(False).alias("_q"), F.expr(f"pmod(xxhash64(row_id), {db}L)").alias("_gj"))
    x = x.withColumn("_gi", F.explode(F.expr(f"sequence(0L, {qb - 1}L)")))

    def meet(table: pa.Table) -> pa.Table:
        left = Block(table.filter(table.column("_q")))
        right = Block(table.filter(pc.invert(table.column("_q"))))
        if not left.rows or not right.rows:
            return _neighbour_table([])
        dist = pair_distances(left.x, right.x, metric)
        if exclude_self:
            dist[left.ids[:, None] == right.ids[None, :]] = np.inf
        return _neighbour_table([_lowest(left.ids, right.ids, dist, k)])

    return _top_k(q.unionByName(x).groupBy("_gi", "_gj").applyInArrow(meet, NEIGHBOUR_SCHEMA), k)


def _merge(parts, k: int):
    a, b, d = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((b, d, a))
    a, b, d = a[order], b[order], d[order]
    start = np.r_[True, a[1:] != a[:-1]]
    rank = np.arange(len(a)) - np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
    keep = rank < k
    return a[keep], b[keep], d[keep]


def cluster_distance_sums(df: DataFrame, *, metric: str = "euclidean", n: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(row_id, cluster, other, total)``: summed distance from each row to each cluster's rows."""

    def side(a: Block, b: Block, dist: np.ndarray) -> pa.Table:
        own, cl = a.column("cluster"), b.column("cluster")
        names, code = np.unique(cl, return_inverse=True)
        onehot = np.zeros((b.rows, len(names)))
        onehot[np.arange(b.rows), code] = 1.0
        total = dist @ onehot
        return pa.table(
            {
                "row_id": pa.array(np.repeat(a.ids, len(names)).astype(np.int64)),
                "cluster": pa.array(np.repeat(own, len(names)).astype(np.int64)),
                "other": pa.array(np.tile(names, a.rows).astype(np.int64)),
                "total": pa.array(total.ravel()),
            }
        )

    def kernel(left: Block, right: Block, same: bool) -> pa.Table:
        if not left.rows or not right.rows:
            return pa.table({"row_id": pa.array([], pa.int64()), "cluster": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "total": pa.array([], pa.float64())})
        dist = pair_distances(left.x, right.x, metric)
        if same:
            np.fill_diagonal(dist, 0.0)
            return side(left, left, dist)
        return pa.concat_tables([side(left, right, dist), side(right, left, dist.T)])

    parts = pair_map(df, kernel, "row_id bigint, cluster bigint, other bigint, total double", extra=["cluster"], n=n, block_rows=block_rows,
                     merge=grouped(["row_id", "cluster", "other"], total="sum"))
    return parts.groupBy("row_id", "cluster", "other").agg(F.sum("total").alias("total"))


_SUMMARY = [
    ("cluster_a", pa.int64()), ("cluster_b", pa.int64()), ("pairs", pa.int64()), ("total", pa.float64()), ("nearest", pa.float64()), ("farthest", pa.float64()),
]


def _by_cluster(tile: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(clusters, where each begins and the last ends, rows in that order)``."""
    own = tile.column("cluster")
    order = np.argsort(own, kind="stable")
    order = order[own[order] == own[order]]  # rows without a cluster pair with nothing
    names, first = np.unique(own[order], return_index=True)
    return names.astype(np.int64), np.r_[first, len(order)].astype(np.int64), tile.x[order]


def _summarise(parts: list[list], a, b, at_a, at_b, dist: np.ndarray, same: bool) -> None:
    """Add a record per pair of clusters whose rows and columns lie together; of one tile only pairs above the diagonal count."""
    if not len(a) or not len(b):
        return
    pairs = np.outer(np.diff(at_a), np.diff(at_b))
    high = low = dist
    if same:
        below = np.tri(len(dist), dtype=bool)
        low = np.where(below, np.inf, dist)
        high = np.where(below, -np.inf, dist)
        dist = np.where(below, 0.0, dist)
        size = np.diff(at_a)
        pairs = np.triu(pairs, 1) + np.diag(size * (size - 1) // 2)
    folds = [f.reduceat(f.reduceat(d, at_b[:-1], axis=1), at_a[:-1], axis=0) for f, d in ((np.add, dist), (np.minimum, low), (np.maximum, high))]
    i, j = np.nonzero(pairs)
    for out, v in zip(parts, (np.minimum(a[i], b[j]), np.maximum(a[i], b[j]), pairs[i, j], *(f[i, j] for f in folds))):
        out.append(v)


def pair_summary(
    df: DataFrame, *, metric: str = "euclidean", within_only: bool = False, between_only: bool = False, n: int | None = None, block_rows: int = BLOCK_ROWS,
    extremes: bool = True,
) -> DataFrame:
    """``(cluster_a, cluster_b, pairs, total, nearest, farthest)`` over all unordered row pairs, or those within or between clusters.

    Without ``extremes`` the last two columns are left out; Manhattan totals then come from the order of the values of each
    column, not pair by pair.
    """
    if not extremes:
        found = _sorted_summary(df) if metric in ("manhattan", "l1") else None
        found = pair_summary(df, metric=metric, n=n, block_rows=block_rows).drop("nearest", "farthest") if found is None else found
        if within_only:
            found = found.where("cluster_a = cluster_b")
        return found.where("cluster_a <> cluster_b") if between_only else found

    def kernel(left: Block, right: Block, same: bool) -> pa.Table:
        parts = [[] for _ in _SUMMARY]
        if left.rows and right.rows:
            (a, at_a, x), (b, at_b, y) = _by_cluster(left), _by_cluster(right)
            if within_only:
                for u, v in zip(*(np.flatnonzero(np.isin(p, q)) for p, q in ((a, b), (b, a)))):
                    rows, cols = slice(at_a[u], at_a[u + 1]), slice(at_b[v], at_b[v + 1])
                    _summarise(parts, a[u : u + 1], b[v : v + 1], at_a[u : u + 2] - at_a[u], at_b[v : v + 2] - at_b[v],
                               pair_distances(x[rows], y[cols], metric), same)
            else:
                _summarise(parts, a, b, at_a, at_b, pair_distances(x, y, metric), same)
        return pa.table({c: pa.array(np.concatenate(v) if v else [], t) for (c, t), v in zip(_SUMMARY, parts)})

    schema = "cluster_a bigint, cluster_b bigint, pairs bigint, total double, nearest double, farthest double"
    merge = grouped(["cluster_a", "cluster_b"], pairs="sum", total="sum", nearest="min", farthest="max")
    parts = pair_map(df, kernel, schema, extra=["cluster"], n=n, block_rows=block_rows, merge=merge)
    parts = parts.where("cluster_a <> cluster_b") if between_only else parts
    return parts.groupBy("cluster_a", "cluster_b").agg(
        F.sum("pairs").alias("pairs"), F.sum("total").alias("total"), F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest")
    )


def _sorted_summary(df: DataFrame) -> DataFrame | None:
    sizes = df.where(F.col("cluster").isNotNull()).groupBy(F.col("cluster").cast("bigint").alias("cluster")).agg(F.count("*").alias("n"))
    table = sizes.limit(MOST_CELLS + 1).orderBy("cluster").toArrow()
    totals = manhattan_totals(df, table) if table.num_rows <= MOST_CELLS else None
    if totals is None:
        return None
    known = df.sparkSession.createDataFrame(table)
    a, b = (known.select(F.col("cluster").alias(f"cluster_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = F.when(F.col("cluster_a") == F.col("cluster_b"), F.expr("n_a * (n_a - 1) div 2")).otherwise(F.expr("n_a * n_b"))
    met = a.join(F.broadcast(b), F.col("cluster_a") <= F.col("cluster_b")).withColumn("pairs", pairs).where("pairs > 0")
    return met.join(totals, ["cluster_a", "cluster_b"], "left").select("cluster_a", "cluster_b", "pairs", F.coalesce("total", F.lit(0.0)).alias("total"))


def tree_edges(
    df: DataFrame, *, metric: str = "euclidean", core: bool = False, reach: bool = False, n: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(u, v, w)``: the union of the minimum spanning trees of all block pairs.

    The tree of the whole graph is contained in it, because an edge that is heaviest on a cycle
    within one block pair is heaviest on that cycle in the whole graph too. With ``core`` the
    weight is the mutual reachability of rows that carry a ``core`` distance.

    With ``reach`` rows carry a ``part`` and how far they are ``off`` from a row of it that all its rows can reach by edges of
    that weight at most. An edge inside of a part that is heavier than both its ends are off closes a cycle of lighter ones;
    of two tiles all other edges are kept, or where they are many the minimum spanning tree of those between the tiles.
    """

    def kernel(left: Block, right: Block, same: bool) -> pa.Table:
        if reach:
            i, j, w = reached(left, right, same)
            a, b = left.ids[i], right.ids[j]
            return pa.table({"u": pa.array(np.minimum(a, b)), "v": pa.array(np.maximum(a, b)), "w": pa.array(w)})
        if same:
            x, ids = left.x, left.ids
            c = left.column("core") if core else None
        else:
            parts = [b for b in (left, right) if b.rows]
            if not parts:
                return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "w": pa.array([], pa.float64())})
            x, ids = np.concatenate([b.x for b in parts]), np.concatenate([b.ids for b in parts])
            c = np.concatenate([b.column("core") for b in parts]) if core else None
        order = np.argsort(ids)
        x, ids = x[order], ids[order]
        dist = pair_distances(x, x, metric)
        if core:
            c = c[order]
            dist = np.maximum(dist, np.maximum.outer(c, c))
        u, v, w = _dense_tree(dist)
        a, b = ids[u], ids[v]
        return pa.table({"u": pa.array(np.minimum(a, b)), "v": pa.array(np.maximum(a, b)), "w": pa.array(w)})

    def reached(left: Block, right: Block, same: bool):
        if not left.rows or not right.rows:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
        dist = pair_distances(left.x, right.x, metric)
        cores = (left.column("core"), right.column("core")) if core else None
        found = _within_reach(left, right, dist, cores, same)
        if found is None:
            weight = dist if cores is None else np.maximum(dist, np.maximum.outer(*cores))
            found = _dense_tree(weight) if same else _cross_tree(weight)
        return found

    extra = [*(["core"] if core else []), *(["part", "off"] if reach else [])]
    edges = pair_map(df, kernel, "u bigint, v bigint, w double", extra=extra, n=n, block_rows=block_rows, merge=_forest)
    return edges.groupBy("u", "v").agg(F.min("w").alias("w"))


def _within_reach(left: Block, right: Block, dist: np.ndarray, cores, same: bool):
    """``(rows, columns, weights)`` that may be edges of the tree, or None if they are many."""
    keep = dist <= left.column("off")[:, None]
    keep |= dist <= right.column("off")
    keep |= left.column("part")[:, None] != right.column("part")
    if same:
        keep = np.triu(keep, 1)
    if np.count_nonzero(keep) > _REACHED * (left.rows + right.rows):
        return None
    i, j = np.nonzero(keep)
    w = dist[i, j]
    if cores is not None:
        w = np.maximum(w, np.maximum(cores[0][i], cores[1][j]))
        known = (w <= np.maximum(left.column("off")[i], right.column("off")[j])) | (left.column("part")[i] != right.column("part")[j])
        i, j, w = i[known], j[known], w[known]
    return i, j, w


def _forest(edges: pa.Table) -> pa.Table:
    """The edges of a minimum spanning forest, ties by (w, u, v): every component takes its first edge, until none has one."""
    u, v, w = (edges.column(c).to_numpy() for c in ("u", "v", "w"))
    order = np.lexsort((v, u, w))
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)][order], ends[len(u) :][order]
    at, top, chosen = order, np.arange(len(names)), []
    while True:
        a, b = top[a], top[b]
        out = a != b
        a, b, at = a[out], b[out], at[out]
        if not len(a):
            break
        first = np.full(len(names), len(a))
        np.minimum.at(first, a, np.arange(len(a)))
        np.minimum.at(first, b, np.arange(len(a)))
        mine = np.flatnonzero(first < len(a))
        taken = first[mine]
        chosen.append(at[np.unique(taken)])
        # everyone hooks to the other end; of two that chose each other the smaller one stays
        top = np.arange(len(names))
        top[mine] = a[taken] + b[taken] - mine
        back = top[top[mine]] == mine
        stay = mine[back & (mine < top[mine])]
        top[stay] = stay
        while True:
            further = top[top]
            if (further == top).all():
                break
            top = further
    keep = np.sort(np.concatenate(chosen)) if chosen else np.empty(0, dtype=np.int64)
    return edges.take(pa.array(keep))


def _dense_tree(dist: np.ndarray):
    """Spanning tree of one bounded block; equal weights are settled by row order."""
    n = len(dist)
    link = np.zeros(n, dtype=np.int64)
    cost, bar = np.full(n, np.inf), np.full(n, np.inf)  # ``bar`` is below everything once a row is inside
    us, vs, ws = np.empty(n - 1, dtype=np.int64), np.empty(n - 1, dtype=np.int64), np.empty(n - 1)
    here = 0
    for i in range(n - 1):
        cost[here], bar[here] = np.inf, -np.inf
        row = dist[here]
        closer = np.flatnonzero(row < bar)
        cost[closer] = bar[closer] = row[closer]
        link[closer] = here
        here = int(cost.argmin())
        us[i], vs[i], ws[i] = link[here], here, cost[here]
    return us, vs, ws


def _cross_tree(dist: np.ndarray):
    """Spanning tree, or forest, of the edges between rows and columns of one bounded block."""
    sides = (dist, np.ascontiguousarray(dist.T))
    link = [np.zeros(k, dtype=np.int64) for k in dist.shape]
    cost, bar = ([np.full(k, np.inf) for k in dist.shape] for _ in range(2))  # ``bar`` is below everything once a row is inside
    found, side, here = [], 0, 0
    while True:
        cost[side][here], bar[side][here] = np.inf, -np.inf
        row, other = sides[side][here], 1 - side
        closer = np.flatnonzero(row < bar[other])
        cost[other][closer] = bar[other][closer] = row[closer]
        link[other][closer] = here
        near = [int(c.argmin()) for c in cost]
        side = int(cost[1][near[1]] < cost[0][near[0]])
        here = near[side]
        if np.isinf(cost[side][here]):  # nothing else is joined to these
            left = np.flatnonzero(bar[0] == np.inf)
            if not len(left):
                break
            side, here = 0, int(left[0])
            continue
        ends = (here, link[0][here]) if side == 0 else (link[1][here], here)
        found.append((*ends, cost[side][here]))
    i, j, w = zip(*found) if found else ((), (), ())
    return np.array(i, dtype=np.int64), np.array(j, dtype=np.int64), np.array(w, dtype=float)
