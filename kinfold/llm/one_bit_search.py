"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred and rotated; the signs of the rotated components are a vector's code, one bit per
dimension, stored packed with two scalars: the vector's length and how well its code points along it. The
product of a query with the code, corrected by the scalars, estimates the query's inner product with the
vector. The part of the vector that the code misses meets the query in a random direction, which bounds the
error. Vectors whose nearest possible distance is not beyond the k-th smallest of the farthest possible
ones are reranked by their exact distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import checkpoint
from .common import bounded_batches

# Queries and candidates of one block pair at most, on average; a task holds one pair.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 65536
LEAST_BLOCKS = 64  # of candidates, so that small tables are spread over all tasks too
EPSILON = 4.0  # width of the error bounds in standard deviations of the estimate
PAIRS = 1 << 15  # exact distances taken at once
# Mean vectors are broadcast for this many lengths, the most frequent ones, of at most this many components (32 MiB).
# Vectors of other lengths are coded around the origin, which costs precision of the codes, not of results.
CENTERS, CENTER_DIM = 64, 1 << 16


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix; every worker derives the same one."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def encode(x: np.ndarray, center: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(packed bits, lengths, alignments)``; an alignment is the cosine of a centred vector with its own code."""
    y = (x - center) @ turn.T
    length = np.linalg.norm(y, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        align = np.abs(y).sum(axis=1) / (length * np.sqrt(y.shape[1]))
    return np.packbits(y > 0, axis=1), length, np.where(length > 0, align, 1.0)


def bounds(
    q: np.ndarray, codes: np.ndarray, length: np.ndarray, align: np.ndarray, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """``(queries, vectors)`` lower and upper bounds of squared distances for rotated queries ``q``."""
    dim = q.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float64) * 2 - 1
    along = q @ signs.T / np.sqrt(dim)
    own = (q**2).sum(axis=1)[:, None]
    estimate = along / align * length
    missed = np.sqrt(np.maximum(1 - align**2, 0)) / align * length
    spread = epsilon * np.sqrt(np.maximum(own - along**2, 0) / max(dim - 1, 1)) * missed
    middle = own + length**2 - 2 * estimate
    slack = 2 * spread + 1e-9 * (own + length**2)
    return middle - slack, middle + slack


def nearest(
    q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, codes: tuple, turned: np.ndarray, k: int, epsilon: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a block its ``k`` nearest of a block of vectors: ``(query, vectors, distances)``."""
    with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
        low, high = bounds(turned, *codes, epsilon)
    own = q_ids[:, None] == ids[None, :]
    high[own] = np.inf
    high[np.isnan(high)] = np.inf
    limit = np.partition(high, k - 1, axis=1)[:, k - 1 : k] if high.shape[1] >= k else np.full((len(q), 1), np.inf)
    i, j = np.nonzero(~(low > limit) & ~own)
    distance = np.empty(len(i))
    for a in range(0, len(i), PAIRS):
        part = slice(a, a + PAIRS)
        with np.errstate(over="ignore"):
            apart = (x[j[part]] - q[i[part]]) ** 2
            distance[part] = np.sqrt(np.add.accumulate(apart, axis=1)[:, -1])  # summed from the first component on
    order = np.lexsort((ids[j], distance, i))
    i, j, distance = i[order], j[order], distance[order]
    first = np.searchsorted(i, np.arange(len(q) + 1))
    for r in range(len(q)):
        top = slice(first[r], min(first[r] + k, first[r + 1]))
        yield r, j[top], distance[top]


_RESULT = "query_id long, query_key string, vec_id long, score double"


def _rows(raw: pd.Series, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=kind).astype(np.float64).reshape(-1, dim)


def _point(center: bytes) -> np.ndarray | float:
    return np.frombuffer(center) if center else 0.0


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    for rows in batches:
        for d, part in rows.groupby("dim"):
            x = np.stack(part["vec"].to_list()).astype(np.float64)
            total[d] = total.get(d, 0) + x.sum(axis=0)
            count[d] = count.get(d, 0) + len(x)
    if total:
        yield pd.DataFrame({"dim": list(total), "n": [count[d] for d in total], "total": [total[d].tolist() for d in total]})


def _center(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means of the tasks' sums, as bytes; a mean of huge numbers that overflows counts as zero."""
    for rows in batches:
        out = []
        for t, n in zip(rows["total"], rows["n"]):
            with np.errstate(over="ignore", invalid="ignore"):
                m = np.asarray(t, dtype=np.float64) / n
            out.append((m if np.isfinite(m).all() else np.zeros(len(m))).tobytes())
        yield pd.DataFrame({"dim": rows["dim"], "center": out})


def search(
    vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    epsilon: float = EPSILON, seed: int = 42, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query`` holds, its ``k`` nearest other rows.

    Nearness is Euclidean distance in double precision, ties go to the smaller id; ``score`` is that distance between the
    vectors as given. Every row is a candidate of every query but for rows with the query's own id. Queries and candidates
    are dealt to blocks, each two blocks meet in one task, and a task returns at most ``k`` rows per query; neither side is
    broadcast. A vector beyond its error bound can be missed; with ``epsilon`` standard deviations that is rare.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, as do rows without an id. Vectors
    of different length have no distance. A query with fewer than ``k`` candidates returns them all, one without any has no
    row. Rows that repeat a query's id and vector are one query; as candidates repeated rows count one by one. An empty table
    gives no rows. Other columns are not read.
    """
    bounded_batches(vectors.sparkSession, 2048)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"), is_query.alias("asks"))
    kind = "<f4" if isinstance(rows.schema["vec"].dataType.elementType, T.FloatType) else "<f8"
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    sound = F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.coalesce(sound, F.lit(False))).withColumn("dim", F.size("vec"))

    # the mean vector per length: sums per task, then per length
    sums = rows.select("dim", "vec").mapInPandas(_sums, "dim int, n long, total array<double>")
    sums = sums.select("dim", "n", F.posexplode("total").alias("at", "v")).groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    centers = sums.groupBy("dim").agg(
        F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda p: p["v"]).alias("total")
    ).where(F.col("dim") <= CENTER_DIM).orderBy(F.desc("n"), "dim").limit(CENTERS).mapInPandas(_center, "dim int, center binary")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for (dim, center), part in batch.groupby(["dim", "center"]):
                dim = int(dim)
                if dim not in turns:
                    turns[dim] = rotation(dim, seed)
                x = np.stack(part["vec"].to_list()).astype(kind)
                with np.errstate(over="ignore", invalid="ignore"):
                    codes, length, align = encode(x.astype(np.float64), _point(center), turns[dim])
                yield pd.DataFrame({
                    "dim": part["dim"], "id": part["id"], "asks": part["asks"], "raw": [v.tobytes() for v in x],
                    "center": part["center"], "code": [c.tobytes() for c in codes], "length": length, "align": align,
                })

    rows = rows.withColumn("asks", F.coalesce("asks", F.lit(False))).join(F.broadcast(checkpoint(centers)), "dim", "left")
    coded = rows.withColumn("center", F.coalesce("center", F.lit(b""))).mapInPandas(
        packed, "dim int, id long, asks boolean, raw binary, center binary, code binary, length double, align double"
    )
    coded = checkpoint(coded.withColumn("at", F.monotonically_increasing_id()))
    size = coded.agg(F.count("*").alias("n"), F.coalesce(F.count_if("asks"), F.lit(0)).alias("q")).first()
    parts = -(-size["q"] // query_block)
    blocks = max(LEAST_BLOCKS, -(-size["n"] // candidate_block))

    asked = coded.where("asks").dropDuplicates(["id", "raw"]).withColumn("key", F.sha2("raw", 256))
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("id", "key"), F.lit(max(parts, 1))).cast("int"))
    asked = asked.select("dim", "qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"), "id", "key", "raw", "center")
    given = coded.withColumn("cb", F.pmod("at", F.lit(blocks)).cast("int"))
    given = given.select("dim", F.explode(F.sequence(F.lit(0), F.lit(max(parts, 1) - 1))).alias("qb"), "cb", "id", "raw", "code", "length", "align")

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            dim = int(queries["dim"].iat[0])
            q, x = _rows(queries["raw"], kind, dim), _rows(candidates["raw"], kind, dim)
            codes = np.frombuffer(b"".join(candidates["code"]), dtype=np.uint8).reshape(len(x), -1)
            with np.errstate(over="ignore", invalid="ignore"):
                turned = (q - _point(queries["center"].iat[0])) @ rotation(dim, seed).T
            scalars = (codes, candidates["length"].to_numpy(), candidates["align"].to_numpy())
            q_ids, ids, keys = queries["id"].to_numpy(), candidates["id"].to_numpy(), queries["key"].to_numpy()
            for a in range(0, len(q), 256):
                part = slice(a, a + 256)
                for r, found, distance in nearest(q[part], q_ids[part], x, ids, scalars, turned[part], k, epsilon):
                    out += [(int(q_ids[a + r]), keys[a + r], int(ids[j]), float(s)) for j, s in zip(found, distance)]
        return pd.DataFrame(out, columns=["query_id", "query_key", "vec_id", "score"])

    found = asked.groupBy("dim", "qb", "cb").cogroup(given.groupBy("dim", "qb", "cb")).applyInPandas(meet, _RESULT)
    ranked = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
