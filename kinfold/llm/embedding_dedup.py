"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosines, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint
from .common import bounded_batches
from .components import components

# Vectors of one bucket that one task compares; larger buckets are dealt to pairs of blocks of this size.
BLOCK = 2048
ROWS = 128  # rows of a block that are multiplied at once


def plan(n: int, cosine: float, recall: float) -> tuple[int, int]:
    """Bits per key and number of tables: some tens of vectors per bucket however many there are,
    and a pair at the threshold itself shares a bucket somewhere with the given probability."""
    bits = min(30, max(6, math.ceil(math.log2(max(n, 2))) - 5))
    share = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - share))


def hyperplanes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def keys_of(x: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """``(rows, tables)`` keys of ``bits`` sign bits."""
    signs = (x @ planes >= 0).reshape(len(x), -1, bits)
    return (signs @ (1 << np.arange(bits))).astype("<i4")


def _hashed(batches: Iterator[pd.DataFrame], kind: str, bits: int, tables: int, seed: int) -> Iterator[pd.DataFrame]:
    planes: dict[int, np.ndarray] = {}
    for rows in batches:
        out = []
        for v in rows["vec"]:
            x = np.asarray(v, dtype=np.float64)
            x = x / np.abs(x).max()  # large or tiny components must not overflow a square
            if len(x) not in planes:
                planes[len(x)] = hyperplanes(len(x), bits, tables, seed)
            out.append(keys_of((x / np.linalg.norm(x))[None, :], planes[len(x)], bits)[0])
        packed = [np.asarray(v, dtype=kind).tobytes() for v in rows["vec"]]
        yield pd.DataFrame(
            {"node": rows["node"], "size": rows["size"], "raw": packed, "keys": [k.tolist() for k in out]}
        )


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _runs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The partners ``j`` of each distinct ``i``, which comes sorted."""
    rows, first = np.unique(i, return_index=True)
    return rows, np.split(j, first[1:]) if len(rows) else []


def _compare(rows: pd.DataFrame, kind: str, cosine: float) -> list[tuple[int, int, int]]:
    """Links of one bucket or pair of blocks: ``(node, other, 0)`` for a forest, ``(node, null, n)`` for counts.

    A pair that shares a bucket in several tables is counted in the first of them only.
    """
    t = int(rows["table"].iat[0])
    x = _unit(rows["raw"].tolist(), kind)
    keys = np.array(rows["keys"].tolist(), dtype="<i4")[:, :t]
    node, size = rows["node"].to_numpy(), rows["size"].to_numpy()
    side = rows["side"].to_numpy()
    across = len(np.unique(side)) > 1
    same_block = rows["bi"].iat[0] == rows["bj"].iat[0]
    if not across and not same_block:
        return []
    n = len(rows)
    linked = np.zeros(n, dtype=np.int64)
    group = np.arange(n)
    for start in range(0, n, ROWS):
        near = x[start : start + ROWS] @ x.T >= cosine
        i, j = np.nonzero(near)
        i = i + start
        fit = (j < i) & ((side[i] != side[j]) if across else True)
        i, j = i[fit], j[fit]
        if t and len(i):
            fresh = ~(keys[i] == keys[j]).any(axis=1)
            i, j = i[fresh], j[fresh]
        linked += np.bincount(i, weights=size[j], minlength=n).astype(np.int64)
        linked += np.bincount(j, weights=size[i], minlength=n).astype(np.int64)
        for r, mine in zip(*_runs(i, j)):
            old = np.unique(group[np.append(mine, r)])
            if len(old) > 1:
                group[np.isin(group, old[1:])] = old[0]
    out = [(int(node[r]), int(node[group[r]]), 0) for r in np.flatnonzero(group != np.arange(n))]
    return out + [(int(node[r]), None, int(linked[r])) for r in np.flatnonzero(linked)]


_BUCKET = ["table", "key", "dim", "bi", "bj"]


def _links(batches: Iterator[pd.DataFrame], kind: str, cosine: float) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket; a bucket may span batches, and holds two blocks at most."""
    kept: list[pd.DataFrame] = []

    def done(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        at = rows[_BUCKET].to_numpy()
        cuts = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            if b - a > 1:
                out += _compare(rows.iloc[a:b], kind, cosine)
        found = pd.DataFrame(out, columns=["a", "b", "n"])
        return found.astype({"a": "int64", "b": "Int64", "n": "int64"})

    for rows in batches:
        if not len(rows):
            continue
        at = rows[_BUCKET].to_numpy()
        same = (at == at[-1]).all(axis=1)
        cut = 0 if same.all() else len(rows) - int(same[::-1].argmin())
        if cut:
            yield done([*kept, rows.iloc[:cut]])
            kept = [rows.iloc[cut:]]
        elif kept and (kept[-1][_BUCKET].to_numpy()[-1] != at[0]).any():
            yield done(kept)
            kept = [rows]
        else:
            kept.append(rows)
    if kept:
        yield done(kept)


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95,
    recall: float = 0.999, seed: int = 42, block: int = BLOCK,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row: other vectors at the cosine or above, in double precision.

    Equal vectors are folded into one, weighted node. Each vector gets a key per table; vectors that
    share one are compared exactly, and a pair is counted in the first table that joins it, so neither
    pairs nor their duplicates are written out: a bucket returns one count per vector and a spanning
    forest. A bucket above ``block`` vectors is dealt to pairs of blocks, so that a task never holds more
    than about two blocks and no comparison is left out. The number of tables follows from ``recall``,
    the chance to find a pair exactly at the threshold; closer pairs are found more surely.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do
    rows without an id (their component is null). Vectors of different length have no cosine. Ids are
    taken to be unique: rows that repeat one share its component and the links of all its vectors.
    An empty table gives no rows. Other columns are not read.
    """
    bounded_batches(vectors.sparkSession, 2048)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"))
    element = rows.schema["vec"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    sound = F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)) & F.col("id").isNotNull())
    classes = rows.where("ok").groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("size"))
    classes = checkpoint(classes)
    bits, tables = plan(classes.count(), cosine, recall)
    hashed = checkpoint(
        classes.select("node", "size", "vec").mapInPandas(
            lambda it: _hashed(it, kind, bits, tables, seed), "node long, size long, raw binary, keys array<int>"
        )
    )
    placed = hashed.select("*", F.octet_length("raw").alias("dim"), F.posexplode("keys").alias("table", "key"))
    many = checkpoint(
        placed.groupBy("table", "key", "dim").count().where(F.col("count") > block)
        .select("table", "key", "dim", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    if many.isEmpty():
        dealt = placed.withColumns({"bi": F.lit(0), "bj": F.lit(0), "side": F.lit(0)})
    else:
        dealt = (
            placed.join(many, ["table", "key", "dim"], "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other"), "side": F.col("own")})
        )
    columns = [*_BUCKET, "side", "node", "size", "raw", "keys"]
    sorted_rows = dealt.select(*columns).repartition(*_BUCKET).sortWithinPartitions(*_BUCKET, "node")
    found = checkpoint(sorted_rows.mapInPandas(lambda it: _links(it, kind, cosine), "a long, b long, n long"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    joined = components(found.where("b IS NOT NULL").select("a", "b"))
    named = (
        classes.join(counts, "node", "left").join(joined, "node", "left")
        .select("vec", F.coalesce("component", "node").alias("c"), (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("l"))
    )
    linked = rows.where("ok").join(named, "vec").select("id", "l", "c")
    alone = rows.where(~F.col("ok")).select("id", F.lit(0).cast("long").alias("l"), F.col("id").alias("c"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("l").alias("n_links"), F.col("c").cast("long").alias("component_id"),
        F.col("id").eqNullSafe(F.col("c")).alias("kept"),
    )
