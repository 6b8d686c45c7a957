"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint of 64 bits is the bitwise majority of the hashes of all word shingles. Candidates come
from structured masks: bit ``i`` carries a non-zero vector ``m(i)`` of ``radius + 1`` bits, and mask
``v`` keeps the bits whose ``m(i)`` has odd overlap with ``v``. Up to ``radius`` differing bits cannot
span the whole space, so some ``v`` is orthogonal to all of them, and the pair agrees under that mask:
no pair within the radius is missed. A bucket that is too large is masked again over the bits that its
mask left out, which keeps the guarantee and bounds every bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import bounded_batches, text_of, without
from .components import components

BITS = 64
SHINGLE_BLOCK = 1 << 16
# Distinct fingerprints that one task compares with each other; larger buckets are masked again.
BUCKET = 1 << 14


def masks_over(bits: list[int], radius: int) -> list[int]:
    """Masks that keep some of ``bits``; any ``radius`` of them are left out together by at least one mask."""
    side = (1 << (radius + 1)) - 1
    vector = {b: j % side + 1 for j, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, side + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint_of(text: str, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of one text; 0 without words, the whole sequence if it is short."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII white space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - words_per_shingle + 1)
    last = ends[words_per_shingle - 1 :] if len(words) >= words_per_shingle else ends[-1:]
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, SHINGLE_BLOCK):
        spans = zip(starts[k : min(n, k + SHINGLE_BLOCK)].tolist(), last[k : k + SHINGLE_BLOCK].tolist())
        h = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int((np.packbits(ones * 2 > n, bitorder="little")).view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, seed: int = 42
) -> DataFrame:
    """``(id, fp)`` for every row, ``fp`` as a signed long. Null text is empty text."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint_of(t, words_per_shingle, seed) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(out.view(np.int64))

    return docs.select(F.col(id_col).alias("_id"), fp(text_of(text_col)).alias("_fp"))


def _forest(fps: np.ndarray, ids: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges that join all fingerprints of one bucket that are linked, one less than their number."""
    n = len(fps)
    group = np.arange(n)
    for start in range(0, n, 256):
        near = np.bitwise_count(fps[start : start + 256, None] ^ fps[None, : start + 256]) <= radius
        for r, i in enumerate(range(start, min(n, start + 256))):
            old = np.unique(group[:i][near[r, :i]])
            if len(old):
                if len(old) > 1:
                    group[:i][np.isin(group[:i], old[1:])] = old[0]
                group[i] = old[0]
    for i in np.flatnonzero(group != np.arange(n)):
        yield int(ids[i]), int(ids[group[i]])


def _bucket_edges(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Edges of each bucket, from rows that come sorted by bucket; a bucket may span batches."""
    kept: pd.DataFrame | None = None

    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        mask, key = rows["mask"].to_numpy(), rows["key"].to_numpy()
        fps, ids = rows["fp"].to_numpy().view(np.uint64), rows["node"].to_numpy()
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        begin = np.concatenate([[0], cuts])
        end = np.concatenate([cuts, [len(rows)]])
        out = [e for a, b in zip(begin, end) if b - a > 1 for e in _forest(fps[a:b], ids[a:b], radius)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    for rows in batches:
        if kept is not None and len(kept):
            rows = pd.concat([kept, rows], ignore_index=True)
        if not len(rows):
            continue
        same = (rows["mask"].to_numpy() == rows["mask"].iat[-1]) & (rows["key"].to_numpy() == rows["key"].iat[-1])
        cut = len(rows) - int(same[::-1].argmin() if not same.all() else len(rows))
        kept, whole = rows.iloc[cut:], rows.iloc[:cut]
        if len(whole):
            yield edges(whole)
    if kept is not None and len(kept):
        yield edges(kept)


def _keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """One row per mask; ``mask`` is the set of bits that the key keeps."""
    each = F.array(*[F.lit(_signed(m)) for m in masks])
    return rows.select("node", "fp", F.explode(each).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def links(classes: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` between nodes of ``classes (node, fp)`` that join all fingerprints within ``radius`` bits.

    A spanning forest of each bucket, not every pair, so a group of near copies costs edges in
    proportion to its size. Buckets are counted with map-side combining before rows move.
    """
    rows, out = _keyed(classes, masks_over(list(range(BITS)), radius)), None
    for level in count():
        hot = checkpoint(
            rows.groupBy("mask", "key").count().where(F.col("count") > bucket).select("mask", "key")
        )
        done = hot.isEmpty()
        cold = rows if done else rows.join(hot, ["mask", "key"], "left_anti")
        sorted_rows = cold.repartition("mask", "key").sortWithinPartitions("mask", "key", "node")
        found = sorted_rows.select("node", "fp", "mask", "key").mapInPandas(
            lambda it: _bucket_edges(it, radius), "a long, b long"
        )
        out = found if out is None else out.unionByName(found)
        if done:
            return out
        crowded = {r["mask"] % (1 << BITS) for r in hot.select("mask").distinct().collect()}  # of the few masks in use
        finer = {m: [m | x for x in masks_over([b for b in range(BITS) if not m >> b & 1], radius)] for m in crowded}
        again = checkpoint(rows.join(hot, ["mask", "key"], "left_semi"))
        sets = classes.sparkSession.createDataFrame(
            [(_signed(m), [_signed(x) for x in sorted(set(xs))]) for m, xs in finer.items()], "mask long, _finer array<long>"
        )
        rows = (
            again.join(F.broadcast(sets), "mask")
            .select("node", "fp", F.explode("_finer").alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
            .distinct()
        )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
    radius: int = 3, seed: int = 42, bucket: int = BUCKET,
) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row; the component is the smallest id reachable by links.

    Equal fingerprints are folded into one node first. Null and wordless texts have fingerprint zero
    and are linked like any other. A row without an id gets a fingerprint, a null component, and links
    nothing. Ids are taken to be unique: rows that repeat one follow each their own text. An empty
    table gives no rows. Other columns are not read.
    """
    fps = checkpoint(fingerprints(docs, id_col, text_col, words_per_shingle, seed))
    classes = fps.where("_id IS NOT NULL").groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("node"))
    classes = checkpoint(classes)
    joined = components(links(classes, radius, bucket))
    named = classes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("_c"))
    out = fps.join(named, F.col("_fp") == F.col("fp"), "left").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("_id").isNotNull(), F.col("_c")).alias("component_id"),
    )
    return out


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, one of each group (the smallest id), with all columns; rows without an id stay."""
    marks = near_duplicates(docs, id_col, text_col, **options)
    dropped = checkpoint(marks.where(F.col("component_id") < F.col(id_col)).select(id_col).distinct())
    return without(docs, dropped, id_col)
