"""Byte-level BPE by overlapping chunks.

Texts longer than a chunk are cut into windows that overlap. Every window is split into pre-tokens on
its own, wherever it happens to start; two neighbours are stitched at the first position in their
overlap where both have a boundary, because from there on the same pattern over the same characters
gives the same pre-tokens. The piece between two stitches is encoded on its own, and the ids of the
pieces in order are the ids of the text. Where an overlap has no common boundary (a word longer than
it), the windows are joined. Texts of one chunk need no stitch and stay where they are.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint
from .common import bounded_batches, text_of

CHUNK = 1 << 15  # characters of a window that no other window starts in
OVERLAP = 1 << 10
# The pattern looks at most this many characters past the end of a match ("'ll" and the like).
LOOKAHEAD = 3


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of one rank file, once per Python worker. Ranks are read, never trained."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ids_of(text: str, ranks_path: str, pattern: str) -> np.ndarray:
    return np.array(encoding(ranks_path, pattern).encode_ordinary(text), dtype="<u4")


def bytes_of(ids: np.ndarray, ranks_path: str, pattern: str) -> bytes:
    """Decoding: the raw bytes of the tokens, one after the other."""
    return encoding(ranks_path, pattern).decode_bytes(ids.tolist())


def windows(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    for k, start in enumerate(range(0, max(1, len(text)), chunk)):
        yield k, text[start : start + chunk + overlap]


def boundaries(window: str, pattern: str, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Pre-token starts in the first ``overlap`` characters, and in the overlap with the next window.

    Positions count from the start of the zone. A match too close to a cut end might have gone on, so
    boundaries there are left out.
    """
    ends = [m.end() for m in regex.finditer(pattern, window)]
    sure = len(window) if last else len(window) - LOOKAHEAD
    starts = [0, *(e for e in ends if e <= sure)]
    return [p for p in starts if p < overlap], [p - chunk for p in starts if p >= chunk]


def _pieces(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``(key, k, piece)`` of the texts ``(key, text)``: what lies between two stitches."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for key, text in zip(rows["key"], rows["text"]):
                last = (len(text) - 1) // chunk
                for k, w in windows(text, chunk, overlap):
                    yield pd.DataFrame({"key": [key], "k": [k], "last": [k == last], "w": [w]})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            zones = [boundaries(w, pattern, z, chunk, overlap) for w, z in zip(rows["w"], rows["last"])]
            yield rows.assign(head=[z[0] for z in zones], tail=[z[1] for z in zones])

    # copies of a text share a key: one of them is split; chunks of one text spread over the cluster
    cuts = long.mapInPandas(cut, "key binary, k int, last boolean, w string")
    cuts = cuts.groupBy("key", "k").agg(F.first("last").alias("last"), F.first("w").alias("w"))
    parts = checkpoint(
        cuts.mapInPandas(split, "key binary, k int, last boolean, w string, head array<int>, tail array<int>")
    )
    along = Window.partitionBy("key").orderBy("k")
    seams = parts.select("key", "k", "head", F.lag("tail").over(along).alias("before"))
    seams = seams.select("key", "k", F.array_min(F.array_intersect("head", "before")).alias("at"))
    # a window without a stitch belongs to the piece that began before it
    marks = seams.select(
        "key", "k", F.when(F.col("k") == 0, 0).otherwise(F.col("at")).alias("at"),
    ).withColumn("opens", F.col("at").isNotNull().cast("int"))
    groups = marks.select(
        "key", "k", "at", F.sum("opens").over(along).cast("int").alias("g"), F.lead("at").over(along).alias("next"),
    )
    # characters of this window that are its own: from its stitch, to the next window's
    own = parts.join(groups, ["key", "k"]).select(
        "key", "k", "g", "last",
        F.expr("substring(w, coalesce(at, 0) + 1)").alias("from_at"),
        F.coalesce("at", F.lit(0)).alias("lo"), "next",
    )
    end = F.when(F.col("last"), F.char_length("from_at")).otherwise(F.lit(chunk) + F.coalesce("next", F.lit(0)) - F.col("lo"))
    own = own.select("key", "k", "g", F.substring(F.col("from_at"), F.lit(1), end).alias("own"))
    alone = own.withColumn("n", F.count("*").over(Window.partitionBy("key", "g")))
    single = alone.where("n = 1").select("key", "g", F.col("own").alias("piece"))
    several = alone.where("n > 1").groupBy("key", "g").agg(F.sort_array(F.collect_list(F.struct("k", "own"))).alias("p"))
    joined = several.select("key", "g", F.array_join(F.col("p.own"), "").alias("piece"))
    return single.unionByName(joined)


def _keyed(docs: DataFrame, id_col: str, text_col: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    """``(id, text)`` of texts that fit one chunk, and ``(id, text, key)`` of the longer ones."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    fits = F.char_length("text") <= chunk
    return rows.where(fits), rows.where(~fits).withColumn("key", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)))


def _encode_pieces(pieces: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [ids_of(t, ranks_path, pattern).tobytes() for t in rows["piece"]]
            yield pd.DataFrame({"key": rows["key"], "piece_no": rows["g"], "ids": out})

    return pieces.mapInPandas(ids, "key binary, piece_no int, ids binary")


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``(key, piece_no, ids)`` of every distinct text: token ids as little-endian unsigned 32-bit integers.

    ``key`` is the SHA-256 of the text. Special tokens are not recognised. Concatenated by
    ``piece_no``, the ids are those of the whole text.
    """
    bounded_batches(docs.sparkSession)
    short, long = _keyed(docs, id_col, text_col, chunk)
    key = F.unhex(F.sha2(F.encode("text", "utf-8"), 256))
    one = short.select(key.alias("key"), F.lit(1).alias("g"), F.col("text").alias("piece")).dropDuplicates(["key"])
    pieces = one.unionByName(_pieces(long.select("key", "text"), pattern, chunk, overlap))
    return _encode_pieces(pieces, ranks_path, pattern)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(key, piece_no, raw)``: the bytes of each piece of ``encode``; concatenated, those of the text."""

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [bytes_of(np.frombuffer(x, dtype="<u4"), ranks_path, pattern) for x in rows["ids"]]
            yield pd.DataFrame({"key": rows["key"], "piece_no": rows["piece_no"], "raw": out})

    return encoded.mapInPandas(raw, "key binary, piece_no int, raw binary")


def _text_digests(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(key, d)`` per text of ``encode``'s pieces; they are fed to the digests one by one."""
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]

    def feed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n, of_ids, of_bytes = None, 0, None, None
        for rows in batches:
            done = []
            for k, x in zip(rows["key"], rows["ids"]):
                if k != key:
                    if key is not None:
                        done.append((key, n, of_ids.hexdigest(), of_bytes.hexdigest()))
                    key, n, of_ids, of_bytes = k, 0, hashlib.sha256(), hashlib.sha256()
                n += len(x) // 4
                of_ids.update(x)
                of_bytes.update(bytes_of(np.frombuffer(x, dtype="<u4"), ranks_path, pattern))
            yield pd.DataFrame(done, columns=names)
        if key is not None:
            yield pd.DataFrame([(key, n, of_ids.hexdigest(), of_bytes.hexdigest())], columns=names)

    by_text = encoded.repartition("key").sortWithinPartitions("key", "piece_no")
    return by_text.mapInPandas(feed, "key binary, n_tokens long, ids_sha256 string, decoded_sha256 string")


def digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` per row: each text encoded, its ids decoded again.

    Texts of one chunk are encoded and decoded where they are read. Longer ones go through the
    stitched pieces, folded by text so that copies are encoded once; digests are fed piece by piece, so
    no task holds the ids of a whole long text. Null text is empty text, which has no tokens. Rows that
    repeat an id or a text, and rows without an id, are each returned. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    short, long = _keyed(docs, id_col, text_col, chunk)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def whole(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            ids = ids_of(t, ranks_path, pattern)
            raw = bytes_of(ids, ranks_path, pattern)
            out.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    done = short.select("id", whole("text").alias("d")).select("id", "d.*")
    pieces = _pieces(long.select("key", "text"), pattern, chunk, overlap)
    by_text = _text_digests(_encode_pieces(pieces, ranks_path, pattern), ranks_path, pattern)
    stitched = long.select("id", "key").join(by_text, "key").drop("key")
    return done.unionByName(stitched).withColumnRenamed("id", id_col)
