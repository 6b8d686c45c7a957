"""Exact dedup: group by a 128-bit content hash, compare the bytes inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint
from .common import ascii_lower, free_name, text_of, without


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text))


def mark(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are, after lower-casing A-Z; the row with the smallest (or
    ``keep="largest"``) id of equal texts stays. Rows are grouped by hash *and* text, so bytes are
    compared inside each hash group and map-side combining folds copies before the shuffle; a hot
    group reaches the reducers as one row per task. Where one hash has several texts, their rows are
    matched again on the whole text. Documents find their group by the hash alone, in a join that
    adaptive execution splits at hot keys.

    Null text is empty text; empty texts are equal. A null id counts as neither smallest nor largest,
    so it is kept only if its group has no other id. Of rows that repeat an id and a text, one is
    kept. An empty table gives no rows. Other columns are not read.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    norm = ascii_lower(text_of(text_col))
    texts = docs.select(F.col(id_col).alias("_id"), norm.alias("_norm")).withColumn("_h", hash_of(F.col("_norm")))
    by_text = texts.groupBy("_h", "_norm").agg(pick("_id").alias("_keep"), F.count("*").alias("_size"))
    groups = by_text.select("_h", "_keep", "_size", F.sha2(F.encode("_norm", "utf-8"), 256).alias("_sha"))
    groups = checkpoint(groups.withColumn("_texts", F.count("*").over(Window.partitionBy("_h"))))

    def out(pairs: DataFrame) -> DataFrame:
        return pairs.select(
            F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
            F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_sha").alias("text_sha256"),
        )

    shared = groups.where("_texts > 1").select("_h").distinct()
    if shared.isEmpty():
        marked = out(texts.select("_id", "_h").join(groups, "_h"))
    else:  # hash collisions: the text itself is the key
        again = texts.join(shared, "_h", "left_semi")
        exact = again.groupBy("_norm").agg(
            pick("_id").alias("_keep"), F.count("*").alias("_size"),
        ).withColumn("_sha", F.sha2(F.encode("_norm", "utf-8"), 256))
        marked = out(texts.select("_id", "_h").join(groups.where("_texts = 1"), "_h")).unionByName(
            out(again.select("_id", "_norm").join(exact, "_norm"))
        )
    repeated = docs.groupBy(F.col(id_col).alias("_rid")).count().where("count > 1").select("_rid")
    if repeated.isEmpty():
        return marked
    # rows that repeat an id and a text look alike here: count them, and let only the first stay
    names = [id_col, "keep_id", "group_size", "kept", "text_sha256"]
    times = marked.groupBy(*names).agg(F.count("*").alias("_n"))
    return times.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_i")).withColumn(
        "kept", F.col("kept") & (F.col("_i") == 1)
    ).select(*names)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents that stay, with all their columns. See ``mark`` for what counts as equal.

    Rows that repeat an id are looked at again, as an id alone does not tell them apart: of those with
    equal texts one stays, with the smallest text by bytes; rows without an id are treated alike.
    """
    marks = checkpoint(mark(docs, id_col, text_col, keep))
    rid, own = free_name(docs, "_rid"), F.col(f"`{id_col}`")
    counts = docs.groupBy(own.alias(rid)).count()
    repeated = checkpoint(counts.where((F.col("count") > 1) | F.col(rid).isNull()).select(rid))
    if repeated.isEmpty():
        return without(docs, marks.where(~F.col("kept")).select(own), id_col)
    is_repeated = own.eqNullSafe(F.col(rid))
    plain = docs.join(repeated, is_repeated, "left_anti")
    dropped = marks.where(~F.col("kept")).select(own.alias("_drop")).join(repeated, F.col("_drop").eqNullSafe(F.col(rid)), "left_anti")
    stays = marks.where("kept").select(own.alias("_keep"), F.col("text_sha256").alias("_sha")).distinct()
    sha = F.sha2(F.encode(ascii_lower(text_of(text_col)), "utf-8"), 256)
    rows = docs.join(repeated, is_repeated, "left_semi")
    one = (
        rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), sha.alias("_s"))
        .groupBy(F.col(f"_row.`{id_col}`").alias("_i"), "_s")
        .agg(F.min_by("_row", F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))).alias("_row"))
        .join(stays, F.col("_i").eqNullSafe(F.col("_keep")) & (F.col("_s") == F.col("_sha")), "left_semi")
        .select("_row.*")
    )
    return without(plain, dropped, id_col).unionByName(one)
