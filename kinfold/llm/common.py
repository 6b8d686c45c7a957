"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import check_broadcast

# Ids of rows to drop that may be broadcast (8 bytes each on the wire); more go through a shuffle.
BROADCAST_IDS = 1_000_000
# Rows of text that travel to a Python worker at once, so that a batch of long texts stays small.
ROWS_PER_BATCH = 256

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bounded_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Keep Arrow batches of whole texts small; texts themselves are never cut."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII texts, where both agree, take the faster ``lower``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, A_Z, A_Z.lower()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose id is not in the only column of ``ids``; rows without an id stay.

    A short list is broadcast after its length is checked; a longer one is shuffled and joined.
    """
    n = ids.count()
    if n == 0:
        return df
    drop = free_name(df, "_drop_id")
    side = ids.toDF(drop)
    if n <= BROADCAST_IDS:
        check_broadcast(n, "ids to drop")
        side = F.broadcast(side)
    return df.join(side, F.col(f"`{id_col}`") == F.col(drop), "left_anti")
