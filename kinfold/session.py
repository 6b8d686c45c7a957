"""Session helpers shared by every operator: shared scratch space, checkpoints, size checks."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession

# Rows that one task may sort, or that one aggregate buffer may hold, without a second thought.
SINGLE_TASK_ROWS = 2_000_000
# Cells (rows x columns of doubles) that may travel to the driver and back out as a broadcast: 256 MiB.
BROADCAST_CELLS = 32 * 1024 * 1024


class TooLarge(ValueError):
    """A table that must be small by contract turned out not to be."""


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings results depend on: a fixed time zone and adaptive execution."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="kinfold-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as a table and read it back: the cut for loops that join their own results.

    A checkpoint hands on the planner's estimate of its size, and a join multiplies those of both sides: in such a
    loop the estimate has millions of digits after a dozen rounds, and planning takes minutes and the driver's memory.
    A table read from files has the size of its files.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core when a scan arrives in fewer partitions than there are cores.

    Meant for plain scans. A large input already has more partitions and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def is_kept(df: DataFrame) -> bool:
    """Whether reading ``df`` again is a read of stored rows: cached, or checkpointed."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        return True
    return df._jdf.queryExecution().logical().getClass().getSimpleName() == "LogicalRDD"


@contextlib.contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold the input of an iterative fit for as long as it runs, unless it is stored already.

    Cached blocks spill to disk and are recomputed from the lineage if an executor is lost.
    """
    if is_kept(df):
        yield df
        return
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def bounded_rows(df: DataFrame, limit: int, what: str) -> list[Row]:
    """Collect a table that is small by contract; refuse, never truncate, if it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooLarge(f"{what}: more than {limit} rows")
    return rows


def check_broadcast(cells: int, what: str) -> None:
    if cells > BROADCAST_CELLS:
        raise TooLarge(f"{what}: {cells} cells exceed the broadcast budget of {BROADCAST_CELLS}")
