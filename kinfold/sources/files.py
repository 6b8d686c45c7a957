"""Readers, writers and fingerprints of tables on shared storage."""

from __future__ import annotations

import codecs
import hashlib
import re
from datetime import UTC, datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import batches_of
from .contracts import Contract, Expectations, coerce, require, validate

WHOLE_BYTES = 64 << 20  # files that a task may hold as one value; larger ones are hashed as they are read
_UNPACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"  # what a reader of lines would not return byte for byte
_AT_ONCE = 64  # large files in one job


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A declared schema, no inference pass; malformed rows stop the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_labels(labels: DataFrame, path: str) -> None:
    """``(row_id, algorithm, cluster)``, one folder per algorithm so that one labelling reads alone."""
    write_parquet(labels, path, ["algorithm"])


def read_labels(spark: SparkSession, path: str, algorithm: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("algorithm") == algorithm).drop("algorithm") if algorithm else df


def null_for_nan(df: DataFrame) -> DataFrame:
    """Undefined scores are NaN in tables and null in JSON."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name)
            for f in df.schema
        ]
    )


def as_json(df: DataFrame) -> DataFrame:
    """One JSON document per row, nulls kept as fields."""
    return null_for_nan(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    null_for_nan(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The saved summary, or None when it has not been written."""
    return spark.read.schema(schema).json(path) if path_exists(spark, path) else None


def file_manifest(spark: SparkSession, path: str, source: str, *, pattern: str = "*", listed_at: str | None = None) -> DataFrame:
    """Per file: path, size, sha256 of the bytes, source and the time of listing, which is now unless the caller names it.

    Files are hashed where Spark reads them, one task per file or a few small ones. A task holds files of up to
    ``WHOLE_BYTES`` whole and reads larger ones line by line, unless their name ends as that of a compressed file does.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    whole = min(WHOLE_BYTES, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))
    large = files.where(F.col("length") > whole).select("path", "length").collect()
    packed = [r["path"] for r in large if re.search(_UNPACKED, r["path"])]
    large = [(r["path"], r["length"]) for r in large if r["path"] not in packed]
    hashed = _hashed_whole(files.where(F.col("length") <= whole))  # a condition on which the reader opens no file in vain
    if packed:
        hashed = hashed.unionByName(_hashed_whole(spark.read.format("binaryFile").load([_escaped(p) for p in packed])))
    found = _hashed_by_lines(spark, large)
    marked = [(p, n) for p, n, h in found if h is None]  # a byte order mark is not part of a line
    found = [r for r in found if r[2] is not None] + _hashed_by_lines(spark, marked, codecs.BOM_UTF8)
    if found:
        hashed = hashed.unionByName(spark.createDataFrame(found, _HASHED))
    return hashed.select(
        "path", "size_bytes", "sha256",
        F.lit(source).alias("source"),
        F.lit(listed_at or datetime.now(UTC).isoformat()).alias("downloaded_at"),
    )


_HASHED = "path string, size_bytes bigint, sha256 string"


def _escaped(path: str) -> str:
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _hashed_whole(files: DataFrame) -> DataFrame:
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def _hashed_by_lines(spark: SparkSession, large: list[tuple[str, int]], mark: bytes = b"") -> list[tuple[str, int, str | None]]:
    """``(path, size, sha256)`` of files whose lines are all their bytes but line ends, and the byte order mark that they may begin with.

    One task reads a file's lines in order. Whether an end follows the last line can be told from the size, and so
    can whether there is a mark other than ``mark``: then there is no hash.
    """
    found = []
    for i in range(0, len(large), _AT_ONCE):
        parts = [_lines(spark, path).mapInArrow(_digest(path, size, mark), _HASHED) for path, size in large[i : i + _AT_ONCE]]
        found += [tuple(r) for r in reduce(DataFrame.unionByName, parts).collect()]
    return found


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(_escaped(path)).coalesce(1)
    return lines.select(F.concat(F.col("value").cast("binary"), F.lit(bytearray(b"\n"))).alias("line"))


def _digest(path: str, size: int, mark: bytes):
    def run(batches):
        sha, seen, end = hashlib.sha256(mark), len(mark), b""
        for b in batches_of(batches):
            col = b.column(0)
            _, offsets, data = col.buffers()
            at = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(col.type) else np.int32)[col.offset :]
            part = memoryview(data)[at[0] : at[len(col)]]
            sha.update(end)
            sha.update(part[:-1])
            seen, end = seen + len(part), b"\n"
        if size == seen:
            sha.update(end)
        known = size in (seen, seen - 1)
        if not known and (mark or size not in (seen + 2, seen + 3)):
            raise OSError(f"{path}: {size} bytes, but its lines have {seen}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([size]), pa.array([sha.hexdigest() if known else None], pa.string())], names=["path", "size_bytes", "sha256"]
        )

    return run


def manifest_sha256(manifest: DataFrame) -> DataFrame:
    """One checksum for a set of files: the file's own, or a hash over the sorted file hashes."""
    hashes = F.array_sort(F.collect_list("sha256"))
    joined = F.when(F.size(hashes) == 1, hashes[0]).otherwise(F.sha2(F.array_join(hashes, ""), 256))
    return manifest.agg(joined.alias("sha256"), F.sum("size_bytes").alias("size_bytes"))


def table_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Content hash that does not depend on row order or file layout: row count and hash total.

    Columns are rendered as text and null as an empty field; the total is a decimal, so it
    neither overflows nor depends on the order of addition.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    part = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(part).cast("string").alias("hash_total"))


def ingest_csv(
    spark: SparkSession, path: str, out: str, source: str, contract: Contract, expected: Expectations
) -> tuple[DataFrame, DataFrame]:
    """Read, validate, verify, and only then write Parquet; returns (table, manifest)."""
    table = coerce(read_csv(spark, path, contract.schema), contract)
    table = validate(table, contract)
    manifest = file_manifest(spark, path, source)
    require(table, expected, manifest_sha256(manifest).first()["sha256"] if expected.sha256 else None)
    write_parquet(table, f"{out}/table")
    written = read_parquet(spark, f"{out}/table")
    with_rows = manifest.select("*", written.agg(F.count(F.lit(1)).alias("n")).scalar().alias("row_count"))
    write_parquet(with_rows, f"{out}/manifest")
    return written, read_parquet(spark, f"{out}/manifest")
