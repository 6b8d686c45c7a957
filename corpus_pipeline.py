"""Corpus preparation, stage by stage: each stage works on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import bpe, exact_dedup, mixing, simhash_dedup, toxicity
from kinfold.llm.common import table
from kinfold.session import prepare_session, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = "byte_bpe_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest id stays."""
    return exact_dedup.deduplicate(docs, keep="largest").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest id stays."""
    return simhash_dedup.deduplicate(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to the square root of their size; documents repeat or vanish accordingly."""
    return mixing.mix(docs).select(*COLUMNS)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded bytes."""
    return bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_text),
]

# The first stage is a trained classifier, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one stage returns is written to the shared folder and read by the next."""
    prepare_session(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
