"""A corpus from raw documents to packed sequences: each stage works on all that the one before it kept.

Every stage takes NULLs in any column, empty, blank and very long texts, ties and repeated rows, empty tables and further
columns as its operator states, and passes all columns of its documents; the last returns the pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import mixing, packing, pii, quality_rules, simhash
from folioscope.session import inner_stages


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked as in ``op10``: three-word shingles, at most two bits apart."""
    return simhash.keep_one(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows."""
    return pii.redact_pii(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The slot of every piece of every document in the training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("near_dedup", near_dedup), ("pii", redaction), ("mixing", mixture), ("packing", packed_sequences)]

# Components and tokenizers have no SQL counterpart: tests/llm holds run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result but the last is a table in the shared folder, and what a stage
    wrote on the way goes when its result is there."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with inner_stages(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
