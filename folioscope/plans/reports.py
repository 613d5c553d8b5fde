"""Summaries of an ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def ingest_summary(documents: DataFrame, chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Chunks and tokens per document with its type and language."""
    counted = chunks.groupBy(key).agg(F.count("*").alias("n_chunks"), F.sum("token_count").alias("n_tokens"))
    return documents.select(key, "doc_type", "language").join(counted, key)


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("stage", "reason").agg(F.count("*").alias("n"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counting them while they pass; read ``observation.get`` after the action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
