"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One table of a folder of Parquet tables, in the splits of its files."""
    table = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return table.select(*columns) if columns else table
