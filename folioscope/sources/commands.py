"""Command logs ``op path [argument]`` as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import WS, strip


def parse_commands(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add op, arg1, arg2 and ``error`` (NULL for a good command); comments and blank lines disappear.

    ``c path f|d`` and ``m source target`` take two arguments, ``l``, ``d`` and ``p`` one. Order has
    to come from a column of ``lines``, as rows have none of their own.
    """
    keep = [c for c in lines.columns if c != line]
    words = F.split(strip(F.col(line)), f"{WS}+")
    parts = lines.select(*keep, words.alias("_w")).where((F.col("_w")[0] != "") & ~F.startswith(F.col("_w")[0], F.lit("#")))
    op, n = F.col("_w")[0], F.size("_w")
    error = (F.when(~op.isin("c", "l", "d", "m", "p"), "unknown_command")
             .when(op.isin("c", "m") & (n != 3), "wrong_arguments")
             .when(op.isin("l", "d", "p") & (n != 2), "wrong_arguments")
             .when((op == "c") & ~F.substring(F.get("_w", 2), 1, 1).isin("f", "d"), "invalid_node_type"))
    return parts.select(*keep, op.alias("op"), F.get("_w", 1).alias("arg1"),
                        F.when(op == "c", F.substring(F.get("_w", 2), 1, 1)).otherwise(F.get("_w", 2)).alias("arg2"),
                        error.alias("error"))


def read_commands(spark: SparkSession, path: str, ns: str | None = None) -> DataFrame:
    """Commands of text files, each a namespace of its own unless ``ns`` names one for all.

    Long files are split over tasks, so ``seq`` is made of the split's byte offset and the running
    number within the task: it orders the lines of one file without gathering them.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    place = F.col("_metadata.file_block_start").cast("decimal(38,0)") * F.lit(1 << 33).cast("decimal(11,0)")
    lines = spark.read.text(path).select(
        (F.col("_metadata.file_path") if ns is None else F.lit(ns)).alias("ns"),
        (place.cast("decimal(38,0)") + within).cast("decimal(38,0)").alias("seq"), "value")
    return parse_commands(lines)
