"""Containment in JSON documents by postings: a stored table of (path, value, key) that a table of patterns meets.

A document contains a pattern if it holds every scalar of the pattern at its place and an object wherever the pattern has one.
Numbers are equal by value and never equal a string; arrays take no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged

# Folders that postings are dealt into by path and value; a lookup opens those of its conditions.
SLOTS = 64


def _number(x: Decimal) -> str:
    """One text for all ways to write a number."""
    sign, digits, exponent = x.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    short = text.rstrip("0")
    return f"{'-' if sign and short else ''}{short or '0'}e{exponent + len(text) - len(short) if short else 0}"


def _refused(name: str):
    raise ValueError(f"{name} is no JSON")


def leaves(text: str | None) -> list[tuple[str, str]] | None:
    """(path, value) of every scalar and object of a JSON object; None for anything else."""
    try:
        top = json.loads(text or "", parse_int=Decimal, parse_float=Decimal, parse_constant=_refused)
    except (ValueError, RecursionError):
        return None
    if not isinstance(top, dict):
        return None
    out, todo = [], [((), top)]
    while todo:
        at, value = todo.pop()
        kind = ("o" if isinstance(value, dict) else None if isinstance(value, list) else "z" if value is None else f"b{value}" if isinstance(value, bool)
                else "n" + _number(value) if isinstance(value, Decimal) else "s" + value)
        if kind is not None:
            out.append((json.dumps(at), kind))
        if isinstance(value, dict):
            todo += [((*at, k), v) for k, v in value.items()]
    return out


def flatten(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, value) of the JSON objects of a column; texts that are none have no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [leaves(t) or [] for t in batch.column(1).to_pylist()]
            owner = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), *[pa.array([x[j] for f in found for x in f], pa.string()) for j in (0, 1)]], names=["key", "path", "value"])

    return df.select(key, F.col(text).cast("string")).mapInArrow(run, f"key {df.schema[key].dataType.simpleString()}, path string, value string")


def _slot(slots: int):
    return F.pmod(F.xxhash64("path", "value"), F.lit(slots)).cast("int")


def write_postings(df: DataFrame, root: str, key: str = "key", text: str = "text", slots: int = SLOTS) -> None:
    """Write the postings of a JSON column and how many rows each (path, value) has.

    A value that most rows share is split into files; within a file rows lie by path and value, so that the
    statistics of Parquet rule out what a lookup doesn't ask for.
    """
    rows = flatten(df, key, text).withColumn("slot", _slot(slots))
    order = ["slot", "path", "value"]
    rows.hint("rebalance", "slot").sortWithinPartitions(*order).write.mode("error").partitionBy("slot").parquet(f"{root}/postings")
    stored = df.sparkSession.read.schema(rows.schema).parquet(f"{root}/postings")
    counts = stored.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    counts.hint("rebalance", "slot").sortWithinPartitions(*order).write.mode("error").partitionBy("slot").parquet(f"{root}/counts")


def containing(spark: SparkSession, root: str, patterns: DataFrame, documents: DataFrame, key: str = "key", text: str = "text",
               pattern_id: str = "pattern_id", pattern: str = "pattern", slots: int = SLOTS) -> DataFrame:
    """(pattern_id, key) of every document that contains a pattern.

    The rarest condition of each pattern gives its candidates; these alone are read and checked against the whole
    pattern. Patterns that are no JSON objects are contained nowhere; the empty object is contained in every object.
    """
    asked = staged(flatten(patterns, pattern_id, pattern).withColumn("slot", _slot(slots)), "conditions")
    touched = [r["slot"] for r in asked.select("slot").distinct().collect()]
    counts = spark.read.schema("path string, value string, n long, slot int").parquet(f"{root}/counts").where(F.col("slot").isin(touched))
    counted = asked.join(counts, ["slot", "path", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = staged(counted.groupBy(F.col("key").alias(pattern_id)).agg(F.min(F.struct("n", "slot", "path", "value")).alias("r")).where("r.n > 0").select(pattern_id, "r.slot", "r.path", "r.value"), "rarest")
    wanted = [r["slot"] for r in rarest.select("slot").distinct().collect()]
    held = spark.read.schema(f"key {documents.schema[key].dataType.simpleString()}, path string, value string, slot int").parquet(f"{root}/postings").where(F.col("slot").isin(wanted))
    candidates = rarest.join(held, ["slot", "path", "value"]).select(pattern_id, "key")
    pairs = candidates.join(documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("_text")), "key").join(
        patterns.select(pattern_id, F.col(pattern).cast("string").alias("_pattern")), pattern_id)
    kinds = [f"`{pattern_id}` {patterns.schema[pattern_id].dataType.simpleString()}", f"`{key}` {documents.schema[key].dataType.simpleString()}"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, conditions = [], {}
            for p, t in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist()):
                if p not in conditions:
                    conditions[p] = set(leaves(p) or [])
                good.append(conditions[p] <= set(leaves(t) or []))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=[pattern_id, key]).filter(pa.array(good, pa.bool_()))

    return pairs.select(pattern_id, "key", "_text", "_pattern").mapInArrow(check, ", ".join(kinds))
