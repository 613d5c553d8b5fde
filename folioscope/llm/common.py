"""What several operators of this subpackage share: words, distributed ranks, per-process objects."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A word is a run of anything but these six ASCII blanks.
BLANK = "\\x20\\x09-\\x0D"
WORD_BREAK = f"[{BLANK}]+"
# Ranks within one key are counted per slice of the ordering hash, so that no key is ranked in one task.
RANK_SLICES = 1024


def per_process(key, make: Callable):
    """An object made once in a Python process, whatever task asks for it first."""
    kept = _kept()
    if key not in kept:
        kept[key] = make()
    return kept[key]


def _kept() -> dict:
    # The package itself travels by value and is anew in every task; a module of the process stays.
    return sys.modules.setdefault("_folioscope_process", types.ModuleType("_folioscope_process")).__dict__.setdefault("kept", {})


def forget() -> None:
    """Drop the objects of ``per_process``: a Python worker serves many stages, and a tokenizer with its memory is 200 MB."""
    _kept().clear()


def words(text: Column) -> Column:
    """Array of the words of a text; NULL and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """All columns as one struct ``row``, so that columns added beside it cannot clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[v.alias(k) for k, v in more.items()])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; NULL counts as empty."""
    return [t or "" for t in column.to_pylist()]


def by_bytes(texts: list[str], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``budget`` characters, a longer text alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > budget:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def ranked(df: DataFrame, keys: list[str], order: Column, tie: list[str], rank: str = "rank") -> DataFrame:
    """Add the rank from 0 of every row among the rows of its key, ordered by the hash ``order`` and then ``tie``.

    Rows are numbered within a slice of the hash and shifted by the counts of the lower slices. A key holding most
    rows is dealt over ``RANK_SLICES`` groups, and the running sum sees that many rows of a key at most.
    """
    sliced = df.withColumns({"_order": order, "_slice": F.shiftrightunsigned(order, 54).cast("int")})
    cell = [*keys, "_slice"]
    counts = sliced.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    below = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slice")) - F.col("_n")
    shifts = counts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cell)], below.alias("_below"))
    inner = F.row_number().over(Window.partitionBy(*cell).orderBy("_order", *tie)) - 1
    numbered = sliced.withColumn("_inner", inner)
    same = [numbered[c].eqNullSafe(shifts[f"_k{i}"]) for i, c in enumerate(cell)]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return numbered.join(shifts, condition).select(*df.columns, (F.col("_below") + F.col("_inner")).alias(rank))
