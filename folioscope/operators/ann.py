"""Cosine search over lists that is exact: lists are visited until a bound rules out all others.

A cell is the part of a list that has one value of an attribute (without an attribute, the whole list). For every cell
the index knows how many rows it has and the least and greatest angle between them and the list's centre. A row
of the cell cannot lie nearer to a query than these angles allow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine
from ..session import scratch, staged
from .search import BLOCK_BYTES, PROBES, Best, _matrix, _merge, build_lists, few_tasks, offer_products

# Centres and cells travel to the tasks; an index that would exceed these is refused.
CENTRE_BYTES, MOST_CELLS = 256 << 20, 1 << 20
# Each round visits the cells that hold so many times the rows of the round before.
GROWTH = 4
# Cells that a task holds before it hands them on.
CELLS_OUT = 1 << 20
# Cells named in a filter one by one; more are joined.
NAMED_CELLS = 256
_SLACK = 1e-7


@dataclass(frozen=True)
class Index:
    """Stored rows (key, vector, cell), and what the driver knows: one row per cell, one centre per list."""
    rows: DataFrame
    cells: pa.Table
    centres: np.ndarray
    key: str
    vector: str


def lists_for(rows: int, dim: int) -> int:
    """As many lists as the square root of the rows, at most as many as may travel."""
    return max(1, min(round(math.sqrt(rows)), CENTRE_BYTES // (8 * max(1, dim))))


def build_index(vectors: DataFrame, path: str, attribute: str | None = None, lists: int | None = None, vector: str = "embedding",
                key: str = "chunk_id", rows_per_list: int | None = 256, seed: int = 42) -> Index:
    """Cluster the vectors, write them by cell below ``path``, and measure every cell.

    The centres are learned from about ``rows_per_list`` rows a list; every row with a direction is indexed. Values of
    the attribute are compared as text, NULL is a value of its own.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.size(vector) > 0)
    known = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    value = F.lit(None).cast("string") if attribute is None else F.col(attribute).cast("string")
    indexed, centroids = build_lists(usable.select(key, vector, value.alias("value")), lists or lists_for(known["n"], known["dim"] or 1), vector, seed, rows_per_list=rows_per_list)
    indexed = staged(indexed, "indexed")
    centres = centroids.orderBy("list_id").select("list_id", "centroid").toArrow()
    matrix = np.stack(centres.column("centroid").to_pylist())
    matrix /= np.maximum(np.sqrt((matrix * matrix).sum(axis=1, keepdims=True)), 1e-300)
    numbered = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(matrix)], "list_id int, centre array<double>")
    near = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine(F.col(vector), F.col("centre"), F.lit(1.0))))
    measured = indexed.join(F.broadcast(numbered), "list_id").groupBy("list_id", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.acos(near)).alias("near"), F.max(F.acos(near)).alias("far"))
    # A row per list and value: numbered in one place.
    cells = staged(measured.withColumn("cell", F.row_number().over(Window.orderBy("list_id", "value")) - 1), "cells")
    table = cells.orderBy("cell").toArrow()
    if table.num_rows > MOST_CELLS:
        raise ValueError(f"{table.num_rows} cells of lists and values; index fewer lists or an attribute of fewer values")
    place = cells.select(F.col("list_id").alias("l"), F.col("value").alias("v"), "cell")
    dealt = indexed.join(place, (F.col("list_id") == F.col("l")) & F.col("value").eqNullSafe(F.col("v"))).select(key, vector, "cell")
    dealt.hint("rebalance", "cell").write.mode("error").partitionBy("cell").parquet(path)
    return Index(spark.read.schema(dealt.schema).parquet(path), table, matrix, key, vector)


def _visits(queries: DataFrame, index: Index, rows: int, before: int, kind: str) -> DataFrame:
    """Queries (query_id, query_vector, wanted, floor) with the cells that this round visits.

    A query's cells come by falling bound, equal ones by the angle to the centre. The round takes them up to the
    one that brings ``rows`` rows, without those of the rounds ``before`` and those whose bound is below the floor.
    """
    c = index.cells
    shared = queries.sparkSession.sparkContext.broadcast((
        index.centres, *[c.column(x).to_numpy() for x in ("list_id", "n", "near", "far", "cell")], c.column("value").to_pylist()))

    def piece(batch: pa.RecordBatch, taken: list[int], out: list[np.ndarray]) -> pa.RecordBatch:
        at, ends = pa.array(taken), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
        named = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out)))
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), batch.column(3).take(at), named], names=["query_id", "query_vector", "floor", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, lists, n, near, far, cells, values = shared.value
        of_value: dict = {}
        for i, v in enumerate(values):
            of_value.setdefault(v, []).append(i)
        everything = np.arange(len(values))
        for batch in batches:
            position, q = _matrix(batch.column(1), centres.shape[1])
            wanted, floors = batch.column(2).to_pylist(), batch.column(3).to_numpy(zero_copy_only=False)
            taken, out, held = [], [], 0
            for at, row in zip(position.tolist(), q):
                mine = everything if wanted[at] is None else np.array(of_value.get(wanted[at], []), np.int64)
                angle = np.arccos(np.clip(centres @ row, -1, 1))[lists[mine]]
                bound = np.cos(np.maximum(0, np.maximum(angle - far[mine], near[mine] - angle) - _SLACK))
                order = np.lexsort((angle, -bound))
                total = np.cumsum(n[mine][order])
                lo, hi = ((min(len(order), int(np.searchsorted(total, x)) + 1) if x else 0) for x in (before, rows))
                part = order[lo:hi]
                named = cells[mine[part[bound[part] >= floors[at] - _SLACK]]].astype(np.int32)
                if len(named):
                    taken.append(at)
                    out.append(named)
                    held += len(named)
                if held >= CELLS_OUT:
                    yield piece(batch, taken, out)
                    taken, out, held = [], [], 0
            if out:
                yield piece(batch, taken, out)

    return queries.select("query_id", "query_vector", "wanted", "floor").mapInArrow(run, f"query_id {kind}, query_vector array<double>, floor double, cells array<int>")


def _scan(rows: DataFrame, block: pa.Table, index: Index, k: int, types: str):
    """One pass over the rows of the visited cells for a block of queries, each meeting the rows of its own cells."""
    where, matrix = _matrix(block.column("query_vector"), index.centres.shape[1])
    ids, floors = block.column("query_id").combine_chunks(), block.column("floor").to_numpy()
    cells = block.column("cells").combine_chunks()
    owner = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy())
    flat = cells.flatten().to_numpy()
    order = np.argsort(flat, kind="stable")
    shared = rows.sparkSession.sparkContext.broadcast((ids, matrix, floors, flat[order], owner[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, given, cell_of, owner = shared.value
        best = Best(k, given)
        for batch in batches:
            position, v = _matrix(batch.column(1), q.shape[1])
            keys, row_cells = batch.column(0).take(pa.array(position)), batch.column(2).to_numpy()[position]
            for cell in np.unique(row_cells):
                asked = owner[np.searchsorted(cell_of, cell):np.searchsorted(cell_of, cell, "right")]
                mine = np.flatnonzero(row_cells == cell)
                if len(asked):
                    offer_products(best, asked, q, v[mine], keys.take(pa.array(mine)))
        yield from best.batches(ids)

    return few_tasks(rows.select(index.key, index.vector, "cell")).mapInArrow(run, types), shared


def bounded_top_k(index: Index, queries: DataFrame, k: int = 10, wanted: str | None = None, query_id: str = "query_id",
                  query_vector: str = "query_vector", probes: int = PROBES, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Exact top-k of many queries: (query_id, key, similarity, rank), and (query_id, cells visited).

    With ``wanted``, a column of the queries, only rows whose attribute has that value are found (NULL: all rows). The
    counts per cell decide how far the first round goes, to ``probes`` cells of average size or k rows at least; each later
    round holds four times the rows, without the cells whose bound is below the k-th similarity so far. It ends
    when no cell is left, so that k rows are found wherever there are as many. Queries without a direction find
    nothing. Queries travel in blocks; rows are scanned where they lie.
    """
    spark, schema = queries.sparkSession, queries.schema
    kind, key_kind = schema[query_id].dataType.simpleString(), index.rows.schema[index.key].dataType.simpleString()
    types = f"query_id {kind}, key {key_kind}, similarity double"
    value = F.lit(None).cast("string") if wanted is None else F.col(wanted).cast("string")
    state = staged(queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("query_vector"), value.alias("wanted"), F.lit(-2.0).alias("floor")), "queries")
    sizes = index.cells.column("n").to_numpy()
    everything, visited = int(sizes.sum()), None
    before, rows = 0, max(k, math.ceil(probes * everything / max(1, len(sizes))))
    folder, found = scratch(spark, "bounded"), None
    while before < everything:
        asked = staged(_visits(state, index, rows, before, kind), "visits")
        seen = asked.select("query_id", F.size("cells").alias("cells"))
        visited = seen if visited is None else visited.unionByName(seen)
        n = asked.agg(F.count(F.lit(1)), F.sum(F.size("query_vector") + F.size("cells"))).first()
        blocks = math.ceil(8 * (n[1] or 0) / block_bytes)
        for b in range(blocks):
            block = (asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)).toArrow()
            if block.num_rows:
                # At most one row per cell.
                named = np.unique(block.column("cells").combine_chunks().flatten().to_numpy())
                if len(named) <= NAMED_CELLS:
                    near = index.rows.where(F.col("cell").isin(named.tolist()))
                else:
                    near = index.rows.join(F.broadcast(spark.createDataFrame([(int(c),) for c in named], "cell int")), "cell", "left_semi")
                part, shared = _scan(near, block, index, k, types)
                part.write.mode("append").parquet(folder)
                shared.unpersist()
                found = _merge(spark.read.schema(types).parquet(folder), k)
        before, rows = rows, rows * GROWTH
        if found is not None and before < everything:
            reached = found.where(F.col("rank") == k).select("query_id", F.col("similarity").alias("reached"))
            state = staged(state.join(reached, "query_id", "left").select("query_id", "query_vector", "wanted", F.coalesce("reached", "floor").alias("floor")), "queries")
    if visited is None:
        visited = spark.createDataFrame([], f"query_id {kind}, cells int")
    visited = visited.groupBy("query_id").agg(F.sum("cells").alias("cells"))
    return (spark.createDataFrame([], f"{types}, rank int") if found is None else found), visited
