"""Cosine search by product-quantised codes: a byte per part of a vector, distances from tables, the best ranked again exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine
from ..session import scratch, staged
from .search import BLOCK_BYTES, _best_rows, _matrix, _merge, _rank_table

# Values of a byte, rows that the codebooks are learned from, steps of learning, candidates ranked again per result.
VALUES, SAMPLE_ROWS, STEPS, AGAIN = 256, 1 << 16, 12, 20
TILE_ROWS = 1 << 14


def _edges(dim: int, parts: int) -> list[int]:
    return [dim * i // parts for i in range(parts + 1)]


def _learn(x: np.ndarray, values: int, steps: int, seed: int) -> np.ndarray:
    """Centres of the rows of ``x`` by Lloyd's steps from distinct rows; with few distinct rows these are the centres."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:values]]
    for _ in range(steps if len(distinct) > values else 0):
        near = np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, x[:, d], len(centres)) for d in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def learn_codebooks(vectors: DataFrame, parts: int | None = None, sample_rows: int = SAMPLE_ROWS, steps: int = STEPS, seed: int = 42,
                    vector: str = "embedding", key: str = "chunk_id") -> list[np.ndarray]:
    """A codebook of at most 256 centres per part of the unit vectors, a part of four dimensions unless told otherwise.

    Learned from about ``sample_rows`` rows, chosen by a hash of their key; the parts are learned side by side.
    """
    usable = vectors.where(F.size(vector) > 0)
    known = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    dim = known["dim"] or 0
    parts = parts or max(1, dim // 4)
    edges, every = _edges(dim, parts), max(1, math.ceil(known["n"] / sample_rows))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = _matrix(batch.column(0), dim)
            for p in range(parts):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p)), pa.array(rows[:, edges[p]:edges[p + 1]].tolist(), pa.list_(pa.float64()))], names=["part", "x"])

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        found = _learn(np.array(rows["x"].tolist(), np.float64), VALUES, steps, seed)
        return pd.DataFrame({"part": int(rows["part"].iloc[0]), "place": range(len(found)), "centre": found.tolist()})

    sample = usable.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).select(vector)
    cuts = sample.mapInArrow(cut, "part long, x array<double>").groupBy("part")
    table = cuts.applyInPandas(learn, "part long, place long, centre array<double>").orderBy("part", "place").toPandas()
    return [np.array(table.loc[table["part"] == p, "centre"].tolist()) for p in range(parts)] if len(table) else []


def encode(vectors: DataFrame, books: list[np.ndarray], vector: str = "embedding", key: str = "chunk_id") -> DataFrame:
    """(key, code): per vector one byte a part, the place of the nearest centre. Vectors without a direction have no code."""
    dim = sum(b.shape[1] for b in books)
    edges = np.cumsum([0, *[b.shape[1] for b in books]])
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            position, rows = _matrix(batch.column(1), dim)
            code = np.zeros((len(rows), len(books)), np.uint8)
            for p, centres in enumerate(books):
                for lo in range(0, len(rows), TILE_ROWS):
                    x = rows[lo:lo + TILE_ROWS, edges[p]:edges[p + 1]]
                    code[lo:lo + TILE_ROWS, p] = np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(position)), pa.array([c.tobytes() for c in code], pa.binary())], names=["key", "code"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.where(F.size(vector) > 0).select(key, vector).mapInArrow(run, f"key {kind}, code binary")


def _scan(coded: DataFrame, block: pa.Table, books: list[np.ndarray], most: int, types: str):
    """One pass over the codes for a block of queries: ``most`` candidates per query and tile of rows."""
    where, matrix = _matrix(block.column("query_vector"), sum(b.shape[1] for b in books))
    edges = np.cumsum([0, *[b.shape[1] for b in books]])
    tables = np.zeros((len(matrix), len(books), VALUES), np.float32)
    for p, centres in enumerate(books):
        tables[:, p, :len(centres)] = matrix[:, edges[p]:edges[p + 1]] @ centres.T
    shared = coded.sparkSession.sparkContext.broadcast((block.column("query_id").combine_chunks().take(pa.array(where)), tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tables = shared.value
        floor = np.full(len(ids), -np.inf)
        parts = tables.shape[1]
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE_ROWS):
                keys = batch.column(0).slice(lo, TILE_ROWS)
                code = np.frombuffer(b"".join(batch.column(1).slice(lo, TILE_ROWS).to_pylist()), np.uint8).reshape(-1, parts)
                at = code.T.astype(np.intp) + (np.arange(parts) * VALUES)[:, None]
                ties = np.empty(len(keys), np.int64)
                ties[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))
                schema = pa.schema([("query_id", ids.type), ("key", keys.type), ("similarity", pa.float64())])
                scores, hits = [], []
                for i, table in enumerate(tables.reshape(len(ids), -1)):
                    s = table[at].sum(axis=0, dtype=np.float64)
                    best = _best_rows(s, most, ties, floor, i)
                    scores.append(s), hits.append(best)
                yield _rank_table(ids, hits, keys, scores, schema)

    return coded.mapInArrow(run, types), shared


def coded_top_k(coded: DataFrame, vectors: DataFrame, books: list[np.ndarray], queries: DataFrame, k: int = 10, again: int = AGAIN,
                vector: str = "embedding", key: str = "chunk_id", query_id: str = "query_id", query_vector: str = "query_vector",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Top-k of many queries: (query_id, key, similarity, rank).

    The codes give ``again`` * k candidates a query; their vectors alone are fetched by key and ranked by exact similarity.
    ``coded`` is the written result of ``encode``. Queries travel in blocks by the bytes of their tables.
    """
    spark = queries.sparkSession
    kind, key_kind = queries.schema[query_id].dataType.simpleString(), vectors.schema[key].dataType.simpleString()
    types = f"query_id {kind}, key {key_kind}, similarity double"
    asked = staged(queries.where(F.size(query_vector) > 0).select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("query_vector")), "queries")
    n = asked.count()
    if not n or not books:
        return spark.createDataFrame([], f"{types}, rank int")
    folder, blocks = scratch(spark, "coded"), math.ceil(n * 4 * VALUES * len(books) / block_bytes)
    for b in range(blocks):
        block = (asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)).toArrow()
        if block.num_rows:
            found, shared = _scan(coded, block, books, again * k, types)
            found.write.mode("append").parquet(folder)
            shared.unpersist()
    rough = _merge(spark.read.schema(types).parquet(folder), again * k).select("query_id", "key").join(asked, "query_id")
    exact = rough.join(vectors.select(F.col(key).alias("key"), F.col(vector).alias("v")), "key").select("query_id", "key", cosine(F.col("v"), F.col("query_vector")).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "key"))
    return exact.where("similarity IS NOT NULL").withColumn("rank", rank).where(F.col("rank") <= k)
