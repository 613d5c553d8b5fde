"""Exact top-k by inner product of integer vectors: MaxScore over a posting list per dimension, shard by shard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch, staged

SCALE, K = 64, 20
# Rows of a shard, bytes of the queries that travel to the tasks at once, rows that give queries their first floor.
SHARD_ROWS, BLOCK_BYTES, SEED_ROWS = 1 << 13, 16 << 20, 1 << 12
# Integer components are held within these, so that scores of up to 512 dimensions fit into 64 bits.
MOST = 1 << 27
_LEAST = np.iinfo(np.int64).min
# A dimension with fewer entries than this share of the rows has its posting list as places and values.
SPARSE = 0.25
PROBED_AT_ONCE = 8


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double; NULL if the vector or a component is NULL, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    held = F.transform(vector, lambda x: F.least(F.greatest(F.floor(F.lit(scale) * x.cast("double")), F.lit(-MOST).cast("long")), F.lit(MOST).cast("long")))
    return F.when(finite, held)


def _matrix(column: pa.Array, dim: int = 0) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros. At least ``dim`` columns."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, width = column.flatten().to_numpy(zero_copy_only=False), max(dim, int(n.max(initial=0)))
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width) < n[:, None]] = flat
    return out


class Shard:
    """Posting lists of some vectors, one per dimension, with the greatest and least value of each."""

    def __init__(self, matrix: np.ndarray):
        self.rows, self.dim = matrix.shape
        self.matrix = matrix.astype(np.int32)
        self.high, self.low = matrix.max(axis=0, initial=0), matrix.min(axis=0, initial=0)
        self.size = int(np.abs(matrix).max(initial=0))
        self.lists = []
        for d in range(self.dim):
            at = np.flatnonzero(matrix[:, d])
            dense = len(at) >= SPARSE * self.rows
            self.lists.append((None if dense else at, np.ascontiguousarray(matrix[:, d] if dense else matrix[at, d])))
        self.narrow = [v.astype(np.int32) for _, v in self.lists]

    def search(self, q: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a score of at least ``floor`` and their scores; ``floor`` as the least long asks for all rows.

        A row scores at most the sum of its terms' bounds. The terms of least bounds whose sum stays below the floor are
        not essential: a row in none of the other lists cannot reach it. Those lists are traversed, the rest is probed
        for the rows that are still competitive.
        """
        bound = np.maximum(np.maximum(q * self.high, q * self.low), 0)
        order = np.argsort(bound, kind="stable")
        least = int(np.searchsorted(np.cumsum(bound[order]), floor, "left")) if floor > 0 else 0
        others, essential = order[:least][::-1], order[least:]
        small = int(np.abs(q).sum()) * self.size < 1 << 31
        score, term = np.zeros(self.rows, np.int32 if small else np.int64), np.empty(self.rows, np.int32 if small else np.int64)
        for d in essential[q[essential] != 0].tolist():
            (at, wide), x = self.lists[d], score.dtype.type(q[d])
            values = self.narrow[d] if small else wide
            if at is None:
                np.multiply(values, x, out=term)
                score += term
            else:
                score[at] += values * x
        rest = int(bound[others].sum())
        found = np.flatnonzero(score >= floor - rest) if floor > _LEAST else np.arange(self.rows)
        score = score[found].astype(np.int64)
        for lo in range(0, len(others), PROBED_AT_ONCE):
            part = others[lo:lo + PROBED_AT_ONCE]
            score += self.matrix[found[:, None], part].astype(np.int64) @ q[part]
            rest -= int(bound[part].sum())
            left = score >= floor - rest
            found, score = found[left], score[left]
        return found, score


def _best(score: np.ndarray, ties: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by the smaller tie."""
    if len(score) > k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= cut)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ties[near], -score[near]))[:k]]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in tables of ``SHARD_ROWS`` rows."""
    held, n = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, SHARD_ROWS):
            part = batch.slice(lo, SHARD_ROWS)
            if n and n + part.num_rows > SHARD_ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _with_floors(queries: DataFrame, stored: DataFrame, k: int) -> DataFrame:
    """Add ``floor``: a score that k other rows reach, found among ``SEED_ROWS`` rows; the least long without as many."""
    seed = stored.select("row", "v").limit(SEED_ROWS).toArrow()
    shared = queries.sparkSession.sparkContext.broadcast((seed.column(0).to_numpy(), _matrix(seed.column(1)).astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, some = shared.value
        for batch in batches:
            own, floors = batch.column(0).to_numpy(), np.full(batch.num_rows, _LEAST)
            q = _matrix(batch.column(2), some.shape[1])
            wide = np.zeros((len(some), q.shape[1]))
            wide[:, :some.shape[1]] = some
            # Sums of doubles are exact below 2**53; beyond, no floor is taken.
            exact = np.abs(q).sum(axis=1) * np.abs(wide).max(initial=0) < 1 << 53
            for lo in range(0, len(q), 256):
                score = q[lo:lo + 256].astype(np.float64) @ wide.T
                score[rows[None, :] == own[lo:lo + 256, None]] = -np.inf
                if score.shape[1] > k:
                    kth = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                    good = np.flatnonzero(exact[lo:lo + 256])
                    floors[lo + good] = kth[good].astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors)], names=[*batch.schema.names, "floor"])

    kind = queries.schema["key"].dataType.simpleString()
    return queries.mapInArrow(run, f"row long, key {kind}, v array<long>, floor long")


def _scan(stored: DataFrame, block: pa.Table, k: int, types: str) -> tuple[DataFrame, object]:
    """One pass over the stored vectors for a block of queries: at most k candidates per query and shard."""
    ids = block.column("key").combine_chunks()
    shared = stored.sparkSession.sparkContext.broadcast((block.column("row").to_numpy(), ids, _matrix(block.column("v")), block.column("floor").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids, queries, given = shared.value
        floors = given.copy()
        for table in _shards(batches):
            rows, keys = table.column("row").to_numpy(), table.column("key").combine_chunks()
            matrix = _matrix(table.column("v"), queries.shape[1])
            wide = np.zeros((len(queries), matrix.shape[1]), np.int64)
            wide[:, :queries.shape[1]] = queries
            shard = Shard(matrix)
            ties = np.empty(len(keys), np.int64)
            ties[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))  # NULL last
            hits, asked, scores = [], [], []
            for i, q in enumerate(wide):
                found, score = shard.search(q, int(floors[i]))
                others = rows[found] != own[i]
                found, score = found[others], score[others]
                best = _best(score, ties[found], k)
                if len(best) == k:
                    floors[i] = max(floors[i], score[best[-1]])
                hits.append(found[best]), scores.append(score[best]), asked.append(np.full(len(best), i))
            at = pa.array(np.concatenate(asked))
            yield pa.RecordBatch.from_arrays([pa.array(own).take(at), ids.take(at), keys.take(pa.array(np.concatenate(hits))), pa.array(np.concatenate(scores))],
                                             names=["query_row", "query_id", "key", "score"])

    return stored.select("row", "key", "v").mapInArrow(run, types), shared


def exact_top_k(vectors: DataFrame, asks: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row that ``asks`` holds for, its k best other rows: query_id, rank from 1, ``key``, score, ties to the smaller key.

    Queries travel in blocks of ``block_bytes``; for each, the stored integer vectors are scanned where they lie, shard
    by shard, and never shuffled. Tasks start from floors that a few rows give, which only spare work. Vectors that are
    NULL or hold a NULL or non-finite component take no part; of vectors of different lengths the shorter counts as
    ending in zeros, an empty one scores 0; components are held within 2**27 in size. Rows that repeat a key are rows of
    their own: candidates of each other and, as queries, each with its own ranks. A NULL key is no smaller than any
    other and asks nothing unless ``asks`` says so. An empty table gives no rows; other columns are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("key"), asks.alias("asks"), integers(F.col(vector), scale).alias("v")).where("v IS NOT NULL")
    stored = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = staged(_with_floors(stored.where("asks").select("row", "key", "v"), stored, k), "asked")
    types = f"query_row long, query_id {kind}, key {kind}, score long"
    known = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not known["n"]:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{key}` {kind}, score long")
    folder = scratch(spark, "best")
    blocks = math.ceil(known["n"] * 8 * (known["dim"] + 3) / block_bytes)
    for b in range(blocks):
        block = (asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b)).toArrow()
        if block.num_rows:
            found, shared = _scan(stored, block, k, types)
            found.write.mode("append").parquet(folder)
            shared.unpersist()
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = spark.read.schema(types).parquet(folder).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("key").alias(key), "score")
