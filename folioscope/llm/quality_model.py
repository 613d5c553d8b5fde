"""A supervised quality classifier: averaged embeddings of hashed words, word pairs and character n-grams, softmax on top.

Training is stochastic gradient descent in numpy on a bounded sample; scoring folds the learned vectors and the output
layer into one number per hashed feature, which is averaged over a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .wordhash import groups, hashes_of, lanes, words_of

BUCKET_BITS, DIM = 15, 12
CHARS = (3, 4)
# The model is fitted on at most this many labelled texts, those first by a hash of their keys.
SAMPLE = 4000
EPOCHS, RATE, BATCH, SEED = 12, 0.5, 16, 5
FOLDS, HELD_OUT, CUT = 5, 0, 0.3


def features(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every kind of feature: hashed features of all texts one after the other, and where each text's begin (and end).

    Kinds are words, pairs of neighbouring words (equal words make one feature, whatever the word), and runs of 3 and 4
    bytes. Each kind has buckets of its own.
    """
    buffer, starts, ends, first = words_of(raw)
    h = hashes_of(buffer, starts, ends)
    yield _bucket(h, 0), first
    pairs = np.maximum(np.diff(first) - 1, 0)
    at = np.concatenate([[0], np.cumsum(pairs)])
    left = np.repeat(first[:-1], pairs) + np.arange(at[-1]) - np.repeat(at[:-1], pairs)
    yield _bucket(h[left] ^ h[left + 1] if len(left) else h[:0], 1), at
    view, size = lanes(buffer), np.array([len(r) for r in raw], np.int64)
    begins = np.cumsum(size + 1) - size - 1
    for no, n in enumerate(CHARS):
        many = np.maximum(size - n + 1, 0)
        at = np.concatenate([[0], np.cumsum(many)])
        place = np.repeat(begins, many) + np.arange(at[-1]) - np.repeat(at[:-1], many)
        yield _bucket((view & np.uint64((1 << 8 * n) - 1))[place], 2 + no), at


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (((h + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + (kind << BUCKET_BITS)


KINDS = 2 + len(CHARS)


@dataclass(frozen=True)
class Model:
    """Per feature its vector times the difference of the output layer's rows, and the difference of its biases."""
    weight: np.ndarray
    bias: float

    def score(self, raw: list[bytes]) -> np.ndarray:
        return scores(raw, self.weight, self.bias)


def scores(raw: list[bytes], weight: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1; a text without features gets that of the bias alone."""
    out = np.zeros(len(raw))
    for lo, hi in groups(raw):
        total, n = np.zeros(hi - lo), np.zeros(hi - lo)
        for f, at in features(raw[lo:hi]):
            full = np.flatnonzero(np.diff(at))
            if len(full):
                total[full] += np.add.reduceat(weight[f], at[full])
                n += np.diff(at)
        out[lo:hi] = total / np.maximum(n, 1)
    return 1 / (1 + np.exp(-np.clip(out + bias, -60, 60)))


def train(counted: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit on (features, counts, label) of each text, in a seeded order; without texts or with one label, scores are 0.5 or near that label."""
    rng = np.random.default_rng(seed)
    vectors, output, bias = rng.normal(0, 0.1, (KINDS << BUCKET_BITS, DIM)).astype(np.float32), np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    output += rng.normal(0, 0.1, output.shape).astype(np.float32)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(counted))
        for lo in range(0, len(order), BATCH):
            part = [counted[i] for i in order[lo:lo + BATCH]]
            share = [(n / max(n.sum(), 1)).astype(np.float32) for _, n, _ in part]
            mean = np.stack([w @ vectors[ids] for w, (ids, _, _) in zip(share, part)])
            z = mean @ output + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), [x[2] for x in part]] -= 1
            back = p @ output.T
            output -= rate * mean.T @ p / len(part)
            bias -= rate * p.mean(axis=0)
            # A text names a feature once. Its step isn't divided by the batch: most features occur in few of its texts.
            for w, (ids, _, _), b in zip(share, part, back):
                vectors[ids] -= (rate * 20 * w)[:, None] * b
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _raw(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts_of(column)]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from the labelled rows outside the held-out fold, at most ``sample`` of them. The driver gets the counts of
    these texts' features, of which a text has a bounded number.

    Rows without a key meet no label; NULL texts count as empty; a key with several texts gives the least of them, one
    with unlike labels none; labels other than 0 and 1 are left out. Empty tables give a model that scores 0.5.
    """
    own = labels.select(F.col(key).cast("string").alias("k"), F.col(label).cast("int").alias("y")).where("k IS NOT NULL AND y IN (0, 1)")
    own = own.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").where(~held_out("k")).select("k", "y")
    chosen = own.orderBy(F.xxhash64("k"), "k").limit(sample)
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "k")
    rows = rows.groupBy("k", "y").agg(F.min("text").alias("text"))  # one text for a key, however often it is there

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for r in _raw(batch.column(1)):
                f, n = np.unique(np.concatenate([f for f, _ in features([r])]), return_counts=True)
                ids.append(f.astype("<i4").tobytes()), counts.append(n.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), batch.column(2)], names=["k", "f", "n", "y"])

    found = rows.select("k", "text", "y").mapInArrow(count, "k string, f binary, n binary, y int").collect()
    found.sort(key=lambda r: (r["k"], bytes(r["f"])))
    return train([(np.frombuffer(r["f"], "<i4"), np.frombuffer(r["n"], "<i4"), r["y"]) for r in found])


def held_out(key: str):
    """The fold that training never sees."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, score, predicted. Nothing is shuffled.

    The score depends on the text alone. NULL texts count as empty and get the biases' score; NULL keys are in no fold
    (held_out false); repeated rows are scored each; an empty table gives an empty result; other columns are not read.
    """
    # Arrays alone travel: a class would be looked up in the package, which workers need not have.
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scores(_raw(batch.column(2)), *shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=[key, "held_out", "score", "predicted"])

    rows = docs.select(F.col(key), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, held_out boolean, score double, predicted int")
