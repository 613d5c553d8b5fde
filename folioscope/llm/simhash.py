"""SimHash near duplicates: fingerprints in tasks, balls of half the radius met in a shuffle, components by rounds of joins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import forget, packed, texts_of, unpacked
from .components import components

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 2
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CHUNK = 1 << 16
# Distinct fingerprints in a task that emits their variants.
EMIT_ROWS = 1 << 14


def fingerprint(text: str) -> int:
    """64 bits, each set if it is set in over half the hashes of the text's shingles; 0 for a text without words."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").translate(_UPPER).split()  # splits bytes at the six ASCII blanks
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(found))
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(found) - k + 1
    lo, hi = starts[:n].tolist(), ends[k - 1:].tolist()
    for c in range(0, n, _CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(lo[c:c + _CHUNK], hi[c:c + _CHUNK])], ">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``fp``, the fingerprint as a signed long, and text_hash. NULL texts count as empty; nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            fps = np.array([fingerprint(t) for t in texts_of(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), batch.column(2)], names=["key", "fp", "text_hash"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), _text_hash(text).alias("text_hash"))
    return rows.mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, fp long, text_hash long")


def ball_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at most ``radius`` (0 or 2) bits apart.

    Every fingerprint sends itself and each one-bit variant; two at distance 2 or less share a variant. All that meet
    in a variant are within one bit of it, at most 65, so each is linked to the smallest of them instead of all pairs.
    """
    if radius not in (0, 2):
        raise ValueError("the balls of half the radius are those of 0 or 1 bits")
    if radius == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(BITS)])
    sent = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = sent.groupBy("variant").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    links = met.select("a", F.explode("all").alias("b")).where("a <> b").distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text", with_hash: bool = False) -> DataFrame:
    """Per row: key, fp, component_id, the smallest key reachable over links of at most ``radius`` bits.

    Rows with the same fingerprint are one node, so a group of copies of any size is one row of the search. NULL and
    empty texts share fingerprint 0 and are linked like any other. A component whose keys are all NULL has a NULL
    component_id; repeated rows stay repeated; an empty table gives an empty result; other columns are not read.
    """
    prints = staged(fingerprints(docs, key, text), "simhash")
    nodes = staged(prints.groupBy("fp").agg(F.min("key").alias("key")), "nodes")
    # Each sends 65 rows: a small table of them is dealt out first.
    dealt = nodes.select("fp").repartition(max(1, math.ceil(nodes.count() / EMIT_ROWS)))
    linked = components(staged(ball_links(dealt, radius), "links"))
    # Fingerprints without a link are components of their own.
    roots = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("key").alias("component_id"))
    named = roots.select("fp", "root").join(least, "root").select("fp", "component_id")
    more = ["text_hash"] if with_hash else []
    return prints.join(named, "fp").select(F.col("key").alias(key), "fp", "component_id", *more)


def keep_one(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates: that of the smallest key (NULL last), then the smallest text hash.

    Its columns pass unchanged; of rows equal in key and text one stays. NULL texts count as empty.
    """
    return least_rows(docs, staged(near_duplicates(docs, radius, key, text, with_hash=True), "groups"), key, text)


def least_rows(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` of each group of ``found``: key, component_id and text_hash of every row.

    As ``keep_one`` has it: the smallest key, NULL last, then the smallest text hash; of rows equal in both one stays,
    by a hash of the row. A group whose keys are all NULL keeps one row by its text hash; empty tables give no rows.
    """
    order = F.struct(F.col(key).isNull(), F.col(key).alias("k"), "text_hash")
    best = found.groupBy("component_id").agg(F.min(order).alias("m"))
    name = ["k", "is_null", "text_hash"]
    winners = best.select(F.coalesce(F.col("m.k").cast("string"), F.lit("")).alias("k"), F.col("m.k").isNull().alias("is_null"), F.col("m.text_hash").alias("text_hash")).distinct()
    whole = packed(docs, k=F.coalesce(F.col(key).cast("string"), F.lit("")), is_null=F.col(key).isNull(), text_hash=_text_hash(text))
    # The join and the numbering share one exchange of the rows.
    kept = whole.join(winners, name, "left_semi").withColumn("copy", F.row_number().over(Window.partitionBy(*name).orderBy(F.xxhash64("row"))))
    return unpacked(kept.where("copy = 1"), docs.columns)
