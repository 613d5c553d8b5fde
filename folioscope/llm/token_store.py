"""A store of token ids as directly addressable codes: any id can be read without decoding those around it."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch, staged
from .common import by_bytes, texts_of
from .encoding import encoder, public_path

END_ID = 2
CHUNK_BITS, RANK_EVERY = 8, 512  # one chunk is a byte; a directory entry per 512 flags
SEGMENT_IDS = 1 << 20
# So many numbers of segments are named in a filter that Parquet can use.
FEW_SEGMENTS = 100
_MAGIC = b"DAC1"


def encode_ids(ids: np.ndarray) -> bytes:
    """Ids in levels of one byte each.

    Level 0 holds the lowest byte of every id; a bit map flags those that go on, whose next bytes form the next level
    in the same order. A rank directory counts the flags before every 512th place, so that the place of a continued id
    in the next level takes one entry and at most 512 bits. Layout: magic, number of levels (u4), ids per level (u8
    each); then per level bytes, flags (little bit order), directory (u4 each), the last level without flags.
    """
    value, levels = ids.astype(np.uint32), []
    while True:
        more = value > 0xFF
        levels.append(((value & 0xFF).astype(np.uint8), more))
        value = value[more] >> np.uint32(8)
        if not len(value):
            break
    parts = [_MAGIC, len(levels).to_bytes(4, "little"), np.array([len(b) for b, _ in levels], "<u8").tobytes()]
    for b, more in levels[:-1]:
        before = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_EVERY)))])[:-1]
        parts += [b.tobytes(), np.packbits(more, bitorder="little").tobytes(), before.astype("<u4").tobytes()]
    return b"".join([*parts, levels[-1][0].tobytes()])


class Codes:
    """Reads what ``encode_ids`` wrote."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n_levels = int.from_bytes(data[4:8], "little")
        sizes = np.frombuffer(data, "<u8", n_levels, 8).astype(np.int64).tolist()
        at, self.bytes, self.flags, self.ranks = 8 + 8 * n_levels, [], [], []
        for i, n in enumerate(sizes):
            self.bytes.append(np.frombuffer(data, np.uint8, n, at))
            at += n
            if i < n_levels - 1:
                n_flags, n_ranks = -(-n // 8), -(-n // RANK_EVERY)
                self.flags.append(np.frombuffer(data, np.uint8, n_flags, at))
                self.ranks.append(np.frombuffer(data, "<u4", n_ranks, at + n_flags))
                at += n_flags + 4 * n_ranks

    def __len__(self) -> int:
        return len(self.bytes[0])

    def __getitem__(self, i: int) -> int:
        """One id, from one byte, one flag and one rank per level."""
        value = int(self.bytes[0][i])
        for level, flags in enumerate(self.flags):
            if not flags[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_EVERY
            inside = np.unpackbits(flags[block * RANK_EVERY // 8:(i >> 3) + 1], bitorder="little")[:i - block * RANK_EVERY]
            i = int(self.ranks[level][block]) + int(inside.sum())
            value |= int(self.bytes[level + 1][i]) << (8 * (level + 1))
        return value

    def all(self) -> np.ndarray:
        out = self.bytes[0].astype(np.uint32)
        where = np.arange(len(out))
        for level, flags in enumerate(self.flags):
            where = where[np.unpackbits(flags, count=len(where), bitorder="little").astype(bool)]
            out[where] |= self.bytes[level + 1].astype(np.uint32) << np.uint32(8 * (level + 1))
        return out


def write_store(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending order of key to ``folder``.

    A row of the store is a segment of about a million ids: its place (part, seq), the keys and numbers of ids of its
    texts, and ``codes``, the bytes of ``encode_ids``. Segments lie in Parquet files, a folder for each part and about a
    segment in a row group, so that a reader opens what it asks for; any file system of the cluster takes them and a
    task that is repeated leaves no second copy. A text is never parted. NULL keys come last,
    rows of one key are ordered by a hash of their text, NULL texts count as empty.
    """
    path = path or public_path("byte_bpe_50k.json")
    kind = docs.schema[key].dataType
    order = [F.asc_nulls_last("key"), F.xxhash64("text")]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, coder = TaskContext.get().partitionId(), 0, encoder(path)
        keys, lengths, held, n_held = [], [], [], 0

        def segment():
            lists = pa.ListArray.from_arrays(pa.array([0, sum(map(len, keys))], pa.int32()), pa.concat_arrays(keys))
            n = np.concatenate(lengths).astype("<u4")
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([int(n.sum())], pa.int64()), lists,
                                               pa.array([n.tobytes()], pa.binary()), pa.array([encode_ids(np.concatenate(held))], pa.binary())],
                                              names=["part", "seq", "n_ids", "keys", "lengths", "codes"])

        for batch in batches:
            every = texts_of(batch.column(1))
            for lo, hi in by_bytes(every, SEGMENT_IDS):
                ids, counts = coder.encode(every[lo:hi])
                ends = np.cumsum(counts + 1)
                own = np.full(int(ends[-1]), end_id, np.uint32)
                body = np.ones(len(own), bool)
                body[ends - 1] = False
                own[body] = ids
                keys.append(batch.column(0).slice(lo, hi - lo)), lengths.append(counts + 1), held.append(own)
                n_held += len(own)
                if n_held >= SEGMENT_IDS:
                    yield segment()
                    seq, keys, lengths, held, n_held = seq + 1, [], [], [], 0
        if held:
            yield segment()

    schema = f"part int, seq int, n_ids long, keys array<{kind.simpleString()}>, lengths binary, codes binary"
    dealt.mapInArrow(run, schema).write.mode("error").option("parquet.block.size", 2 * SEGMENT_IDS).partitionBy("part").parquet(folder)


def _starts(store: DataFrame) -> DataFrame:
    """(part, seq, first): ids before each segment, by running sums over the parts and within each part."""
    sizes = store.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return sizes.withColumn("inner", inner).join(before, "part").select("part", "seq", (F.col("before") + F.col("inner")).alias("first"))


def _store(spark: SparkSession, folder: str) -> DataFrame | None:
    """The segments of a store; None for that of an empty table, which has no part."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/part=*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return spark.read.parquet(folder) if found else None


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id", kind: str = "long") -> DataFrame:
    """Per document of the store: key, start (ids before it), n_tokens, ids_crc32 of its ids as 32-bit integers."""
    store = _store(spark, folder)
    if store is None:
        return spark.createDataFrame([], f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long")
    kind = store.schema["keys"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n = np.frombuffer(batch.column(3)[r].as_py(), "<u4").astype(np.int64)
                raw = Codes(batch.column(4)[r].as_py()).all().astype("<u4").tobytes()
                ends = np.cumsum(n)
                crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
                own = batch.column(2)[r].values
                yield pa.RecordBatch.from_arrays([own, pa.array([batch.column(0)[r].as_py()] * len(n), pa.int32()), pa.array([batch.column(1)[r].as_py()] * len(n), pa.int32()),
                                                  pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())], names=["key", "part", "seq", "own", "n_tokens", "ids_crc32"])

    rows = store.select("part", "seq", "keys", "lengths", "codes").mapInArrow(run, f"key {kind.simpleString()}, part int, seq int, own long, n_tokens long, ids_crc32 long")
    return rows.join(_starts(store), ["part", "seq"]).select(F.col("key").alias(key), (F.col("first") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, folder: str, places: DataFrame, place: str = "place") -> DataFrame:
    """(place, id) per row of ``places``, counted from the first id of the store; outside of it, and for NULL, id is NULL.

    Each id is read by itself from its segment. Sizes of segments alone tell which parts hold the places; no other
    part's files are opened, and within them no row group without an asked segment.
    """
    store = _store(spark, folder)
    asked_for = places.select(F.col(place).cast("long").alias("place"))
    if store is None:
        return asked_for.withColumn("id", F.lit(None).cast("long"))
    parts = _starts(store).join(store.select("part", "seq", "n_ids"), ["part", "seq"])
    # Places and segments meet by the million of ids they lie in; a segment touches few of them.
    touched = F.sequence(F.expr(f"first div {SEGMENT_IDS}"), F.expr(f"(first + n_ids - 1) div {SEGMENT_IDS}"))
    parts = parts.withColumn("million", F.explode(touched))
    once = asked_for.distinct().withColumn("million", F.expr(f"place div {SEGMENT_IDS}"))
    inside = once.join(parts, "million").where((F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("n_ids")))
    # A segment has about a million places.
    asked = staged(inside.groupBy("part", "seq").agg(F.collect_list("place").alias("places"), F.min("first").alias("first")), "asked")
    own = [r["part"] for r in asked.select("part").distinct().collect()]  # a row per part
    few = [r["seq"] for r in asked.select("seq").distinct().limit(FEW_SEGMENTS + 1).collect()]
    held = store.where(F.col("part").isin(own))
    if len(few) <= FEW_SEGMENTS:
        held = held.where(F.col("seq").isin(few))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, wanted, first in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                c = Codes(codes)
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([c[p - first] for p in wanted], pa.int64())], names=["place", "id"])

    found = held.select("part", "seq", "codes").join(asked, ["part", "seq"]).select("codes", "places", "first").mapInArrow(run, "place long, id long")
    return asked_for.join(found, "place", "left").select("place", "id")


def stored_documents(docs: DataFrame, path: str | None = None, end_id: int = END_ID, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Write a store in the shared folder and read its documents back. Empty tables give an empty result."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-store")
    write_store(docs, folder, path, end_id, key, text)
    return read_documents(spark, folder, key, docs.schema[key].dataType.simpleString())
