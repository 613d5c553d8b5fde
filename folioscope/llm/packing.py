"""Best-fit packing planned on a histogram of lengths; pieces find their slots by their rank within their length."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import ranked, texts_of
from .encoding import encoder, public_path

CAPACITY, END_ID = 2048, 0


@dataclass
class Plan:
    """For each length, ranges of ranks: where a range begins, its first sequence, pieces per sequence, offset of the first."""
    begin: dict[int, list[int]] = field(default_factory=dict)
    sequence: dict[int, list[int]] = field(default_factory=dict)
    per: dict[int, list[int]] = field(default_factory=dict)
    base: dict[int, list[int]] = field(default_factory=dict)
    sequences: int = 0


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best fit over lengths from long to short, a whole range of sequences with the same room at a time.

    A piece goes to the sequence with the least room that holds it; pieces of the same length then go on into the same
    one, so a range of sequences takes ``room // length`` each. Work and size depend on the number of lengths, at most
    ``capacity``, and not on the number of pieces.
    """
    plan, rooms, free = Plan(), [], {}  # rooms: sorted; free: room -> ranges of sequences (first, how many)

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in free:
                bisect.insort(rooms, room)
                free[room] = []
            free[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        own = [plan.begin.setdefault(length, []), plan.sequence.setdefault(length, []), plan.per.setdefault(length, []), plan.base.setdefault(length, [])]
        while left:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = free[room].pop()
                if not free[room]:
                    del free[room], rooms[i]
            else:
                room, first, n = capacity, plan.sequences, -(-left // (capacity // length))
                plan.sequences += n
            k = room // length
            full = min(n, left // k)
            for per, many in ((k, full), (left - full * k, 1)):
                if per and many and (per == k or n > full):
                    for values, x in zip(own, (rank, first, per, capacity - room)):
                        values.append(x)
                    put(room - per * length, first, many)
                    rank, left, first, n, full = rank + per * many, left - per * many, first + many, n - many, 0
                if left >= k:
                    break
            put(room, first, n)
    return plan


def token_pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
                 key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32[, ids]) of every text's ids with ``end_id`` behind them.

    Only texts of more than ``capacity`` ids are cut. NULL texts count as empty and are one piece of the end id.
    """
    path = path or public_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            ids, counts = coder.encode(texts_of(batch.column(1)))
            raw, end = ids.astype("<u4").tobytes(), int(end_id).to_bytes(4, "little")
            row, piece, start, length, crc, blobs, at = [], [], [], [], [], [], 0
            for r, n in enumerate(counts.tolist()):
                own = raw[4 * at:4 * (at + n)] + end
                at += n
                for p, lo in enumerate(range(0, n + 1, capacity)):
                    part = own[4 * lo:4 * (lo + capacity)]
                    row.append(r), piece.append(p), start.append(lo), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if with_ids:
                        blobs.append(part)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(blobs, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return rows.mapInArrow(run, schema)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces (key, piece, start, length, ids_crc32).

    The driver sees one count per length. The plan, a few ranges per length, goes to the tasks, which look up a
    piece's range by its rank; lengths that most pieces share are ranked in many groups.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_best_fit(counts, capacity)
    lookup = {n: [np.array(x[n], np.int64) for x in (plan.begin, plan.sequence, plan.per, plan.base)] for n in counts}
    columns = pieces.columns
    names = [*columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                begin, first, per, base = lookup[n]
                rows = np.flatnonzero(length == n)
                i = np.searchsorted(begin, rank[rows], "right") - 1
                k = rank[rows] - begin[i]
                sequence[rows] = first[i] + k // per[i]
                offset[rows] = base[i] + k % per[i] * n
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(sequence), pa.array(offset)], names=names)

    order = F.xxhash64("key", "piece")
    numbered = ranked(pieces, ["length"], order, ["key", "piece", "start", "ids_crc32"])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema] + ["sequence_id long", "offset long"])
    return numbered.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset; sequences hold at most ``capacity`` ids.

    Every row of ``docs`` is packed: NULL and empty texts as their end id, repeated rows each, NULL keys as NULL, an
    empty table gives an empty result; other columns are not read.
    """
    pieces = staged(token_pieces(docs, path, end_id, capacity, key, text), "pieces")
    return place(pieces, capacity).withColumnRenamed("key", key)


def sequences(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids as little-endian unsigned 32-bit integers.

    As ``pack`` has them: NULL and empty texts are their end id, repeated rows are packed each, rows without a key too;
    an empty table has no sequence. A sequence has at most ``capacity`` ids, however many rows share a key.
    """
    pieces = staged(token_pieces(docs, path, end_id, capacity, key, text, with_ids=True), "pieces")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return place(pieces, capacity).groupBy("sequence_id").agg(joined.alias("ids"))
