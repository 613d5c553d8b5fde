"""Repeated passages: a count-min sketch of all documents rules windows out, the rest are grouped exactly.

A window is 50 consecutive words. Two equal windows hold the same 25-word runs, so also the same least one by hash: its
*mark*. Neighbouring windows share their mark, a document of n words has about n / 13 of them. What is sketched is how
many documents have a mark, which is never less than how many have one of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import texts_of
from .wordhash import groups, hashes_of, mixed, runs, words_of

WINDOW, RUN = 50, 25
# Cells of each of the sketch's two rows. Only the cells reached twice leave Spark, as bits: 32 MB at most. Beyond
# some hundred million marks more windows pass the sketch, which costs shuffle in the exact pass, not results.
CELL_BITS = 27
_PAGE = 18
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _cells(marks: np.ndarray) -> np.ndarray:
    """The cell of every mark in both rows; the second row's cells follow the first's."""
    return np.concatenate([((marks * np.uint64(f)) >> np.uint64(64 - CELL_BITS)).astype(np.int64) + (r << CELL_BITS) for r, f in enumerate(_FACTORS)])


def _windows(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the texts: text, first word, hash and mark."""
    buffer, starts, ends, first = words_of(raw)
    h = hashes_of(buffer, starts, ends)
    whole = mixed(runs(h, WINDOW, 0x9E3779B97F4A7C15))
    least = mixed(runs(h, RUN, 0xC2B2AE3D27D4EB4F))
    # The least of the 26 runs inside each window.
    for step in (1, 2, 4, 8, 10):
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
    n = np.maximum(np.diff(first) - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(raw)), n)
    word = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = first[text] + word
    return text, word, whole[at], least[at]


def _raw(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts_of(column)]


def repeated_cells(rows: DataFrame) -> np.ndarray:
    """Bits of the sketch's cells that documents reached twice or more.

    Each partition counts its documents' marks in a sketch of its own, kept sparse; Spark adds the sketches up cell by
    cell. The driver gets pages of bits, of bounded number and size.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, cells = _raw(batch.column(0)), []
            for lo, hi in groups(raw):
                text, _, _, mark = _windows(raw[lo:hi])
                if len(mark):
                    new = np.ones(len(mark), bool)
                    new[1:] = (mark[1:] != mark[:-1]) | (text[1:] != text[:-1])
                    order = np.lexsort((mark[new], text[new]))
                    m, t = mark[new][order], text[new][order]
                    once = np.ones(len(m), bool)
                    once[1:] = (m[1:] != m[:-1]) | (t[1:] != t[:-1])
                    cells.append(_cells(m[once]))
            if cells:
                cell, n = np.unique(np.concatenate(cells), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["cell", "n"])

    def page(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << _PAGE, bool)
        bits[group["cell"].to_numpy() & ((1 << _PAGE) - 1)] = True
        return pd.DataFrame({"page": [int(group["cell"].iloc[0]) >> _PAGE], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    merged = rows.select("text").mapInArrow(sketch, "cell int, n tinyint").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell")
    pages = merged.groupBy(F.shiftright("cell", _PAGE)).applyInPandas(page, "page int, bits binary").collect()
    out = np.zeros((2 << CELL_BITS) // 8, np.uint8)
    size = (1 << _PAGE) // 8
    for p in pages:
        out[p["page"] * size:(p["page"] + 1) * size] = np.frombuffer(p["bits"], np.uint8)
    return out


def _candidates(rows: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Stretches of windows with one mark that the sketch takes for repeated: id, text hash, place, mark, a hash of all
    their windows' hashes, and these."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            raw = _raw(batch.column(2))
            for lo, hi in groups(raw):
                text, word, window, mark = _windows(raw[lo:hi])
                if not len(mark):
                    continue
                new = np.ones(len(mark), bool)
                new[1:] = (mark[1:] != mark[:-1]) | (text[1:] != text[:-1])
                begin = np.flatnonzero(new)
                cell = _cells(mark[begin]).reshape(2, -1)
                seen = (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).all(axis=0)
                end = np.append(begin[1:], len(mark))[seen]
                begin = begin[seen]
                if not len(begin):
                    continue
                # A hash of the stretch from the hashes of its windows and their places in it.
                own = np.repeat(np.arange(len(begin)), end - begin)
                inside = np.arange(len(own)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin)
                hashes = window[np.repeat(begin, end - begin) + inside]
                stretch = np.add.reduceat(mixed(hashes + inside.astype(np.uint64) * np.uint64(0x165667B19E3779F9)), np.cumsum(end - begin) - (end - begin))
                offsets = pa.array(np.append(0, np.cumsum(end - begin)).astype(np.int32))
                take = pa.array(text[begin] + lo)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), batch.column(1).take(take), pa.array(word[begin].astype(np.int32)), pa.array(mark[begin].view(np.int64)),
                    pa.array(mixed(stretch).view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))], names=["id", "t", "place", "mark", "stretch", "windows"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "t", "text").mapInArrow(run, f"id {kind}, t long, place int, mark long, stretch long, windows array<long>")


def _before(first: str, own: str):
    """Whether another document's key is smaller; NULL is larger than all."""
    return F.col(first).isNotNull() & (F.col(own).isNull() | (F.col(first) < F.col(own)))


def repeated_places(rows: DataFrame) -> DataFrame:
    """(id, t, place, n): n windows from word ``place`` whose words also start in a document of smaller key.

    Whole stretches are grouped first, and only where a mark has different stretches their windows are, once for each
    kind of stretch. Equal means equal in two 64-bit hashes.
    """
    found = staged(_candidates(rows, repeated_cells(rows)), "stretches")
    kinds = staged(found.groupBy("mark", "stretch").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c"), F.min(F.size("windows")).alias("n")), "kinds")
    own = found.select("id", "t", "place", "mark", "stretch")
    shared = kinds.where("c > 1").select("mark", "stretch", "first", "n")
    later = own.join(shared, ["mark", "stretch"]).where(_before("first", "id")).select("id", "t", "place", "n")
    varied = kinds.groupBy("mark").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("mark")
    # A kind of stretch is looked at in the documents that have it first; all others lose it whole.
    leaders = found.join(kinds.select("mark", "stretch", "first"), ["mark", "stretch"]).where(F.col("id").eqNullSafe(F.col("first")))
    some = leaders.join(varied, "mark", "left_semi").select("id", "t", "place", "mark", F.posexplode("windows").alias("i", "w"))
    some = staged(some.select("id", "t", (F.col("place") + F.col("i")).alias("place"), "mark", "w"), "edges")
    # Written, so that both sides of the join are exchanged and Spark can split a window that very many stretches have.
    least = staged(some.groupBy("mark", "w").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "least")
    parts = some.join(least, ["mark", "w"]).where(_before("first", "id")).select("id", "t", "place", F.lit(1).alias("n"))
    return later.unionByName(parts)


def drop_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_removed, kept_text: the text without words covered by windows that an earlier document has.

    Earlier is a smaller key; NULL keys come last, and rows of one key remove nothing from each other. Windows are
    judged on the input. Kept words are joined by one blank; NULL texts have none; texts below 50 words lose nothing;
    an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    places = repeated_places(rows)
    gone = places.groupBy("id", "t").agg(F.collect_set(F.struct("place", "n")).alias("spans"))
    gone = gone.select(F.col("id").alias("_id"), F.col("t").alias("_t"), "spans")
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left").select("id", "text", "spans.place", "spans.n")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, removed = [], [], []
            for raw, place, n in zip(_raw(batch.column(1)), batch.column(2), batch.column(3)):
                found = raw.split()
                n_words.append(len(found))
                if place.is_valid:
                    edge = np.zeros(len(found) + 1, np.int64)
                    at = place.values.to_numpy()
                    np.add.at(edge, at, 1)
                    np.add.at(edge, np.minimum(at + n.values.to_numpy() + WINDOW - 1, len(found)), -1)
                    kept = (np.cumsum(edge)[:-1] == 0).tolist()
                    found = [w for w, k in zip(found, kept) if k]
                removed.append(n_words[-1] - len(found))
                texts.append(b" ".join(found).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], names=["id", "n_words", "n_removed", "kept_text"])

    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInArrow(cut, f"id {kind}, n_words long, n_removed long, kept_text string").withColumnRenamed("id", key)
