"""MinHash fingerprints of documents, edited documents, and near duplicates by bands of signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import texts_of
from .components import components
from .wordhash import groups, hashes_of, mixed, runs, words_of

SHINGLE, PERMUTATIONS, THRESHOLD = 5, 128, 0.8
BANDS = 32  # of 4 values; 0.8 alike texts miss all of them once in 30 million
_CHUNK = 1 << 15
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
# Universal hashing modulo 2**64: odd factors and offsets drawn once from a fixed seed.
_DRAWN = np.random.Generator(np.random.PCG64(2024)).integers(0, 1 << 63, (2, PERMUTATIONS), dtype=np.uint64)
FACTORS, OFFSETS = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]


def shingles(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of the texts, and where each text's begin (and the end).

    A text of one to four words has one shingle, all its words; a text without words has none.
    """
    buffer, starts, ends, first = words_of(raw)
    h = hashes_of(buffer, starts, ends)
    n = np.diff(first)
    full, out, at = runs(h, SHINGLE, 0x9E3779B97F4A7C15), [], np.zeros(len(raw) + 1, np.int64)
    np.cumsum(np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1)), out=at[1:])
    out = np.zeros(at[-1], np.uint64)
    long = n >= SHINGLE
    pick = np.repeat(long, np.diff(at))
    own = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at)) + np.repeat(first[:-1], np.diff(at))
    out[pick] = full[own[pick]]
    for i in np.flatnonzero((n > 0) & ~long).tolist():
        out[at[i]] = runs(h[first[i]:first[i + 1]], int(n[i]), 0x9E3779B97F4A7C15)[0] + np.uint64(n[i])
    return mixed(out), at


def signatures(raw: list[bytes]) -> np.ndarray:
    """One row of least values per text; a text without words has the highest value everywhere."""
    out = np.full((len(raw), PERMUTATIONS), _NONE, np.uint64)
    for lo, hi in groups(raw):
        s, at = shingles(raw[lo:hi])
        for c in range(0, len(s), _CHUNK):
            part = s[c:c + _CHUNK]
            rows = np.flatnonzero((at[:-1] < c + len(part)) & (at[1:] > c) & (at[1:] > at[:-1]))  # not those without shingles
            begin = np.maximum(at[rows] - c, 0)
            v = np.empty_like(part)
            for k in range(PERMUTATIONS):
                np.multiply(part, FACTORS[k], out=v)
                v += OFFSETS[k]
                out[lo + rows, k] = np.minimum(out[lo + rows, k], np.minimum.reduceat(v, begin))
    return out


def compact(sig: np.ndarray) -> np.ndarray:
    """A byte of each least value: what a fingerprint keeps."""
    return ((sig >> np.uint64(24)) & np.uint64(0xFF)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of compact signatures, corrected for bytes that agree by chance."""
    same = (a == b).mean(axis=1)
    return np.clip((same - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last third (floor, in code points) replaced by the first as many of another."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_FIELDS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _measured(texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    changed = [edited(a, b).encode("utf-8", "surrogatepass") for a, b in zip(texts, following)]
    new = compact(signatures(changed))
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
            pa.array([r.tobytes() for r in own], pa.binary()), pa.array([r.tobytes() for r in new], pa.binary()),
            pa.array(likeness(own, new)), pa.array(likeness(own, after))]


def _slices(raw: list[bytes]) -> list[tuple[int, int]]:
    return list(groups(raw, 8 << 20))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next.

    Rows are dealt into ranges of descending key (NULL last, rows of one key by a hash of their text) and follow each
    other within a range; the last of a range meets the first of the next through two rows per range that carry their
    text, the last of all meets the first. NULL texts count as empty; a table of one row is followed by itself; repeated
    rows count each; an empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("key"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, begun = TaskContext.get().partitionId(), None, False

        def given(keys, texts, following, own, after):
            n = len(texts)
            return pa.RecordBatch.from_arrays([keys, *_measured(texts, following, own, after), pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names)

        def edge(keys, head, tail):
            nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([keys, *nothing, pa.array([part], pa.int32()), pa.array([head], pa.string()), pa.array([tail], pa.string())], names=names)

        for batch in batches:
            every = texts_of(batch.column(1))
            raw = [t.encode("utf-8", "surrogatepass") for t in every]
            for lo, hi in _slices(raw):
                keys, texts, own = batch.column(0).slice(lo, hi - lo), every[lo:hi], compact(signatures(raw[lo:hi]))
                if not begun:
                    begun = True
                    yield edge(keys.slice(0, 1), texts[0], None)
                if held is not None:
                    keys = pa.concat_arrays([held[0], keys])
                    texts, own = [held[1], *texts], np.vstack([held[2], own])
                if len(texts) > 1:
                    yield given(keys.slice(0, len(texts) - 1), texts[:-1], texts[1:], own[:-1], own[1:])
                held = keys.slice(len(texts) - 1), texts[-1], own[-1:]
        if held is not None:
            yield edge(held[0], None, held[1])

    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "head", "tail"]
    done = staged(dealt.mapInArrow(run, f"key {kind}, {_FIELDS}, part int, head string, tail string"), "fingerprints")

    # The ranges follow each other by number; only their numbers meet in one place.
    heads, tails = done.where("head IS NOT NULL").select("part", "head"), done.where("tail IS NOT NULL").select("key", "part", "tail")
    parts = heads.select("part")
    follows = F.lead("part").over(Window.orderBy("part"))
    first = F.min("part").over(Window.partitionBy())
    pairs = parts.select("part", F.coalesce(follows, first).alias("next"))
    last = tails.join(pairs, "part").join(heads.withColumnRenamed("part", "next"), "next").select("key", "tail", "head")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = texts_of(batch.column(1)), texts_of(batch.column(2))
            sig = [compact(signatures([t.encode("utf-8", "surrogatepass") for t in x])) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_measured(a, b, *sig)], names=names[:7])

    both = done.where("head IS NULL AND tail IS NULL").select(*names[:7]).unionByName(last.mapInArrow(finish, f"key {kind}, {_FIELDS}"))
    text_of = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return both.withColumns(text_of).withColumnRenamed("key", key)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text", with_hash: bool = False) -> DataFrame:
    """Per row: key, class_id (the smallest key reachable over links) and n_links (links found from its text to others).

    Texts are taken once, whatever the number of their copies. Signature bands meet in a shuffle; distinct pairs of
    different texts are verified by the Jaccard similarity of their sets of shingle hashes. Within a band of many texts
    each is compared to the smallest one; those it doesn't verify go on to another round, while rounds halve them. Texts
    that still meet another class in a band are then joined exactly by their rarest shingles, so that classes are those
    of all pairs; links within a class that no round asked for are not counted. Texts without words, NULL ones too, are
    one class. A class whose keys are all NULL has a NULL class_id; repeated rows stay repeated; an empty table gives an
    empty result; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text"))
    per = PERMUTATIONS // BANDS

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch.column(1))]
            for lo, hi in _slices(raw):
                sig = signatures(raw[lo:hi]).reshape(-1, BANDS, per)
                band = np.zeros(sig.shape[:2], np.uint64)
                for k in range(per):
                    band = mixed(band ^ sig[:, :, k]) + np.uint64(k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(band.view(np.int64).tolist(), pa.list_(pa.int64()))], names=["key", "t", "bands"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch.column(1))]
            for lo, hi in groups(raw):
                s, at = shingles(raw[lo:hi])
                sets = [np.unique(s[at[i]:at[i + 1]]).view(np.int64).tolist() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64()))], names=["t", "s"])

    # Rows are hashed where they lie. Texts move only if they share a band with another one, and once each.
    hashed = staged(rows.mapInArrow(banded, f"key {kind}, t long, bands array<long>"), "bands")
    every = hashed.groupBy("t").agg(F.first("bands").alias("bands")).select("t", F.posexplode("bands").alias("no", "band"))
    shared = every.groupBy("no", "band").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("no", "band")
    every = staged(every.join(shared, ["no", "band"], "left_semi"), "met")
    needed = rows.select("t", "text").join(every.select("t").distinct(), "t", "left_semi").groupBy("t").agg(F.min("text").alias("text"))
    sets = staged(needed.mapInArrow(shingled, "t long, s array<long>"), "sets")
    met, links, seen = every, None, None
    left = None

    def judge(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(sets.select(F.col("t").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("t").alias("b"), F.col("s").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        return staged(sides.select("a", "b", (common >= threshold * (F.size("sa") + F.size("sb") - common)).alias("good")), "judged")

    while True:
        least = met.groupBy("no", "band").agg(F.min("t").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        pairs = met.join(least, ["no", "band"]).where("t <> a").select("no", "band", "a", F.col("t").alias("b"))
        asked = staged(pairs, "candidates")
        judged = judge(asked.select("a", "b").distinct())
        seen = judged if seen is None else seen.unionByName(judged)
        good = judged.where("good").select("a", "b")
        links = good if links is None else links.unionByName(good)
        met = staged(asked.join(judged.where("NOT good"), ["a", "b"]).select("no", "band", F.col("b").alias("t")), "unlinked")
        before, left = left, met.count()
        if not left or (before is not None and 2 * left > before):
            break
    links = staged(links.distinct(), "links")
    # Texts that meet another class in a band: two of them that are alike enough share one of their rarest shingles, of
    # which each shows as many as it may lack. Bands of many unlike texts give no pairs that way.
    roots = components(links).select(F.col("node").alias("t"), "root")
    classed = every.join(roots, "t", "left").withColumn("root", F.coalesce("root", "t"))
    mixed_bands = classed.groupBy("no", "band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("no", "band")
    apart = staged(classed.join(mixed_bands, ["no", "band"], "left_semi").select("t", "root").distinct(), "apart")
    tokens = staged(sets.join(apart, "t").select("t", "root", F.size("s").alias("n"), F.explode("s").alias("x")), "tokens")
    spread = tokens.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    rank = F.row_number().over(Window.partitionBy("t").orderBy("c", "x"))
    shown = tokens.join(spread.where("c > 1"), "x").withColumn("rank", rank)  # those of one text only come first and meet none
    alone = tokens.join(spread.where("c = 1"), "x").groupBy("t").agg(F.count(F.lit(1)).alias("alone"))
    lacking = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    shown = staged(shown.join(alone, "t", "left").where(F.col("rank") + F.coalesce("alone", F.lit(0)) <= lacking).select("x", "t", "n", "root"), "shown")
    sides = [shown.select("x", *[F.col(c).alias(f"{c}_{x}") for c in ("t", "n", "root")]) for x in "ab"]
    unlike = sides[0].join(sides[1], "x").where("t_a < t_b AND root_a <> root_b").where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    unseen = unlike.select(F.col("t_a").alias("a"), F.col("t_b").alias("b")).distinct().join(seen.select("a", "b"), ["a", "b"], "left_anti")
    links = staged(links.unionByName(judge(staged(unseen, "unseen")).where("good").select("a", "b")), "links")
    linked = components(links).select(F.col("node").alias("t"), "root")
    n_links = links.select(F.col("a").alias("t")).unionByName(links.select(F.col("b").alias("t"))).groupBy("t").agg(F.count(F.lit(1)).alias("n_links"))
    members = hashed.select("key", "t").join(linked, "t", "left").withColumn("root", F.coalesce("root", "t"))
    least = members.groupBy("root").agg(F.min("key").alias("class_id"))
    more = [F.col("t").alias("text_hash")] if with_hash else []
    return members.join(least, "root").join(n_links, "t", "left").select(F.col("key").alias(key), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), *more)
