"""Ranked lexical search: trees over frequency-ordered term vectors of documents, branch and bound per item.

Documents are read once: a task keeps of each text its number of terms and the counts of the terms that the items ask
for. The vectors, terms by falling document frequency, then share the paths of a trie, one per some thousand documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch, staged
from .common import texts_of

K = 10
# (item, term) pairs that travel to the tasks at once; documents and term counts of a tree; documents of a leaf.
BLOCK_PAIRS, TREE_ROWS, TREE_TERMS, LEAF_ROWS = 1 << 18, 1 << 13, 1 << 21, 32
# Letters and digits in lower case, all other ASCII signs as blanks; bytes of further signs stay.
_SIGNS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all signs beyond ASCII, A to Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_SIGNS).split()


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term) of every item, once each. Rows of one item add up; NULL is an item like any other."""
    kind = items.schema[item].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in texts_of(batch.column(1))]
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array([t for f in found for t in f], pa.binary())], names=["item", "term"])

    return items.select(F.col(item), F.col(text).cast("string")).mapInArrow(run, f"item {kind}, term binary").distinct()


def restricted(docs: DataFrame, terms: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n``, its number of terms, and ``t`` and ``tf``, the places in ``terms`` of those it holds and how often."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            n, found, counts, ends = [], [], [], [0]
            for text in texts_of(batch.column(1)):
                every = terms_of(text)
                n.append(len(every))
                for term, c in Counter(every).items():
                    i = place.get(term)
                    if i is not None:
                        found.append(i), counts.append(c)
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["key", "n", "t", "tf"])

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string")).mapInArrow(run, f"key {kind}, n long, t array<int>, tf array<int>")


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a unit of weight adds to a score; grows with tf, falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Tree:
    """Trie over term vectors whose terms are numbered by falling document frequency.

    ``starts`` are where each document's entries begin (and the end); terms rise within a document, and every document has
    one at least. A node is a range of the documents in order of their vectors, which share its path; small neighbours
    below one node are a leaf together. For each node: ``least_m``, the least m below it, and for each term that occurs below it
    the greatest tf.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray, leaf_rows: int = LEAF_ROWS):
        n = len(starts) - 1
        wide = terms.astype(">u4")
        path = [wide[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        self.order = np.array(sorted(range(n), key=path.__getitem__), np.int64)
        size = np.diff(starts)[self.order]
        self.starts = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(starts[:-1][self.order] - self.starts[:-1], size) + np.arange(self.starts[-1])
        self.terms, self.tf, self.m = terms[at], tf[at].astype(np.int64), m[self.order]
        self.impact = impact(self.tf, np.repeat(self.m, size))
        self._grow(size, leaf_rows)
        self._bound()

    def _grow(self, size: np.ndarray, leaf_rows: int) -> None:
        """Nodes (first document, end, children); children come after their parent."""
        self.nodes: list[tuple[int, int, list[int]]] = []
        todo = [(0, len(size), 0, None)]
        while todo:
            lo, hi, depth, above = todo.pop()
            me = len(self.nodes)
            self.nodes.append((lo, hi, []))
            if above is not None:
                self.nodes[above][2].append(me)
            if hi - lo <= leaf_rows:
                continue
            # All share what the first and the last share.
            first, last = (self.terms[self.starts[i]:self.starts[i + 1]] for i in (lo, hi - 1))
            both = min(len(first), len(last))
            unlike = np.flatnonzero(first[depth:both] != last[depth:both])
            depth = depth + int(unlike[0]) if len(unlike) else both
            if both == len(first) == len(last) == depth:
                continue  # equal vectors
            rows = np.arange(lo, hi)
            following = np.where(size[lo:hi] > depth, self.terms[np.minimum(self.starts[rows] + depth, len(self.terms) - 1)], -1)
            cuts = [lo, *(lo + 1 + np.flatnonzero(np.diff(following))).tolist(), hi]
            begin = lo
            for a, b in zip(cuts, cuts[1:]):
                if b - a > leaf_rows:
                    if a > begin:
                        todo.append((begin, a, depth, me))
                    todo.append((a, b, depth + 1, me))
                    begin = b
                elif b - begin > leaf_rows:
                    todo.append((begin, a, depth, me))
                    begin = a
            if hi > begin:
                todo.append((begin, hi, depth, me))

    def _bound(self) -> None:
        below: list = [None] * len(self.nodes)
        for i in range(len(self.nodes) - 1, -1, -1):
            lo, hi, children = self.nodes[i]
            if children:
                terms, tf = (np.concatenate([below[c][x] for c in children]) for x in (0, 1))
            else:
                own = slice(self.starts[lo], self.starts[hi])
                terms, tf = self.terms[own], self.tf[own]
            order = np.argsort(terms, kind="stable")
            terms = terms[order]
            begin = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
            below[i] = terms[begin], np.maximum.reduceat(tf[order], begin)
        self.least_m = np.minimum.reduceat(np.append(self.m, 0), np.array([x for lo, hi, _ in self.nodes for x in (lo, hi)]))[::2]
        node = np.repeat(np.arange(len(below)), [len(t) for t, _ in below])
        terms, tf = np.concatenate([t for t, _ in below]), np.concatenate([f for _, f in below])
        cap = impact(tf, self.least_m[node])
        order = np.argsort(terms, kind="stable")
        self.caps = node[order], cap[order], terms[order]

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The most that a document below each node can score."""
        out, (node, cap, of) = np.zeros(len(self.nodes), np.int64), self.caps
        for lo, hi, w in zip(np.searchsorted(of, terms).tolist(), np.searchsorted(of, terms, "right").tolist(), weights.tolist()):
            if hi > lo:
                out[node[lo:hi]] += w * cap[lo:hi]
        return out

    def search(self, terms: np.ndarray, weight_of: np.ndarray, best: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (as first given) and scores that may be among the k best.

        ``weight_of`` has the weight of every term, 0 for those not asked for. ``best`` holds the highest scores known,
        rising, at most k, and grows with what is found. Depth first, the most promising child first; a node is left
        out when its bound is below the k-th of them.
        """
        bound = self.bounds(terms, weight_of[terms])
        rows, scores, todo = [], [], [0]
        while todo:
            i = todo.pop()
            floor = best[0] if len(best) == k else 1
            if bound[i] < floor:
                continue
            lo, hi, children = self.nodes[i]
            if children:
                todo += sorted(children, key=bound.__getitem__)
                continue
            begin, end = self.starts[lo], self.starts[hi]
            score = np.add.reduceat(weight_of[self.terms[begin:end]] * self.impact[begin:end], self.starts[lo:hi] - begin)
            good = np.flatnonzero(score >= floor)
            if len(good):
                rows.append(good + lo), scores.append(score[good])
                best[:] = sorted([*best, *np.sort(score[good])[-k:].tolist()])[-k:]
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, score = np.concatenate(rows), np.concatenate(scores)
        good = score >= (best[0] if len(best) == k else 1)
        return self.order[rows[good]], score[good]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """keys, n and entries of as many documents as a tree holds."""
    held, rows, entries = [], 0, 0
    for batch in batches:
        sizes = np.cumsum(np.append(0, batch.column(2).value_lengths().to_numpy(zero_copy_only=False)))
        lo = 0
        while lo < batch.num_rows:
            hi = min(batch.num_rows, lo + TREE_ROWS - rows, max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + TREE_TERMS - entries, "right")) - 1))
            held.append(batch.slice(lo, hi - lo))
            rows, entries, lo = rows + hi - lo, entries + int(sizes[hi] - sizes[lo]), hi
            if rows >= TREE_ROWS or entries >= TREE_TERMS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _search(vectors: DataFrame, items: pa.Array, asked: list[np.ndarray], number: np.ndarray, weight: np.ndarray, total: tuple[int, int], k: int, types: str) -> DataFrame:
    """Candidates of every item. ``number`` is each term's place by falling document frequency, ``weight`` goes by that number."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, asked, number, weight, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, asked, number, weight, (n_docs, length) = shared.value
        best: list[list[int]] = [[] for _ in asked]
        weight_of = np.zeros(len(weight), np.int64)
        for batch in _trees(batches):
            starts = np.cumsum(np.append(0, batch.column(2).value_lengths().to_numpy(zero_copy_only=False)))
            terms, tf = number[batch.column(2).flatten().to_numpy()], batch.column(3).flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            order = np.lexsort((terms, owner))
            m = 10 + 90 * batch.column(1).to_numpy() * n_docs // length
            tree = Tree(starts, terms[order], tf[order], m)
            keys = batch.column(0)
            ties = np.empty(len(keys), np.int64)
            ties[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))  # NULL last
            hits, of, scores = [], [], []
            for i, own in enumerate(asked):
                weight_of[own] = weight[own]
                rows, score = tree.search(own, weight_of, best[i], k)
                weight_of[own] = 0
                first = np.lexsort((ties[rows], -score))[:k]
                hits.append(rows[first]), scores.append(score[first]), of.append(np.full(len(first), i))
            at = pa.array(np.concatenate(of))
            yield pa.RecordBatch.from_arrays([items.take(at), keys.take(pa.array(np.concatenate(hits))), pa.array(np.concatenate(scores))], names=["item", "key", "score"])

    return vectors.where(F.size("t") > 0).select("key", "n", "t", "tf").mapInArrow(run, types)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Per item its k best documents of score above 0: ``item``, rank from 1, ``key``, score, ties to the smaller key.

    Items travel in blocks of ``block_pairs`` terms, each one reading of the texts; their term vectors are a table of the
    shared folder, of which tasks build trees of bounded size, so that nothing but counts and candidates is shuffled.
    NULL and blank texts have no terms: such documents count nowhere and such items find nothing. Rows that repeat a
    document are documents of their own; a NULL key comes after all others of its score. Rows of one item add their
    terms; a NULL item is one. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kinds = items.schema[item].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    types = f"item {kinds[0]}, key {kinds[1]}, score long"
    pairs = staged(item_terms(items, item, item_text), "items")
    folder, blocks = scratch(spark, "ranked"), math.ceil(pairs.count() / block_pairs)
    for b in range(blocks):
        block = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        names = pc.unique(block.column("item").combine_chunks())
        terms = sorted(set(block.column("term").to_pylist()))
        place = {t: i for i, t in enumerate(terms)}
        vectors = staged(restricted(docs, terms, key, text), "vectors")
        n_docs, length = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(terms), np.int64)
        for t, c in vectors.select(F.explode("t").alias("t")).groupBy("t").count().toLocalIterator():  # a row per term of the block
            df[t] = c
        number = np.empty(len(terms), np.int64)
        order = np.lexsort((np.arange(len(terms)), -df))
        number[order] = np.arange(len(terms))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df[order]], np.int64)
        owner = pc.index_in(block.column("item").combine_chunks(), names).to_numpy()
        own = [[] for _ in range(len(names))]
        for i, t in zip(owner.tolist(), block.column("term").to_pylist()):
            own[i].append(number[place[t]])
        found = _search(vectors, names, [np.sort(np.array(x, np.int64)) for x in own], number, weight, (n_docs, length or 1), k, types)
        found.write.mode("append").parquet(folder)
    if not blocks:
        return spark.createDataFrame([], f"`{item}` {kinds[0]}, rank int, `{key}` {kinds[1]}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = spark.read.schema(types).parquet(folder).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
