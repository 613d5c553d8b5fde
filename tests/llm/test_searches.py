"""Lexical search, the conversation trie and vector search against plain versions, over odd rows and with small parts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioscope.llm import fptree, maxscore, turn_trie
from folioscope.llm.queries import QUERIES

from . import brute_llm as brute
from .conftest import SCHEMA, SF, odd_texts, rows_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def bag(rows):
    return Counter(map(tuple, rows))


def last(x):
    return (x is None, x)


# Ranked lexical search ----------------------------------------------------------------------------

def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    """docs: (key, text); items: (item, text)."""
    held = [(key, Counter(terms(t))) for key, t in docs]
    held = [(key, c, sum(c.values())) for key, c in held if c]
    n, length, df = len(held), sum(x[2] for x in held), Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        found = []
        for key, c, size in held:
            m = 100 - 90 + 90 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, last(key)))
        out += [(item, r, key[1], -score) for r, (score, key) in enumerate(sorted(found)[:k], 1)]
    return out


ITEMS = [(1, "Alpha1 beta2, gamma3"), (1, "delta4"), (2, None), (3, " .,"), (None, "日本5 É7 übung1"), (4, "absent"), (5, "one two WORDS loop"), (6, "alpha1 " * 50)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*x, "x", 1) for x in ITEMS], "item_id int, text string, doc_id string, score int")


def lexical(df):
    return bag((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_lexical_search_of_odd_rows(spark, odd, items, monkeypatch, small):
    if small:
        for name, value in (("TREE_ROWS", 4), ("LEAF_ROWS", 1), ("TREE_TERMS", 100)):
            monkeypatch.setattr(fptree, name, value)
    want = bag(ranked([(p[0], p[1]) for p in odd_texts()], ITEMS, 10))
    assert lexical(fptree.ranked_search(odd, items, block_pairs=3 if small else fptree.BLOCK_PAIRS)) == want


def test_lexical_search_of_documents(spark, documents):
    """Every document as an item, few leaves and many."""
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    asked = documents.select(F.col("doc_id").alias("item_id"), "text")
    assert lexical(fptree.ranked_search(documents.repartition(3), asked, 3)) == bag(ranked(rows, rows, 3))


def test_tree_bounds_hold_and_spare_work():
    import numpy as np

    rnd = np.random.default_rng(4)
    sets = [np.sort(rnd.choice(60, size=rnd.integers(1, 12), replace=False, p=np.arange(60, 0, -1) / 1830)) for _ in range(3000)]
    starts = np.cumsum([0, *map(len, sets)])
    t, tf, m = np.concatenate(sets), rnd.integers(1, 5, starts[-1]), rnd.integers(20, 300, 3000)
    tree = fptree.Tree(starts, t, tf, m)
    weight = np.zeros(60, np.int64)
    own = np.array([40, 50, 55, 59])
    weight[own] = [3000, 4000, 5000, 6000]
    score = np.add.reduceat(weight[t] * fptree.impact(tf, np.repeat(m, np.diff(starts))), starts[:-1])
    bound = tree.bounds(own, weight[own])
    for (lo, hi, children), b, least in zip(tree.nodes, bound, tree.least_m):
        below = tree.order[lo:hi]
        assert score[below].max() <= b and m[below].min() == least and sum(tree.nodes[c][1] - tree.nodes[c][0] for c in children) in (0, hi - lo)
    best = []
    rows, got = tree.search(own, weight, best, 5)
    assert sorted(got)[-5:] == sorted(score)[-5:] == best and (score[rows] == got).all()
    assert sum(bound >= best[0]) < 2 * len(bound) / 3


# Conversations ------------------------------------------------------------------------------------

def trie(turns, said=lambda r, t: (r or "", t or "")):
    """turns: (conv, turn, role, text)."""
    own = {}
    for c, n, r, t in turns:
        if c is not None:
            own.setdefault(c, []).append(((n is not None, n), hashlib.md5(f"{len(r or '')}:{r or ''}{t or ''}".encode()).digest(), said(r, t)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:])
    node = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            node.setdefault(v[:d], []).append(c)
    children = Counter(p[:-1] for p in node if p)
    leaves, saved = Counter(), Counter()
    for p, members in node.items():
        words = len(brute.words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * words
    return [(min(m), len(p), min(node[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == p))).encode()).hexdigest()) for p, m in node.items()]


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def odd_turns():
    rnd = random.Random(9)
    rows = []
    for c in [*range(60), 100, 119, 120, 777, 10**12, -7, None]:
        n = rnd.choice([1, 1, 2, 3, 5, 9, 40]) if c != 777 else 90
        rows += [(c, t, rnd.choice(["user", "bot", None]), rnd.choice(["a", "b b", "", None, "ü ü\tü"])) for t in range(n)]
    for c in range(200, 260):  # copies of one conversation, and some that go on after it
        rows += [(c, t, "user", f"same {t}") for t in range(6)] + ([(c, 9, "bot", str(c % 7))] if c % 3 == 0 else [])
    rows += [(5, None, "user", "first"), (5, None, "user", "first"), (6, 0, "x", "tie"), (6, 0, "y", "tie"), (8, 1, "us", "er"), (8, 1, "user", "")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [turn_trie.LIMIT, 100, 8, 1])
def test_trie_of_odd_turns(spark, limit, monkeypatch):
    monkeypatch.setattr(turn_trie, "IDS_IN_TEXT", 4), monkeypatch.setattr(turn_trie, "SLICE", 7)
    rows = odd_turns()
    table = spark.createDataFrame([(*r, "x", b"x") for r in rows], "conv_id long, turn int, role string, text string, box string, id binary").repartition(7)
    got = turn_trie.prefix_trie(table, limit=limit).select(*NODE).collect()
    assert bag(got) == bag(trie(rows))


def test_trie_of_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = bag(trie([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))
    assert bag(turn_trie.prefix_trie(table, limit=50).select(*NODE).collect()) == want


# Vectors ------------------------------------------------------------------------------------------

def nearest(rows, every, k, scale=64):
    """rows: (key, vector)."""
    held = [(i, key, [math.floor(scale * x) for x in v]) for i, (key, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, key, q in held:
        if key is not None and key % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), last(other)) for j, other, v in held if i != j)[:k]
            out += [(key, r, other[1], -s) for r, (s, other) in enumerate(found, 1)]
    return out


def odd_vectors():
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(12)]) for i in range(150)]
    rows += [(i, list(rows[7][1])) for i in range(150, 200)]  # a common vector: ties
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")]), (203, [float("inf"), 1.0]), (205, []), (210, [0.0] * 12), (None, rows[3][1]), (20, rows[3][1]), (220, [0.5, -0.5]),
             (225, [0.0] * 11 + [-1e-9]), (230, [1000.0] * 12), (-40, [-0.2] * 12)]
    rows += [(i, [0.0] * 11 + [rnd.choice([0.0, 0.7])]) for i in range(300, 340)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("k", [1, 20, 400])
def test_vector_search_of_odd_rows(spark, monkeypatch, small, k):
    if small:
        monkeypatch.setattr(maxscore, "SHARD_ROWS", 16), monkeypatch.setattr(maxscore, "SEED_ROWS", 30)
    rows = odd_vectors()
    table = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "vec_id int, embedding array<double>, key string, score double").repartition(4)
    got = maxscore.exact_top_k(table, F.col("vec_id") % 5 == 0, k, block_bytes=500 if small else maxscore.BLOCK_BYTES)
    assert bag((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == bag(nearest(rows, 5, k))


def test_lists_that_are_not_essential_are_probed_for_few_rows():
    import numpy as np

    rng = np.random.default_rng(1)
    matrix = np.floor(64 * rng.normal(0, 0.125, (5000, 64))).astype(np.int64)
    matrix[:, :20] *= rng.random((5000, 20)) < 0.1  # short lists
    shard, q = maxscore.Shard(matrix), matrix[17]
    score = matrix @ q
    floor = int(np.sort(score)[-20])
    found, got = shard.search(q, floor)
    assert (got == score[found]).all() and sorted(found) == sorted(np.flatnonzero(score >= floor))
    assert sum(x[0] is not None for x in shard.lists) == 20


def test_components_beyond_the_range_are_held(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0])]
    got = maxscore.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, maxscore.MOST**2), (2, -maxscore.MOST**2)]


# All ----------------------------------------------------------------------------------------------

def test_empty_tables(spark, none, items):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for found in (fptree.ranked_search(none, items), fptree.ranked_search(none, items.limit(0)), turn_trie.prefix_trie(turns), maxscore.exact_top_k(vectors, F.lit(True))):
        assert found.collect() == []


def test_queries_answer_every_item_and_vector(spark):
    n_items = spark.read.parquet(f"{SF}/benchmark.parquet").count()
    asked = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 20 = 0").count()
    assert QUERIES["op11_lexical_search"](spark, SF).select("item_id").distinct().count() == n_items
    assert QUERIES["op13_vector_top_k"](spark, SF).count() == 20 * asked


def test_long_text(spark):
    rows = [(1, "word " * 300000 + "needle"), (2, "needle")]
    found = fptree.ranked_search(spark.createDataFrame(rows_of(rows), SCHEMA), spark.createDataFrame([(1, "needle")], "item_id int, text string"))
    assert lexical(found) == bag(ranked(rows, [(1, "needle")], 10))
