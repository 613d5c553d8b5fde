"""Postings of JSON, lexical ranking, labels of trees, lookups by uri, known contents, rules by type and time windows."""

import datetime as dt
import json
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioscope.functions.metadata import document_id
from folioscope.operators import catalog, lexical, paths, postings, tables
from folioscope.streaming import monitor
from folioscope.streaming.arrival import ingest_arrivals
from folioscope.plans.ingest import Settings, ingest_files, store


# Postings -----------------------------------------------------------------------------------------

DOCUMENTS = ['{"a": 1, "b": {"c": "x", "d": null}, "t": [1, 2]}', '{"a": 1.0, "b": {"c": "x"}}', '{"a": "1", "b": {}}', '{"a": 100, "b": {"c": true}}', '{"a": 1e2, "b": []}',
             '{"a": 0, "a": -0.0}', "[1]", "7", None, "{oops", '{"": {"": ""}}', '{"a": 12345678901234567890123456789012345}', '{"a": NaN}', '{"b": {"c": false}, "z": {"z": {"z": 1}}}']
PATTERNS = ['{"a": 1}', '{"a": 1.00}', '{"a": "1"}', '{"b": {}}', '{"b": {"c": "x", "d": null}}', '{"a": 1e2}', '{"b": {"c": true}}', "{}", "[]", None, '{"a": 0}', '{"": {"": ""}}', '{"none": 1}',
            '{"a": 12345678901234567890123456789012346}', '{"z": {"z": {"z": 1, "y": 1}}}', '{"b": {"c": false}, "z": {"z": {}}}']


def holds(doc, pattern):
    if not (isinstance(doc, dict) and isinstance(pattern, dict)):
        same_kind = isinstance(doc, bool) == isinstance(pattern, bool) and (isinstance(doc, str) == isinstance(pattern, str))
        return not isinstance(pattern, dict) and not isinstance(doc, (dict, list)) and same_kind and doc == pattern
    return all(k in doc and holds(doc[k], v) for k, v in pattern.items())


def loaded(text):
    try:
        return json.loads(text or "", parse_constant=lambda x: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return None


def test_postings_find_what_contains_a_pattern(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(DOCUMENTS)), "key long, text string").repartition(3)
    asked = spark.createDataFrame(list(enumerate(PATTERNS)), "pattern_id int, pattern string")
    postings.write_postings(docs, str(tmp_path / "p"), slots=7)
    got = postings.containing(spark, str(tmp_path / "p"), asked, docs, slots=7)
    want = {(p, d) for p, a in enumerate(PATTERNS) for d, b in enumerate(DOCUMENTS) if isinstance(loaded(a), dict) and isinstance(loaded(b), dict) and holds(loaded(b), loaded(a))}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_numbers_have_one_text():
    from decimal import Decimal

    for same in (["1", "1.0", "1e0", "10e-1"], ["0", "-0", "0.00", "0e9"], ["-120", "-1.2e2"], ["1" + "0" * 400, "1e400"]):
        assert len({postings._number(Decimal(x)) for x in same}) == 1
    assert len({postings._number(Decimal(x)) for x in ("1", "-1", "10", "0.1", "0", "1.0000000000000000000000000000000000001")}) == 6


# Lexical ranking ----------------------------------------------------------------------------------

def test_lexical_ranking_and_fusion(spark):
    rnd = random.Random(5)
    words = "the of red green apple pie Über ñandú 42 x".split()
    texts = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 30)))) for i in range(80)] + [(100, None), (101, " .,"), (102, "the " * 500)]
    asked = [(i, " ".join(rnd.sample(words, 3))) for i in range(10)] + [(50, None), (51, "absent")]
    docs = spark.createDataFrame(texts, "key long, text string").repartition(4)
    queries = spark.createDataFrame(asked, "query_id int, query_text string")
    tokens = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    held = {k: Counter(tokens(t)) for k, t in texts if tokens(t)}
    df, total = Counter(w for c in held.values() for w in c), sum(sum(c.values()) for c in held.values())

    def weight(w, c):
        n, tf = sum(c.values()), c[w]
        return math.floor(1e6 * math.log1p((len(held) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n * len(held) / total)))

    want = []
    for q, t in asked:
        scores = {k: sum(weight(w, c) for w in set(tokens(t)) if w in c) for k, c in held.items() if set(tokens(t)) & set(c)}
        want += [(q, k, s, r) for r, (s, k) in enumerate(sorted(((s, k) for k, s in scores.items()), key=lambda x: (-x[0], x[1]))[:7], 1)]
    found = lexical.lexical_top_k(lexical.weigh_terms(docs), queries, 7)
    assert sorted(map(tuple, found.select("query_id", "key", "score", "rank").collect())) == sorted(want)
    other = spark.createDataFrame([(q, 100 - k, 0, r) for q, k, _, r in want], "query_id int, key long, score long, rank int")
    fused = {(r["query_id"], r["key"]): r["score"] for r in lexical.fuse([found, other], 100).collect()}
    sums = Counter()
    for q, k, _, r in want:
        sums[q, k] += 10**9 // (60 + r)
        sums[q, 100 - k] += 10**9 // (60 + r)
    assert fused == dict(sums)
    assert lexical.weigh_terms(docs.limit(0)).count() == 0


# Trees --------------------------------------------------------------------------------------------

def test_labels_and_many_subtrees(spark, monkeypatch):
    monkeypatch.setattr(paths, "BIN", 5)
    rnd = random.Random(2)
    held = {}
    for ns in ("a", "b", "c"):
        for _ in range(60 if ns != "c" else 1):
            parts = [rnd.choice(["x", "y", "x-", "é", "1"]) for _ in range(rnd.randrange(1, 5))]
            for d in range(1, len(parts) + 1):
                held[ns, "/" + "/".join(parts[:d])] = "d"
    rows = [(*k, "d" if any(o[0] == k[0] and o[1].startswith(k[1] + "/") for o in held) else "f") for k in held]
    labels = paths.label_subtrees(spark.createDataFrame(rows, "ns string, path string, node_type string").repartition(6)).collect()
    order = sorted([*held, *{(ns, "") for ns, _ in held}], key=lambda k: (k[0], k[1].split("/")))
    below = lambda top: [k for k in order if k[0] == top[0] and (k[1] == top[1] or k[1].startswith(top[1] + "/"))]
    assert {(r["ns"], r["path"]): (r["first"], r["last"]) for r in labels} == {k: (i, i + len(below(k)) - 1) for i, k in enumerate(order)}
    asked = [("a", "/"), ("a", ""), ("a", "x/y/"), ("b", "/x"), ("b", "/none"), ("none", "/"), ("c", "")]
    got = paths.list_subtrees(spark.createDataFrame(labels), spark.createDataFrame(asked, "ns string, path string"))
    tops = {(ns, "/" + p.strip("/") if p.strip("/") else "") for ns, p in asked}
    want = [(top[0], top[1], k[1], i) for top in tops if top in order for i, k in enumerate(below(top))]
    assert sorted(map(tuple, got.select("ns", "top", "path", "place").collect())) == sorted(want)


def iter_plan(df):
    """The nodes of a plan, after it ran."""
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        yield node
        todo += [node.children().apply(i) for i in range(node.children().size())]


# Stored documents ---------------------------------------------------------------------------------

def test_lookup_opens_the_buckets_of_its_uris_alone(spark, tmp_path):
    uris = [f"mem://{i}" for i in range(400)]
    docs = spark.createDataFrame([(u,) for u in uris], "uri string").withColumns({"doc_id": document_id(F.col("uri")), "filename": F.col("uri"), "mime_type": F.lit("text/plain")})
    chunks = spark.createDataFrame([], "chunk_id string, doc_id string, chunk_index int, section_heading string, chunk_text string, token_count int, embedding array<float>")
    root = str(tmp_path / "t")
    tables.publish(docs, chunks, root, buckets=32)
    asked = lambda names: spark.createDataFrame([(n,) for n in names], "uri string")
    one = tables.lookup_uris(spark, root, asked(["mem://7", "mem://7", "mem://none", None]))
    assert [r["uri"] for r in one.collect()] == ["mem://7"]
    looked = tables.lookup_uris(spark, root, asked(["mem://7"]))
    assert looked.count() == 1
    scan = next(x for x in iter_plan(looked) if "FileSourceScan" in x.getClass().getName())
    assert scan.metrics().apply("numFiles").value() == 1 and len(tables.read_tables(spark, root)[0].inputFiles()) >= 30
    many = tables.lookup_uris(spark, root, asked(uris[:150] + ["mem://none"]))
    assert sorted(r["uri"] for r in many.collect()) == sorted(uris[:150])
    assert tables.lookup_uris(spark, str(tmp_path / "nothing"), asked(["mem://7"])).count() == 0


def test_known_contents_and_repeated_batches(spark, tmp_path):
    root = str(tmp_path / "known")
    hashes = lambda *texts: spark.createDataFrame([(t,) for t in texts], "t string").select(F.sha2("t", 256).alias("content_sha256"))
    known = lambda texts, before: catalog.known_contents(spark, root, hashes(*texts), before).count()
    assert known("ab", 5) == 0
    catalog.remember_contents(hashes("a", "b"), root, 0)
    catalog.remember_contents(hashes("c"), root, 1)
    catalog.remember_contents(hashes("c"), root, 1)  # again
    assert (known("abcd", 0), known("abcd", 1), known("abcd", 2)) == (0, 2, 3)
    assert spark.read.parquet(root).count() == 3


def test_copies_that_arrive_add_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    arrive = lambda: ingest_arrivals(spark, str(folder), str(tmp_path / "t"), str(tmp_path / "c"), Settings(embedding_dim=8), buckets=2, known=str(tmp_path / "known")).awaitTermination()
    stored = lambda: sorted(r["filename"] for r in tables.read_tables(spark, str(tmp_path / "t"))[0].collect())
    (folder / "b.txt").write_text("one text\n"), (folder / "a.txt").write_text("one text\n"), (folder / "c.txt").write_text("another text\n")
    arrive()
    assert stored() == ["a.txt", "c.txt"]
    (folder / "d.txt").write_text("another text\n"), (folder / "e.txt").write_text("a third\n")
    arrive()
    assert stored() == ["a.txt", "c.txt", "e.txt"]


def test_known_files_are_ingested_once_and_lost_ones_rejected(spark, tmp_path):
    folder, known, root = tmp_path / "in", str(tmp_path / "known"), str(tmp_path / "t")
    folder.mkdir()
    (folder / "b.txt").write_text("one text"), (folder / "a.txt").write_text("one text"), (folder / "c.json").write_text("{oops"), (folder / "big.txt").write_text("x" * 999)
    rules = spark.createDataFrame([(None, "word", "(t[a-z]+)")], "doc_type string, name string, pattern string")
    settings = Settings(embedding_dim=8, rules=rules, max_bytes=500)
    go = lambda: store(ingest_files(spark, str(folder) + "/", settings, known=known), root, 2, known=known)
    held = lambda: sorted(r["filename"] for r in tables.read_tables(spark, root)[0].collect())
    lost = lambda: sorted((r["uri"].rsplit("/", 1)[1], r["stage"]) for r in tables.read_rejects(spark, root).collect())
    go()
    assert held() == ["a.txt"] and lost() == [("big.txt", "read"), ("c.json", "chunk"), ("c.json", "parse")] and catalog.next_batch(spark, known) == 1
    (folder / "d.txt").write_text("one text"), (folder / "e.txt").write_text("two texts")
    go()
    assert held() == ["a.txt", "e.txt"] and ("c.json", "parse") in lost() and catalog.next_batch(spark, known) == 2
    assert {r["j"] for r in tables.read_tables(spark, root)[0].select(F.to_json("extra_metadata").alias("j")).collect()} == {'{"word":["text"]}', '{"word":["two","texts"]}'}


# Rules by type ------------------------------------------------------------------------------------

def test_rules_by_type(spark):
    rules = spark.createDataFrame([("cv", "name", "Name: (\\w+)"), ("cv", "name", "Nome: (\\w+)"), ("contrato", "value", "([0-9]+)"), (None, "mail", "(\\S+@\\S+)")], "doc_type string, name string, pattern string")
    docs = spark.createDataFrame([(1, "cv", "Nome: Ana Name: Eva Name: Eva a@b"), (2, "contrato", "7 8 7"), (3, "x", "Name: Z"), (4, None, "c@d"), (5, "cv", None)], "doc_id int, doc_type string, text string")
    out = catalog.extract_by_type(docs, rules)
    assert out.columns == ["doc_id", "doc_type", "text", "extra_metadata"]
    got = {r["doc_id"]: json.loads(r["j"]) for r in out.select("doc_id", F.to_json("extra_metadata").alias("j")).collect()}
    assert got == {1: {"name": ["Eva", "Ana"], "mail": ["a@b"]}, 2: {"value": ["7", "8"]}, 3: {}, 4: {"mail": ["c@d"]}, 5: {}}
    assert catalog.extract_by_type(docs, rules.limit(0)).count() == 5


# Time windows -------------------------------------------------------------------------------------

def test_windows_and_late_events(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    parts = [[(at(0, 10), "ok", 1.0), (at(0, 20), "error", 3.0), (at(3, 0), "ok", None)], [(at(0, 50), "ok", 9.0), (at(2, 30), "error", 5.0), (at(9, 0), "ok", 2.0), (None, "ok", 1.0)],
             [(at(8, 59), "ok", 4.0), (at(3, 30), "error", 4.0)]]
    schema = "ts timestamp, kind string, ms double"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        windows = monitor.health_windows(stream, F.col("kind") == "error", F.col("ms"), delay="1 hour")
        monitor.watch_health(windows, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = {r["window_start"].hour: tuple(r)[1:] for r in monitor.watched_windows(spark, str(tmp_path / "out")).collect()}
    # 0:50 comes after its window ended an hour before 3:00, 3:30 after an hour before 9:00.
    assert got == {0: (2, 1, 0.5, 2.0, 3.0), 2: (1, 1, 1.0, 5.0, 5.0), 3: (1, 0, 0.0, None, None), 9: (1, 0, 0.0, 2.0, 2.0), 8: (1, 0, 0.0, 4.0, 4.0)}
    every = spark.createDataFrame([x for p in parts for x in p], schema)
    table = monitor.health_windows(every, F.col("kind") == "error", F.col("ms"))
    assert {(r["window_start"].hour, r["n"], r["n_failed"]) for r in table.collect()} == {(0, 3, 1), (2, 1, 1), (3, 2, 1), (8, 1, 0), (9, 1, 0)}
    told = {(r["window_start"].hour, r["reason"]) for r in monitor.alerts(table, 0.4, 4.5).collect()}
    assert told == {(0, "latency"), (2, "errors and latency"), (3, "errors")}


@pytest.mark.parametrize("unknown", ["", "x"])
def test_postings_of_an_empty_table(spark, tmp_path, unknown):
    docs = spark.createDataFrame([], "key long, text string")
    postings.write_postings(docs.unionByName(spark.createDataFrame([(1, unknown)], "key long, text string")), str(tmp_path / "p"))
    asked = spark.createDataFrame([(1, '{"a": 1}')], "pattern_id int, pattern string")
    assert postings.containing(spark, str(tmp_path / "p"), asked, docs).count() == 0


# Stages -------------------------------------------------------------------------------------------

def test_inner_stages_go_and_kept_ones_stay(spark):
    from folioscope import session

    with session.inner_stages(spark) as keep:
        inner = session.staged(spark.range(5), "inner")
        path = session.scratch(spark, "folder")
        inner.write.parquet(path)
        kept = keep(inner.where("id > 2"), "kept")
    assert kept.count() == 2 and session._INNER == []
    held = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p))
    assert not held(path) and not held(path.rsplit("/", 1)[0]) and path.startswith(session._stages(spark))
    with pytest.raises(ZeroDivisionError), session.inner_stages(spark):
        session.staged(spark.range(1)) and 1 / 0
    assert session._INNER == []
