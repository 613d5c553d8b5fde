"""What keeps searches, listings and the ingestion in bounds, on small inputs."""

import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioscope.functions.metadata import DOC_TYPE_KEYWORDS, type_scores
from folioscope.functions.strings import LINE_ENDS, UPPER, WHITESPACE, split_paragraphs, split_sentences, strip, unix_lines
from folioscope.operators import extract, language, lexical, search
from folioscope.plans import inputs
from folioscope.sources import files
from folioscope.sources.files import list_documents, listing, read_contents
from folioscope.streaming import arrival


def test_f1_f9_a_task_brings_k_rows_per_query():
    rng = np.random.default_rng(3)
    q, v = rng.normal(size=(30, 8)), rng.normal(size=(500, 8))
    v[100:110] = v[7]
    best = search.Best(3, np.full(30, -np.inf))
    best.WAITING = 50
    for lo in range(0, 500, 60):
        search.offer_products(best, np.arange(30), q, v[lo:lo + 60], pa.array(range(lo, min(500, lo + 60))))
    rows = [r for b in best.batches(pa.array(range(30))) for r in b.to_pylist()]
    assert len(rows) == 90
    scores = np.round(q @ v.T, search.DIGITS)
    for i in range(30):
        assert [r["key"] for r in rows if r["query_id"] == i] == sorted(range(500), key=lambda j: (-scores[i, j], j))[:3]


def test_f4_postings_of_questions_are_never_joined(spark):
    texts = spark.createDataFrame([(i, "common " * (i % 3 + 1) + f"word{i % 7}") for i in range(60)], "key long, text string")
    asked = spark.createDataFrame([(str(i), f"common word{i % 7}") for i in range(20)] + [("none", "absent"), ("3", "common")], "query_id string, query_text string")
    index = lexical.weigh_terms(texts).localCheckpoint()
    found = lexical.lexical_top_k(index, asked, 5, block_terms=8)
    assert "Join" not in found._jdf.queryExecution().toString()
    each = asked.selectExpr("query_id", "explode(array_distinct(split(query_text, ' '))) AS term")
    scored = each.join(index, "term").groupBy("query_id", "key").sum("weight").collect()
    brute: dict = {}
    for query, key, score in scored:
        brute.setdefault(query, []).append((-score, key))
    got = {(r["query_id"], r["rank"]): (-r["score"], r["key"]) for r in found.collect()}
    assert got == {(query, n + 1): x for query, rows in brute.items() for n, x in enumerate(sorted(rows)[:5])}


def test_f6_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(150)] + [(3, None), (None, "x")], "page_id long, html string").coalesce(1)
    inputs.export_texts(rows, str(tmp_path))
    spark.sparkContext.setJobGroup("listing", "listing")
    found = list_documents(spark, f"{tmp_path}/page_id=")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism + 1
    got = {r["uri"].split("page_id=")[1].split("/")[0]: r["length"] for r in found.collect()}
    assert len(got) == 151 and got["10"] == len("text 10\n") and got["3"] == len("text 3\n\n") and got["__HIVE_DEFAULT_PARTITION__"] == 2


def test_f11_trigrams_are_counted_before_they_become_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "COUNTED_ROWS", 3)
    texts = ["abcabcabc", "ABCab", "", "ab", None, "a\U0001f600b\U0001f600bc", "\u0130\u0130x", "x" * 600 + "never", "only here"]
    rows = [(t, x) for t in texts for x in ("en", "de", None)] + [("only here", "pt"), ("", "xx"), (None, "yy")]
    counts = language.count_trigrams(spark.createDataFrame(rows, "text string, lang string"))
    assert "Generate" not in counts._jdf.queryExecution().toString()
    expected = Counter()
    for text, lang in rows:
        low = (text or "")[:500].lower()
        expected.update((lang, low[i:i + 3]) for i in range(len(low) - 2) if lang)
    gram = lambda c: "".join(chr(c >> shift & (1 << 21) - 1) for shift in (42, 21, 0))
    assert {(r["lang"], gram(r["code"])): r["n"] for r in counts.collect()} == dict(expected)


def test_f11_keywords_are_counted_without_replacing_them(spark):
    texts = ["cvcvcv curriculum vitae", "contract contracts contra", None, "", "solução proposta análise", "x" * 5000]
    scored = spark.createDataFrame([(t,) for t in texts], "text string").select("text", type_scores(F.col("text")).alias("s"))
    assert "replace(" not in scored._jdf.queryExecution().toString()
    for r in scored.collect():
        assert r["s"].asDict() == {k: None if r["text"] is None else sum(r["text"].count(w) for w in words) for k, words in DOC_TYPE_KEYWORDS.items()}


def test_f11_cheaper_text_rules_cut_as_before(spark):
    rng = random.Random(11)
    parts = [*WHITESPACE, *"a.!?A(\"'~!\x7f", "Ç", "é", "ж", "\U0001f600", "\r\n", "\n\n", ". ", "! B"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)] + [*WHITESPACE, "a" * 3000 + "\u3000", "\u2003" + "é" * 3000]
    rules = {"strip": strip, "lines": unix_lines, "paragraphs": split_paragraphs, "sentences": split_sentences}
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    found = df.select("text", *[rule(F.col("text")).alias(name) for name, rule in rules.items()]).collect()
    blank, ends = f"[{re.escape(WHITESPACE)}]", "".join(c for c in LINE_ENDS if c != "\n")
    for r in found:
        t = r["text"]
        if t is None:
            assert r["strip"] is r["lines"] is r["sentences"] is None
            continue
        clean = lambda x: x.strip(WHITESPACE)
        assert r["strip"] == clean(t) and r["lines"] == re.sub(f"\r\n|[{ends}]", "\n", t)
        assert r["paragraphs"] == ([p for p in map(clean, re.split("\n{2,}", t)) if p] or [t])
        assert r["sentences"] == [p for p in map(clean, re.split(f"(?<=[.!?]){blank}+(?=[{UPPER}\"'(])", t)) if p]


def test_r04_f1_frequent_and_rare_terms_are_weighed_alike(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SPREAD_PART", 4)
    monkeypatch.setattr(lexical, "ROW_TERMS", 7)
    rnd = random.Random(4)
    rows = [(i // 2 if i < 6 else i, " ".join(rnd.choices([f"w{j}" for j in range(12)] + ["Common"] * 12, k=rnd.randrange(9)))) for i in range(40)] + [(90, None), (91, ""), (None, "w1 w1")]
    found = lexical.weigh_terms(spark.createDataFrame(rows, "key long, text string"), gathered=True)
    got = {(r["key"], t): w for r in found.collect() for t, w in zip(r["terms"], r["weights"], strict=True)}
    counts = Counter((key, w) for key, text in rows for w in (text or "").lower().split())
    n, df = Counter(), Counter(w for _, w in counts)
    for (key, _), tf in counts.items():
        n[key] += tf
    mean = sum(n.values()) / len(n)
    weight = lambda key, w, tf: 1e6 * np.log1p((len(n) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n[key] / mean))
    assert got.keys() == {(key, w) for key, w in counts if key is not None}
    assert all(abs(got[key, w] + 0.5 - weight(key, w, tf)) < 0.6 for (key, w), tf in counts.items() if key is not None)
    flat = lexical.weigh_terms(spark.createDataFrame(rows, "key long, text string"))
    assert {(r["key"], r["term"]): r["weight"] for r in flat.collect()} == got


def test_r04_f1_tiles_multiply_what_is_common_and_add_the_rest(monkeypatch):
    monkeypatch.setattr(lexical, "SUMS", 5)
    rng = np.random.default_rng(4)
    asks, rows = (rng.random((n, 30)) < p for n, p in ((25, 0.3), (40, 0.4)))
    asks[:, :5], asks[3] = rng.random((25, 5)) < 0.05, False
    times, weights = rng.integers(1, 3, asks.shape), rng.integers(0, 50, rows.shape).astype(float)
    weights[:, 7] = 0
    table = lambda held, value: lexical._by_term(np.nonzero(held)[1], np.nonzero(held)[0], value[held])
    counted = np.where(weights == 0, lexical.NOTHING, weights)
    want, matched = (rows * weights) @ (asks * times).T, rows.astype(int) @ asks.T.astype(int)
    for part in (0.0, 0.1, 1.0):
        monkeypatch.setattr(lexical, "COMMON_PART", part)
        queries, scores = lexical.tile_scores(table(asks, times.astype(float)), 25, table(rows, counted), 40, np.full(25, -np.inf))
        assert queries.tolist() == [i for i in range(25) if i != 3]
        assert (np.floor(scores) == want[:, queries]).all() and ((scores > 0) == (matched[:, queries] > 0)).all()
        queries, scores = lexical.tile_scores(table(asks, times.astype(float)), 25, table(rows, counted), 40, np.where(np.arange(25) % 2 == 0, 1e9, 0))
        assert queries.tolist() == [i for i in range(25) if i % 2 and i != 3] and (np.floor(scores) == want[:, queries]).all()


def test_r04_f2_pairs_below_the_floor_are_ruled_out_in_single_precision(monkeypatch):
    rng = np.random.default_rng(2)
    q, v = rng.random((50, 16)), rng.random((3000, 16))
    q, v = (x / np.linalg.norm(x, axis=1)[:, None] for x in (q, v))
    v[500:520], v[900] = v[3], np.nan
    worked, offer = [], search.Best.offer_pairs
    monkeypatch.setattr(search.Best, "offer_pairs", lambda self, which, known, keys: (worked.append(len(known)), offer(self, which, known, keys)))
    best = search.Best(5, np.full(50, -np.inf))
    best.WAITING = 200
    for lo in range(0, 3000, 1000):
        search.offer_products(best, np.arange(50), q, v[lo:lo + 1000], pa.array(range(lo, lo + 1000)))
    assert sum(worked) < 50 * 3000 / 20
    rows = [r for b in best.batches(pa.array(range(50))) for r in b.to_pylist()]
    scores = np.round(np.nan_to_num(q @ v.T, nan=-1), search.DIGITS)
    for i in range(50):
        assert [r["key"] for r in rows if r["query_id"] == i] == sorted(range(3000), key=lambda j: (-scores[i, j], j))[:5]


def test_r04_f3_local_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_FILES", 2)
    monkeypatch.setattr(files, "BATCH_BYTES", 10)
    texts = {"a.txt": "a" * 30, "b c%20.TXT": "b", "k=1/part.html": "k", "k=1/_k=2/x.md": "x", "deep/er/still/y.json": "{}", "é.txt": "é", "one.txt": "1"}
    others = ["k=1/_SUCCESS", ".hidden.txt", "_tmp/z.txt", "deep/.z/z.txt", "deep/z.exe", "noext", "w.txt._COPYING_"]
    for name, text in [*texts.items(), *[(n, "no") for n in others]]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "empty.txt").touch()
    top = f"file:{tmp_path}/"
    found = list_documents(spark, f"{tmp_path}/")
    # Before, the driver knew every file.
    assert not found.inputFiles() and "binaryFile" not in found._jdf.queryExecution().toString().replace(str(tmp_path), "")
    spark_s = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files.SUPPORTED_GLOB).load(str(tmp_path))
    assert {r["uri"] for r in found.collect()} == {top + n for n in texts} == {r["path"] for r in spark_s.select("path").collect()}
    assert {(r["uri"], r["length"], r["modified"]) for r in found.collect()} == {(r["path"], r["length"], r["modificationTime"]) for r in spark_s.collect()}
    assert {r["uri"] for r in list_documents(spark, f"file://{tmp_path}/k").collect()} == {top + n for n in texts if n.startswith("k")}
    assert {r["uri"] for r in list_documents(spark, f"{tmp_path}/_t").collect()} == {top + "_tmp/z.txt"}
    listed = listing(spark, f"{tmp_path}/")
    os.remove(tmp_path / "one.txt")
    read = read_contents(spark, f"{tmp_path}/", listed=listed).collect()
    assert {r["uri"]: bytes(r["content"]) for r in read} == {top + n: t.encode() for n, t in texts.items() if n != "one.txt"}
    assert {r["uri"] for r in read_contents(spark, f"{tmp_path}/", max_bytes=1, partitions=3).collect()} == {top + n for n, t in texts.items() if len(t.encode()) <= 1 and n != "one.txt"}


def test_r04_f4_f5_a_stream_names_lists_of_arrivals_not_files(spark, tmp_path, monkeypatch):
    batches: list = []
    monkeypatch.setattr(arrival, "ingest_listed", lambda _s, _p, listed, *_: batches.append(sorted(r["uri"].rsplit("/", 1)[-1] for r in listed.collect())))
    monkeypatch.setattr(arrival, "store", lambda *_: None)

    def go(max_files=None):
        batches.clear()
        arrival.ingest_arrivals(spark, str(tmp_path / "in"), "unused", str(tmp_path / "progress"), max_files=max_files).awaitTermination()
        return sorted(batches)

    (tmp_path / "in/sub").mkdir(parents=True)
    assert go() == []
    for i in range(40):
        (tmp_path / f"in/{'sub/' * (i % 2)}{i:02d}.txt").write_text("x")
        os.utime(tmp_path / f"in/{'sub/' * (i % 2)}{i:02d}.txt", (1e9 - i, 1e9 - i))
    found = go(15)
    assert [len(b) for b in sorted(found, reverse=True)] == [15, 15, 10] and found[-1] == [f"{i:02d}.txt" for i in range(25, 40)]
    assert go(15) == go() == []
    for i in range(40, 60):
        (tmp_path / f"in/{i}.txt").write_text("x")
    assert go() == [[f"{i}.txt" for i in range(40, 60)]]
    known = [f for f in (tmp_path / "progress/sources/0").iterdir() if not f.name.startswith(".")]
    # Before, it had a line for each of the sixty.
    assert sum(len(f.read_text().splitlines()) - 1 for f in known) == 4


def test_r04_pages_pack_after_others_were_parsed(spark, sf_dir):
    # Before, the parser was part of the packer, and could not travel once it had been used.
    inputs.mixed_raw(spark, sf_dir).select(extract.json_text(F.col("content"))["text"]).limit(1).collect()
    assert inputs.docx_files(spark, sf_dir).where("content IS NOT NULL").limit(3).count() == 3
