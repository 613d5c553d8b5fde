import os.path

import pytest
from brute import chunks as brute_chunks
from brute import sections as brute_sections
from brute import title
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.functions import markup
from folioscope.functions.metadata import detect_mime, heading_of
from folioscope.functions.strings import (
    LINE_ENDS, WHITESPACE, extension, fallback_tokens, split_lines, split_paragraphs, split_sentences, strip,
)
from folioscope.operators import chunking
from folioscope.operators.extract import infer_doc_type


def apply(spark, values, fn, kind="string"):
    """Results of a column function for each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_character_sets():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(LINE_ENDS) == {chr(c) for c in range(0x110000) if len(f"a{chr(c)}b".splitlines()) == 2}


def test_strip_lines_paragraphs(spark):
    texts = ["", " a ", "\x1c a b 　", "a\r\nb\rc\x0bd\x1ce\x85f g", "a\n", "a\n\n", "\n", "x\n \ny"]
    assert apply(spark, texts, strip) == [t.strip() for t in texts]
    assert apply(spark, texts, split_lines) == [t.splitlines() for t in texts]
    assert apply(spark, ["a\n \nb", "a\n\n\nb\n\n \n\nc", "x"], split_paragraphs) == [["a\n \nb"], ["a", "b", "c"], ["x"]]


def test_sentences(spark):
    texts = ["Um. Dois! três? (Ok) e. g.", 'A. "B" c. Õbvio. Água.', "  ", "one"]
    assert apply(spark, texts, split_sentences) == [
        ["Um.", "Dois! três?", "(Ok) e. g."], ["A.", '"B" c. Õbvio.', "Água."], [], ["one"]]


def test_tokens(spark):
    assert apply(spark, ["", "abc", "abcdefgh", "ééééé"], fallback_tokens) == [1, 1, 2, 1]


HEADINGS = [
    "## Title", "####### x", "1.2 Scope of work", "1.2.3. Scope of work", "1 abc", "1.2 Abc", "1.2 Abcd", "RESUMO GERAL",
    "RESUMO", "CONCLUSÕES GERAIS", "", "   ", "#", "# ", "#x", " # A  B ", "1.  Título " + "x" * 73, "1.  T" + "x" * 80,
    "1.  T" + "x" * 81, "A B", "AB", "A  B", "A" * 40 + " " + "B" * 39, "A" * 41 + " " + "B" * 39, "A B", "A b", "\t2 Final part\t",
    "٣ Arabic digits", "1.a Foo bar", "1..2 Foo bar", "# ## x", "Normal line.", "A1 B2",
]


def test_headings(spark):
    assert apply(spark, HEADINGS, heading_of) == [title(h) for h in HEADINGS]
    assert title("## Title") == "Title" and title("####### x") is None and title("CONCLUSÕES GERAIS") is None


@pytest.mark.parametrize("text, expected", [
    ("# A\n# B\ntext", [("B", "text")]),
    ("# A", [(None, "# A")]),
    ("intro\n\n# A\r\nx\n\ny\nB C D\n\n1. Final part\nz", [(None, "intro"), ("A", "x\n\ny"), ("1. Final part", "z")]),
])
def test_sections(spark, text, expected):
    found = apply(spark, [text], chunking.sections)[0]
    assert [(s["heading"], s["body"]) for s in found] == expected == brute_sections(text)


def test_mime(spark):
    names = ["x.pdf", ".md", "a.HTM", "b.tar.json", "c", "..txt", "d.DOCX", "e.", "f.html5", "..a.md"]
    rules = {".pdf": "application/pdf", ".md": "text/markdown", ".htm": "text/html", ".json": "application/json", ".txt": "text/plain",
             ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document"}
    assert apply(spark, names, extension) == [os.path.splitext(n.lower())[1] for n in names]
    assert apply(spark, names, detect_mime) == [rules.get(os.path.splitext(n.lower())[1], "text/plain") for n in names]
    hints = apply(spark, ["text/html; charset=utf-8", "application/octet-stream", "text/html", None],
                  lambda h: detect_mime(F.lit("x.pdf"), h))
    assert hints == ["application/pdf", "application/pdf", "text/html", "application/pdf"]


def test_decode(spark):
    assert apply(spark, [b"A\xe9", "é﻿".encode(), b"", b"\x80"], markup.decode_text, "binary") == ["Aé", "é﻿", "", "\x80"]


@pytest.mark.parametrize("html, text", [
    ("<head><title>t</title></head><p>a <b>b</b></p>", "a\nb"),
    ("<p>a</p><p>b</p>", "a\nb"),
    ("<p>a</p>\n<p>b</p>", "a\n\nb"),
    ("a<!-- <p>no</p> -->b<script>var x='</p>';</script>c<style>q</style><noscript>n</noscript>", "a\nb\nc"),
    ("<header>h</header><meta charset=x>m", "h\nm"),
    ("x &lt;b&gt; &amp;lt; &eacute;&#233;&#xE9; &unknown; &#x1F600; &nbsp;|", "x <b> &lt; ééé &unknown; \U0001f600 \xa0|"),
    ("&#65 &#66&#x43x &#x44, &#12345678; &copy 2024 &check; &#; &", "A BCx D, &#12345678; &copy 2024 &check; &#; &"),
    ("1 < 2 <a title='x>y' href=\"p>q\">link</a> > 3", "1 < 2\nlink\n> 3"),
    ("<p>  a  </p><p>\n\n\n\n</p>b", "a\n\nb"),
    ("<!DOCTYPE html><?xml x?><br/>only", "only"),
    ("", ""),
])
def test_html(spark, html, text):
    assert apply(spark, [html], markup.html_text) == [text]


def test_html_survives_many_tags(spark):
    assert apply(spark, ["<b></b>" * 50_000 + "x" + " " * 50_000 + "\n" + "<a " + "k='v' " * 20_000 + ">y"], markup.html_text) == ["x\n\ny"]


def test_doc_type(spark):
    rows = [("contrato proposta", "", "proposta"), ("x" * 4000 + " contrato", "", "unknown"), ("nothing", "CV.txt", "cv"),
            ("proposta técnica x contrato contract", "", "proposta"), ("análise ANALYSIS contrato", "a", "relatorio"), ("", "", "unknown")]
    df = spark.createDataFrame(rows, "text string, filename string, expected string")
    bad = infer_doc_type(df).where("doc_type <> expected").collect()
    assert not bad
    other = infer_doc_type(df, {"a": ["Nothing"], "b": ["zzz"]}).select("doc_type").collect()
    assert [r[0] for r in other] == ["unknown", "unknown", "a", "unknown", "unknown", "unknown"]


# Chunks against brute force -----------------------------------------------------------------------

def chunked(spark, texts, limit, overlap, tokenizer=None):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = chunking.chunk_documents(df, limit, overlap, tokenizer=tokenizer).orderBy("doc_id", "chunk_index").collect()
    found = {i: [] for i in range(len(texts))}
    for r in out:
        found[r.doc_id].append((r.chunk_index, r.section_heading, r.chunk_text, r.token_count))
    return [found[i] for i in range(len(texts))]


EDGES = ["", " \n\t", "one", "# A\n# B", "aaaaaaa\n\nbbbbbbb", "x" * 5000, "A. " * 300, "Word one two. " * 200 + "\n\n## H\n\n" + "Z y x. W. " * 90,
         "a\n\nb\n\n" * 50, "1. Long title here\n" + "p " * 400 + "\n\nq\n\n" + "r " * 300 + ". S t u."]


@pytest.mark.parametrize("limit, overlap", [(512, 64), (60, 20), (20, 5), (5, 4), (3, 0), (1, 0)])
def test_chunks_match_brute_force(spark, limit, overlap):
    assert chunked(spark, EDGES, limit, overlap) == [brute_chunks(t, limit, overlap) for t in EDGES]


WORDS = st.lists(st.sampled_from(["Aa", "b", "cc. ", "Dd! ", "\n", "\n\n", "# H\n", "E F\n", " ", "1. Xyzzy\n", " ", "ggggggggg", "É.", "\r\n"]), max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(WORDS.map("".join), min_size=20, max_size=20), st.integers(1, 12), st.integers(0, 11))
def test_random_chunks_match_brute_force(spark, texts, limit, overlap):
    overlap = min(overlap, limit - 1)
    assert chunked(spark, texts, limit, overlap) == [brute_chunks(t, limit, overlap) for t in texts]


def test_given_documents_match_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("text").collect()
    texts = [r.text.replace("\n", "\n\n") for r in rows]
    assert chunked(spark, texts, 80, 25) == [brute_chunks(t, 80, 25) for t in texts]


def test_tokenizer_plugin(spark):
    def words(text):
        if "<|endoftext|>" in text:
            raise ValueError("special token")
        return len(text.split())

    def count(text):
        return max(1, len(text) // 4) if "<|endoftext|>" in text else len(text.split())
    texts = EDGES + ["a <|endoftext|> b. " * 40]
    assert chunked(spark, texts, 30, 10, words) == [brute_chunks(t, 30, 10, count) for t in texts]
    assert apply(spark, ["a b c", "<|endoftext|>"], lambda c: chunking.count_tokens(c, words)) == [3, 3]


def test_chunk_parameters_are_checked(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    for limit, overlap in ((10, 10), (10, -1), (10, 30)):
        with pytest.raises(ValueError):
            chunking.chunk_documents(df, limit, overlap)


def test_chunking_does_not_shuffle(spark):
    df = spark.range(10).selectExpr("id AS doc_id", "'x' AS text")
    plan = chunking.chunk_documents(df)._jdf.queryExecution().executedPlan().toString()
    # Only token counts and group numbers visit Python, once per packing.
    assert "Exchange" not in plan and plan.count("ArrowEvalPython [") == 2


def test_chunking_is_linear_in_the_document(spark):
    import time

    def seconds(n):
        text = " ".join(f"Sentence number {i} says so." for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert chunking.chunk_documents(df, 60, 20).count() > n // 12
        return time.perf_counter() - start

    seconds(1000)
    short, long = seconds(16_000), seconds(64_000)
    assert long < 8 * short + 2 and long < 20


@pytest.mark.parametrize("html, text", [
    ("<head><title>t</title><meta x><body><p>a</p>", "a"), ("<head><title>t</title><p>a", "a"), ("<p>a</p><script>var x = 1 < 2;", "a"),
    ("a<!-- open <b>b</b>", "a"), ("a<style>p {}", "a"), ("<HEAD><TITLE>t</TITLE></HEAD><P>a", "a")])
def test_unclosed_elements(spark, html, text):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(markup.html_text(F.col("html"))).first()[0] == text
