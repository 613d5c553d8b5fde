import io
import json
import zipfile

import pytest
from brute import chunks as brute_chunks
from pyspark.sql import functions as F

from folioscope.functions.metadata import DOCX
from folioscope.operators import embedding, extract, language, tables
from folioscope.plans.ingest import Settings, ingest, ingest_files, store
from folioscope.plans.reports import ingest_summary, observed, reject_summary
from folioscope.session import staged
from folioscope.sources.files import list_documents, read_documents
from folioscope.streaming.arrival import ingest_arrivals
from folioscope.streaming.monitor import IngestMonitor

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx(*paragraphs):
    out = io.BytesIO()
    body = "".join(f"<w:p>{p}</w:p>" for p in paragraphs) + "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def run(text):
    return f'<w:r><w:t xml:space="preserve">{text}</w:t></w:r>'


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.txt").write_bytes("Contrato com cláusula. Árvore.\n".encode("latin-1"))
    (root / "sub" / "b.MD").write_text("# Curriculum\nvitae and skills\n\n# End\n", encoding="utf-8")
    (root / "sub" / "c.html").write_text("<head><title>t</title></head><p>a <b>b</b></p>")
    (root / "d.json").write_text('{"b": 1, "a": {"z": true, "c": null}}')
    (root / "bad.json").write_text("{oops")
    (root / "e.docx").write_bytes(docx(run("One ") + run("two"), run("  "), f"<w:hyperlink>{run('three')}</w:hyperlink>"))
    (root / "bad.docx").write_bytes(b"no zip")
    (root / "f.pdf").write_bytes(b"%PDF-1.4")
    (root / "g.exe").write_bytes(b"MZ")
    (root / "blank.txt").write_text(" \n\t ")
    (root / "noext").write_text("x")
    return str(root)


TEXTS = {"a.txt": "Contrato com cláusula. Árvore.\n", "b.MD": "# Curriculum\nvitae and skills\n\n# End\n", "c.html": "a\nb",
         "d.json": "b: 1\na:\n  z: True\n  c: None", "bad.json": "", "e.docx": "One two\n\nthree", "bad.docx": "", "f.pdf": "", "blank.txt": " \n\t "}


def test_listing(spark, folder):
    listed = list_documents(spark, folder)
    assert {r.filename for r in listed.collect()} == set(TEXTS)
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert {r.filename for r in list_documents(spark, f"{folder}/b").collect()} == {"bad.json", "bad.docx", "blank.txt"}
    assert {r.filename for r in list_documents(spark, f"{folder}/su").collect()} == {"b.MD", "c.html"}
    with pytest.raises(ValueError):
        list_documents(spark, "relative/path")


def test_extraction(spark, folder):
    raw, rejects = read_documents(spark, folder, max_bytes=10_000)
    rows = {r.filename: r for r in extract.extract_text(raw).collect()}
    assert {k: r.text for k, r in rows.items()} == TEXTS and rejects.count() == 0
    failed = {k: r.parse_error.split(":")[0] for k, r in rows.items() if r.parse_error}
    assert failed == {"bad.json": "JSONDecodeError", "bad.docx": "BadZipFile", "f.pdf": "unsupported_format"}
    small, large = read_documents(spark, folder, max_bytes=20)
    assert small.count() + large.count() == len(TEXTS) and {r.reason for r in large.collect()} == {"too_large"}


@pytest.mark.parametrize("value, text", [
    ({"x": [{"k": 1}, 2]}, "x:\n  k: 1\n  2"), ([], ""), ({"e": {}, "l": []}, "e:\n\nl:\n"), ([[1, [2]], "s"], "1\n2\ns"),
    ({"n": 1e20, "t": True, "z": None, "s": "a\nb"}, "n: 1e+20\nt: True\nz: None\ns: a\nb"), ("plain", "plain"), ({"a": {"b": {"c": []}}}, "a:\n  b:\n    c:\n")])
def test_json_layout(spark, value, text):
    df = spark.createDataFrame([(json.dumps(value).encode(),)], "content binary")
    assert df.select(extract.json_text(F.col("content"))["text"]).first()[0] == text


def test_whole_ingestion(spark, folder, tmp_path):
    done = ingest_files(spark, folder, Settings(chunk_max_tokens=5, chunk_overlap_tokens=1, embedding_dim=16, ingest_timestamp="2024-01-01"))
    documents = {r.filename: r for r in done.documents.collect()}
    assert {k: r.doc_type for k, r in documents.items()} == {
        "a.txt": "contrato", "b.MD": "cv", "c.html": "unknown", "d.json": "unknown", "e.docx": "unknown"}
    assert all(r.char_count == len(TEXTS[k]) for k, r in documents.items())
    chunks = done.chunks.join(done.documents.select("doc_id", "filename"), "doc_id").orderBy("filename", "chunk_index").collect()
    for name in documents:
        mine = [(r.chunk_index, r.section_heading, r.chunk_text, r.token_count) for r in chunks if r.filename == name]
        assert mine == brute_chunks(TEXTS[name], 5, 1)
    assert all(len(r.embedding) == 16 for r in chunks)
    reasons = sorted((r.stage, r.reason.split(":")[0], r.n) for r in reject_summary(done.rejects).collect())
    assert reasons == [("chunk", "no_chunks", 4), ("parse", "BadZipFile", 1), ("parse", "JSONDecodeError", 1), ("parse", "unsupported_format", 1)]
    root = str(tmp_path / "tables")
    store(done, root)
    store(done, root)
    stored_docs, stored_chunks = tables.read_tables(spark, root)
    assert stored_docs.count() == 5 and stored_chunks.count() == len(chunks)
    assert tables.violations(stored_docs, stored_chunks, 16).count() == 0
    assert ingest_summary(stored_docs, stored_chunks).agg(F.sum("n_chunks")).first()[0] == len(chunks)


def test_failing_model_withdraws_its_document_only(spark, folder):
    def fails_on_vitae(texts):
        if any("vitae" in t for t in texts):
            raise RuntimeError("no")
        return [[1.0, float(len(t))] for t in texts]

    raw, _ = read_documents(spark, folder)
    cut = raw.where("filename IN ('a.txt', 'b.MD')")
    chunks = staged(cut.select(F.col("filename").alias("doc_id"), F.explode(F.split(F.lit("x|vitae|y"), "[|]")).alias("chunk_text")))
    chunks = chunks.where("doc_id = 'b.MD' OR chunk_text <> 'vitae'")
    done = staged(embedding.embed_chunks(chunks, fails_on_vitae, 2, 2, attempts=2, wait_min=0.0, wait_max=0.0))
    good, rejects = embedding.settle_embeddings(done)
    assert {(r.doc_id, r.chunk_text) for r in good.collect()} == {("a.txt", "x"), ("a.txt", "y")}
    assert [(r.doc_id, r.stage, r.reason) for r in rejects.collect()] == [("b.MD", "embed", "RuntimeError: no")]


def test_short_and_misshapen_answers(spark):
    chunks = spark.createDataFrame([("a", str(i)) for i in range(3)] + [("b", "q")], "doc_id string, chunk_text string").coalesce(1)
    out = embedding.embed_chunks(chunks, lambda ts: [[1.0, 2.0]] if len(ts) > 1 else [[1.0]], 5, 2).collect()
    assert [(r.doc_id, r.embedding, (r.embed_error or "")[:11]) for r in out] == [
        ("a", [1.0, 2.0], ""), ("a", None, ""), ("a", None, ""), ("b", None, "dimension 1")]


def test_batches_keep_documents_and_order(spark):
    chunks = spark.createDataFrame([("a", str(i)) for i in range(12)] + [("b", str(i)) for i in range(3)], "doc_id string, chunk_text string").coalesce(1)
    out = embedding.embed_chunks(chunks, lambda ts: [[float(len(ts)), float(t)] for t in ts], 5, 2).collect()
    assert [int(r.embedding[0]) for r in out] == [5] * 10 + [2, 2] + [3, 3, 3]
    assert [int(r.embedding[1]) for r in out] == list(range(12)) + [0, 1, 2]


def test_retry_waits():
    waits, calls = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 5:
            raise OSError("busy")
        return x
    assert embedding.with_retry(flaky, sleep=waits.append)(7) == 7 and waits == [2.0, 2.0, 4.0, 8.0]
    with pytest.raises(OSError):
        embedding.with_retry(lambda: (_ for _ in ()).throw(OSError()), attempts=2, sleep=waits.append)()


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = language.train_language_profiles(docs)
    probe = docs.unionByName(spark.createDataFrame([(-1, "x" * 19 + "  ", None, None, 0), (-2, None, None, None, 0)], docs.schema))
    rows = language.detect_language(probe, profiles).collect()
    assert {r.language for r in rows if r.doc_id < 0} == {"unknown"} and len(rows) == docs.count() + 2
    judged = [r.language == r.lang for r in rows if r.doc_id >= 0 and len(r.text.strip()) >= 20]
    assert sum(judged) / len(judged) > 0.95


def test_ingestion_with_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = docs.select(F.concat(F.lit("mem://"), "doc_id").alias("uri"), F.lit("x.txt").alias("filename"), F.lit("text/plain").alias("mime_type"),
                      F.encode("text", "UTF-8").alias("content"))
    done = ingest(raw, Settings(profiles=language.train_language_profiles(docs), embedding_dim=8))
    assert done.documents.groupBy("language").count().count() >= 4


def test_arrivals_are_ingested_once(spark, folder, tmp_path):
    events = []
    monitor = IngestMonitor(lambda event, values: events.append((event, values)))
    spark.streams.addListener(monitor)
    try:
        def go():
            ingest_arrivals(spark, folder, str(tmp_path / "tables"), str(tmp_path / "progress"), Settings(embedding_dim=8)).awaitTermination()
            return {r.filename for r in tables.read_tables(spark, str(tmp_path / "tables"))[0].collect()}
        first = {"a.txt", "b.MD", "c.html", "d.json", "e.docx"}
        assert go() == first
        with open(f"{folder}/sub/new.txt", "w") as f:
            f.write("A new text has arrived.")
        assert go() == first | {"new.txt"}
        files = tables.read_tables(spark, str(tmp_path / "tables"))[0].inputFiles()
        assert go() == first | {"new.txt"} and tables.read_tables(spark, str(tmp_path / "tables"))[0].inputFiles() == files
    finally:
        spark.streams.removeListener(monitor)
    assert any(e == "progress" and v["rows"] > 0 for e, v in events)


def test_hash_embedding_and_observation(spark):
    df = spark.createDataFrame([("a", "Red red apple"), ("b", "red RED; apple!"), ("c", " .")], "id string, chunk_text string")
    seen, observation = observed(embedding.hash_embed(df, dim=32), "embedded")
    rows = {r.id: r.embedding for r in seen.collect()}
    assert rows["a"] == rows["b"] and rows["c"] is None and abs(sum(x * x for x in rows["a"]) - 1) < 1e-6
    assert observation.get == {"rows": 3}


def test_unknown_type_is_text(spark):
    df = spark.createDataFrame([("u", "application/x", b"hi"), ("v", None, b"ho"), ("w", DOCX, None)], "uri string, mime_type string, content binary")
    assert {r.uri: r.text for r in extract.extract_text(df).collect()} == {"u": "hi", "v": "ho", "w": None}


def test_a_file_lost_after_listing_is_rejected(spark, folder, monkeypatch):
    import os

    from folioscope.sources import files

    def lose(df, name="stage"):
        out = staged(df, name)
        if name == "listing":
            os.remove(f"{folder}/a.txt")
        return out

    monkeypatch.setattr(files, "staged", lose)
    raw, rejects = read_documents(spark, folder)
    assert {r.filename for r in raw.collect()} == set(TEXTS) - {"a.txt"}
    assert [(r.uri.rsplit("/", 1)[-1], r.stage, r.reason) for r in rejects.collect()] == [("a.txt", "read", "unreadable")]


def test_a_prefix_without_files_is_empty(spark, folder):
    assert list_documents(spark, f"{folder}/nothing").count() == 0
    raw, rejects = read_documents(spark, f"{folder}/nothing")
    assert raw.count() == 0 and rejects.count() == 0


def test_profiles_are_stored(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    trained = language.train_language_profiles(docs)
    trained.save(spark, str(tmp_path / "p"))
    loaded = language.Profiles.load(spark, str(tmp_path / "p"))
    assert loaded.languages == trained.languages and (loaded.codes == trained.codes).all()
    assert (loaded.gains == trained.gains).all() and (loaded.unseen == trained.unseen).all()


def test_rejects_are_stored_and_leave_with_success(spark, folder, tmp_path):
    root = str(tmp_path / "tables")
    store(ingest_files(spark, folder, Settings(embedding_dim=8)), root)
    before = {r.uri.rsplit("/", 1)[-1] for r in tables.read_rejects(spark, root).collect()}
    assert {"bad.json", "bad.docx", "f.pdf", "blank.txt"} <= before
    with open(f"{folder}/bad.json", "w") as f:
        f.write('{"a": 1}')
    store(ingest_files(spark, f"{folder}/bad.j", Settings(embedding_dim=8)), root)
    assert {r.uri.rsplit("/", 1)[-1] for r in tables.read_rejects(spark, root).collect()} == before - {"bad.json"}
    assert tables.read_tables(spark, root)[0].where("filename = 'bad.json'").count() == 1
