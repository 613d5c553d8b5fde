import datetime

import pytest
from pyspark.sql import functions as F

from folioscope.operators import catalog, tables
from folioscope.schemas import CHUNKS, DOCUMENTS

NOW = datetime.datetime(2024, 1, 1)


def docs(spark, rows):
    df = spark.createDataFrame([(i, f"u{i}", f"f{i}", "text/plain", t, lang) for i, t, lang in rows],
                               "doc_id string, uri string, filename string, mime_type string, doc_type string, language string")
    return tables.document_rows(df.withColumn("ingest_timestamp", F.lit(NOW)))


def chunks(spark, rows):
    return tables.chunk_rows(spark.createDataFrame(rows, "chunk_id string, doc_id string, chunk_index int, chunk_text string"))


def ids(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_defaults_and_schema(spark):
    out = docs(spark, [("1", None, None)])
    assert [f.dataType for f in out.schema] == [f.dataType for f in DOCUMENTS] and out.columns == DOCUMENTS.names
    row = out.select("doc_type", "language", "char_count", F.to_json("extra_metadata").alias("m")).first()
    assert tuple(row) == ("unknown", "unknown", 0, "{}")
    assert chunks(spark, [("c", "1", 0, "x")]).columns == CHUNKS.names


def test_upsert_is_idempotent_and_last_wins(spark):
    base = docs(spark, [("1", "cv", "en"), ("2", "cv", "en")])
    new = docs(spark, [("2", "x", "en"), ("3", "y", "en")]).withColumn("n", F.lit(1)).unionByName(
        docs(spark, [("2", "z", "en")]).withColumn("n", F.lit(2)))
    once = tables.upsert_documents(base, new, "n")
    assert ids(once, "doc_id", "doc_type") == [("1", "cv"), ("2", "z"), ("3", "y")]
    assert ids(tables.upsert_documents(once, new, "n"), "doc_id", "doc_type") == ids(once, "doc_id", "doc_type")


def test_chunk_modes(spark):
    base = chunks(spark, [("a0", "a", 0, "x"), ("a1", "a", 1, "y"), ("b0", "b", 0, "z")])
    new = chunks(spark, [("a0", "a", 0, "X")])
    assert ids(tables.upsert_chunks(base, new), "chunk_id", "chunk_text") == [("a0", "X"), ("b0", "z")]
    assert ids(tables.upsert_chunks(base, new, "merge"), "chunk_id", "chunk_text") == [("a0", "X"), ("a1", "y"), ("b0", "z")]
    assert ids(tables.upsert_chunks(base, new.limit(0)), "chunk_id") == ids(base, "chunk_id")
    with pytest.raises(ValueError):
        tables.upsert_chunks(base, new, "other")


def test_cascade_and_violations(spark):
    d, c = docs(spark, [("a", "cv", "en"), ("b", "cv", "en")]), chunks(spark, [("a0", "a", 0, "x"), ("b0", "b", 0, "y")])
    left_d, left_c = tables.delete_documents(d, c, spark.createDataFrame([("a",), ("a",), ("q",)], "doc_id string"))
    assert ids(left_d, "doc_id") == [("b",)] and ids(left_c, "chunk_id") == [("b0",)]
    assert tables.violations(d, c).count() == 0
    odd = c.withColumn("embedding", F.array(F.lit(1.0).cast("float"))).unionByName(c.where("doc_id = 'a'"))
    kinds = ids(tables.violations(left_d.withColumn("uri", F.lit(None).cast("string")), odd, dim=2), "constraint", "key")
    assert kinds == [("chunks_dimension", "a0"), ("chunks_dimension", "b0"), ("chunks_document", "a0"), ("chunks_key", "a0"),
                     ("documents_not_null_uri", "b")]


def test_whole_writings(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.read_tables(spark, root)[0].count() == 0 and tables.writings(spark, root, "documents") == []
    d, c = docs(spark, [("a", "cv", "en"), ("b", "x", "pt")]), chunks(spark, [("a1", "a", 1, "x"), ("a0", "a", 0, "x"), ("b0", "b", 0, "y")])
    tables.publish(d, c, root)
    old_d, old_c = tables.read_tables(spark, root)
    tables.publish(tables.upsert_documents(old_d, docs(spark, [("b", "y", "pt")])), old_c, root)
    assert tables.writings(spark, root, "documents") == [1, 2]
    new_d, new_c = tables.read_tables(spark, root)
    assert ids(new_d, "doc_id", "doc_type") == [("a", "cv"), ("b", "y")] and new_d.columns == DOCUMENTS.names
    assert [r.chunk_id for r in catalog.chunks_of(new_c, "a").collect()] == ["a0", "a1"]
    plan = catalog.by_type_language(new_d, "cv", "en")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(doc_type" in plan.replace("\n", " ") and catalog.by_type_language(new_d, "cv").count() == 1
    assert "PushedFilters: [IsNotNull(uri), EqualTo(uri,u)]" in catalog.by_uri(new_d, "u")._jdf.queryExecution().executedPlan().toString()
    assert tables.drop_superseded(spark, root) == 2 and tables.read_tables(spark, root)[0].count() == 2
    # A writing that was cut off has no mark and is not read.
    (tmp_path / "t" / "documents" / "of=99").mkdir()
    assert tables.read_tables(spark, root)[0].count() == 2


def test_create_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS folio")
    tables.create_tables(spark, "folio")
    tables.create_tables(spark, "folio")
    assert sorted(spark.table("folio.rag_documents").columns) == sorted(DOCUMENTS.names)
    assert spark.table("folio.rag_chunks").columns == CHUNKS.names


def test_merge_statement():
    sql = tables.merge_statement("rag_chunks", "stage", "chunk_id", ["chunk_id", "chunk_text", "embedding"], {"embedding": "vector"})
    assert sql == ("INSERT INTO rag_chunks (chunk_id, chunk_text, embedding) SELECT chunk_id, chunk_text, embedding::vector FROM stage "
                   "ON CONFLICT (chunk_id) DO UPDATE SET chunk_text = EXCLUDED.chunk_text, embedding = EXCLUDED.embedding")


def test_json_filters(spark):
    rows = ['{"a": 1, "b": {"c": "x", "d": null}, "t": true}', '{"a": "1"}', '{"a": 1.0}', "[1]", '{"a": null}', None, '{"a.b": 2, "a": 1.5}',
            '{"a": 12345678901234567890}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")

    def hits(pattern):
        return [r.i for r in df.where(catalog.json_contains(F.parse_json("x"), pattern)).orderBy("i").collect()]
    assert hits({"a": 1}) == [0, 2] and hits({"a": "1"}) == [1] and hits({"a": None}) == [4] and hits({"a": 1.5}) == [6]
    assert hits({"b": {"c": "x"}}) == [0] and hits({"b": {"d": None}}) == [0] and hits({"t": True}) == [0] and hits({"t": 1}) == []
    assert hits({"a.b": 2}) == [6] and hits({}) == [0, 1, 2, 4, 6, 7] and hits({"a": 12345678901234567890}) == [7]
    assert [r.i for r in df.where(catalog.json_has_key(F.col("x"), "a")).orderBy("i").collect()] == [0, 1, 2, 4, 6, 7]


def test_skip_ingested(spark):
    raw = spark.createDataFrame([("b", b"1"), ("a", b"1"), ("c", b"2"), ("d", b"3")], "uri string, content binary")
    seen = raw.where("uri = 'c'").select(catalog.content_hash(F.col("content")).alias("content_sha256"))
    assert ids(catalog.skip_ingested(raw, seen), "uri") == [("a",), ("d",)]
    assert ids(catalog.skip_ingested(raw), "uri") == [("a",), ("c",), ("d",)]


def test_metadata_rules(spark):
    df = spark.createDataFrame([("Mail a@b.pt or c@d.com, a@b.pt. Due 2024-02-03: € 1.250,00", ), ("none",)], "text string")
    out = catalog.extract_metadata(df).select(F.to_json("extra_metadata").alias("m")).collect()
    assert [r.m for r in out] == ['{"amount":["€ 1.250,00"],"date":["2024-02-03"],"email":["a@b.pt","c@d.com"]}', "{}"]


def held(spark, root):
    return [{f.split(root)[1] for f in t.inputFiles()} for t in tables.read_tables(spark, root)]


def test_an_update_keeps_all_other_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    names = [f"d{i}" for i in range(200)]
    d, c = docs(spark, [(n, "cv", "en") for n in names]), chunks(spark, [(f"{n}:0", n, 0, "x") for n in names])
    tables.publish(d, c, root, buckets=64)
    before = held(spark, root)
    new = docs(spark, [("d7", "x", "pt")]).cache()
    tables.update(root, new, chunks(spark, [("d7:0", "d7", 0, "y")]).cache())
    assert len(before[0]) > 40
    for old, now in zip(before, held(spark, root)):
        assert len({f.split("/")[3] for f in old ^ now}) == 1
    got_d, got_c = tables.read_tables(spark, root)
    assert got_d.count() == 200 and ids(got_d.where("doc_id = 'd7'"), "doc_type") == [("x",)]
    assert got_c.count() == 200 and [r.chunk_text for r in got_c.where("chunk_id = 'd7:0'").collect()] == ["y"]


def test_folders_that_lose_all_rows_go(spark, tmp_path):
    """A document changes its type, alone in its bucket; names of folders need escaping."""
    root = str(tmp_path / "t")
    given = lambda *rows: (docs(spark, [r[:3] for r in rows]).cache(), chunks(spark, [r[3] for r in rows if r[3]]).cache())
    tables.update(root, *given(("a", "c v/1=", "en", ("a0", "a", 0, "x")), ("b", "cv", "pt", ("b0", "b", 0, "y"))), buckets=16)
    tables.update(root, *given(("a", "x", "en", None)))
    got_d, got_c = tables.read_tables(spark, root)
    assert ids(got_d, "doc_id", "doc_type") == [("a", "x"), ("b", "cv")] and ids(got_c, "chunk_id") == [("a0",), ("b0",)]
    tables.update(root, *given(("a", "x", "en", None)))  # the same once more
    assert ids(tables.read_tables(spark, root)[0], "doc_id", "doc_type") == [("a", "x"), ("b", "cv")]


def test_tables_that_grow_are_dealt_into_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 10)
    root = str(tmp_path / "t")
    batch = lambda lo, hi: (docs(spark, [(f"d{i}", "cv", "en") for i in range(lo, hi)]).cache(), chunks(spark, [(f"d{i}:0", f"d{i}", 0, "x") for i in range(lo, hi)]).cache())
    tables.update(root, *batch(0, 15))
    assert tables.writings(spark, root, "chunks") == [2]
    tables.update(root, *batch(10, 120))
    assert tables.writings(spark, root, "chunks") == [2, 12] and [t.count() for t in tables.read_tables(spark, root)] == [120, 120]
    tables.update(root, *batch(100, 130))
    assert [t.count() for t in tables.read_tables(spark, root)] == [130, 130]


def test_null_and_equal_orders(spark):
    target = spark.createDataFrame([("a", "x", 0)], "doc_id string, v string, o int")
    updates = spark.createDataFrame([("a", "y", 1), ("a", "z", None), ("b", "p", None), ("b", "q", None)], "doc_id string, v string, o int")
    out = {r.doc_id: r.v for r in tables.upsert_documents(target, updates, "o").collect()}
    assert out["a"] == "y" and out["b"] in ("p", "q")
    assert {r.doc_id: r.v for r in tables.upsert_documents(target, updates.coalesce(1).orderBy("doc_id", "v").coalesce(1)).collect()} == {"a": "z", "b": "q"}


def test_no_exchange_carries_contents(spark):
    raw = spark.createDataFrame([("b", b"1"), ("a", b"1"), ("c", b"2")], "uri string, content binary")
    plan = catalog.new_contents(raw)._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan and ids(catalog.new_contents(raw), "uri") == [("a",), ("c",)]
