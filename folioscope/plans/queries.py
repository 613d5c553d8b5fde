"""Registered queries: one per operator, over whole tables. ``oracles`` holds the SQL of each."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.metadata import DOC_TYPE_KEYWORDS, chunk_id, detect_mime, document_id, heading_of
from ..functions.strings import basename, fallback_tokens, split_lines
from ..operators import ann, catalog, chunking, codes, embedding, extract, language, lexical, paths, postings, search, tables
from ..session import many_files, scratch, staged
from ..sources.commands import parse_commands
from ..sources.files import list_documents, read_documents
from ..sources.tables import read_table
from ..streaming import monitor
from ..streaming.arrival import ingest_arrivals
from . import inputs
from .ingest import Settings, ingest, ingest_files, store
from .reports import ingest_summary, reject_summary

NARROW = ["doc_id", "doc_type", "language", "char_count"]


# Sources ------------------------------------------------------------------------------------------

def mime_detection(spark: SparkSession, sf: str) -> DataFrame:
    name = F.regexp_replace(basename(F.regexp_replace("url", "[?#].*$", "")), "^$", ".md")
    case = F.col("page_id") % 6
    given = F.when(case == 0, F.concat(name, F.lit(".PDF"))).when(case == 1, F.concat(name, F.lit(".tar.md"))).otherwise(name)
    hint = F.when(case == 2, "text/html; charset=utf-8").when(case == 3, "application/json").when(case == 4, "text/html")
    pages = read_table(spark, sf, "pages", ["page_id", "url"]).select("page_id", given.alias("filename"), hint.alias("hint"))
    return pages.select("page_id", "filename", detect_mime(F.col("filename"), F.col("hint")).alias("mime_type"))


def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    found = list_documents(spark, inputs.page_files(spark, sf) + "/page_id=")
    with many_files(spark):
        return staged(found.select(inputs.page_number(F.col("uri")).alias("page_id"), "mime_type", "length"), "listed")


def file_reading(spark: SparkSession, sf: str) -> DataFrame:
    raw, _ = read_documents(spark, inputs.page_files(spark, sf))
    text = extract.extract_text(raw)
    with many_files(spark):
        return staged(text.select(inputs.page_number(F.col("uri")).alias("page_id"), "mime_type", F.char_length("text").alias("char_count"),
                                  F.sha2("text", 256).alias("text_sha256")), "read")


def command_log(spark: SparkSession, sf: str) -> DataFrame:
    p, case = F.col("path"), F.col("page_id") % 9
    line = (F.when(case == 0, F.concat(F.lit("c "), p, F.lit(" f"))).when(case == 1, F.concat(F.lit("c  "), p, F.lit("\td ")))
            .when(case == 2, F.concat(F.lit("l "), p)).when(case == 3, F.concat(F.lit("m "), p, F.lit(" /moved"), p))
            .when(case == 4, F.concat(F.lit("# "), p)).when(case == 5, F.lit("  ")).when(case == 6, F.concat(F.lit("d "), p, F.lit(" now")))
            .when(case == 7, F.concat(F.lit("c "), p, F.lit(" x"))).otherwise(F.concat(F.lit("q "), p)))
    return parse_commands(inputs.page_paths(spark, sf).select("ns", F.col("page_id").alias("seq"), line.alias("value")))


# Text extraction ----------------------------------------------------------------------------------

def text_decoding(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    latin = (F.col("doc_id") % 2 == 1) & t.rlike("^[\\x00-\\xFF]*$")
    narrow = F.when(latin, t).otherwise("")
    content = F.when(latin, F.encode(narrow, "ISO-8859-1")).otherwise(F.encode(t, "UTF-8"))
    return inputs.documents(spark, sf).select("doc_id", markup.decode_text(content).alias("text"))


def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages", ["page_id", "html"]).select("page_id", markup.html_text(F.col("html")).alias("text"))


def json_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events", ["event_id", "props"]).select(
        "event_id", extract.json_text(F.encode("props", "UTF-8"))["text"].alias("text"))


def nested_json_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.nested_json(spark, sf).select("event_id", extract.json_text(F.encode("text", "UTF-8"))["text"].alias("text"))


def docx_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_text(inputs.docx_files(spark, sf)).select("doc_id", "text")


def mixed_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_text(inputs.mixed_raw(spark, sf)).select("uri", "mime_type", "text", "parse_error")


# Metadata -----------------------------------------------------------------------------------------

def doc_type_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = extract.infer_doc_type(inputs.typed(spark, sf), scores=True)
    return scored.select("doc_id", "doc_type", *[f"{t}_hits" for t in DOC_TYPE_KEYWORDS])


def language_detection(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.documents(spark, sf, "doc_id", "text", "lang")
    found = language.detect_language(docs, language.train_language_profiles(docs))
    return found.select("doc_id", "lang", "language")


def language_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Judged on a fifth of the documents that training doesn't see."""
    docs, held = inputs.documents(spark, sf, "doc_id", "text", "lang"), F.col("doc_id") % 5 == 0
    found = language.detect_language(docs.where(held), language.train_language_profiles(docs.where(~held)))
    return found.groupBy("lang").agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("language")).cast("int")).alias("correct"))


def _profiles(spark: SparkSession, sf: str) -> language.Profiles:
    """Learned from all documents, stored and loaded again."""
    path = scratch(spark, "profiles")
    language.train_language_profiles(inputs.documents(spark, sf, "doc_id", "text", "lang")).save(spark, path)
    return language.Profiles.load(spark, path)


def text_measures(spark: SparkSession, sf: str) -> DataFrame:
    uri = F.concat(F.lit("mem://"), F.col("doc_id").cast("string"))
    return inputs.documents(spark, sf, "doc_id", "text", "n_chars").select(
        "doc_id", F.char_length("text").alias("char_count"), "n_chars", fallback_tokens(F.col("text")).alias("token_count"),
        document_id(uri).alias("document_key"), chunk_id(F.col("doc_id"), F.lit(0)).alias("first_chunk_key"))


def parse_stage(spark: SparkSession, sf: str) -> DataFrame:
    parsed = extract.parse_documents(inputs.mixed_raw(spark, sf), _profiles(spark, sf), ingest_timestamp=inputs.STAMP)
    return parsed.select("doc_id", "uri", "filename", "mime_type", "doc_type", "language", "char_count", "ingest_timestamp", "parse_error")


def line_headings(spark: SparkSession, sf: str) -> DataFrame:
    lines = chunking.explode_lines(inputs.sectioned(spark, sf))
    return lines.select("doc_id", "pos", heading_of(F.col("line")).alias("heading")).where("heading IS NOT NULL")


# Structure and chunks -----------------------------------------------------------------------------

def lines(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.explode_lines(inputs.documents(spark, sf))


def line_counts(spark: SparkSession, sf: str) -> DataFrame:
    ends = F.translate("text", ".,", "\x0b\u2028")
    return inputs.documents(spark, sf).select("doc_id", F.size(split_lines(F.concat(ends, F.lit("\r\n")))).alias("n_lines"))


def sections(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.explode_sections(inputs.sectioned(spark, sf))


def turn_sections(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.explode_sections(inputs.turns(spark, sf))


def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.explode_paragraphs(chunking.explode_sections(inputs.sectioned(spark, sf)))


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.explode_sentences(inputs.documents(spark, sf))


def packed_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    bodies = chunking.explode_sections(inputs.sectioned(spark, sf)).drop("section_heading")
    return chunking.pack_paragraphs(bodies, max_tokens=200, overlap_tokens=40)


def resplit_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    groups = packed_paragraphs(spark, sf).drop("n_units")
    return chunking.resplit_groups(groups, max_tokens=120, overlap_tokens=30)


def packed_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.pack_sentences(inputs.documents(spark, sf))


def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_documents(inputs.documents(spark, sf))


def chunk_sectioned(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_documents(inputs.sectioned(spark, sf))


def chunk_small(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_documents(inputs.sectioned(spark, sf), 60, 20)


def chunk_pages(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_documents(html_to_text(spark, sf).withColumnRenamed("page_id", "doc_id"), 128, 32)


def documents_without_chunks(spark: SparkSession, sf: str) -> DataFrame:
    blank = F.when(F.col("doc_id") % 7 == 0, " \t\n\xa0").otherwise(F.col("text"))
    docs = inputs.documents(spark, sf).select("doc_id", blank.alias("text"))
    kept, lost = tables.with_documents_kept(docs.select("doc_id"), chunking.chunk_documents(docs).select("doc_id"))
    return kept.select("doc_id", F.lit("kept").alias("status")).unionByName(lost.select("doc_id", F.col("reason").alias("status")))


# Embedding ----------------------------------------------------------------------------------------

def _letter_counts(texts):
    return [[float(len(t)), float(t.count(" ")), float(t.count(".")), float(t.count("e"))] for t in texts]


def _fails_on_digits(texts):
    if any(ch in "0123456789" for t in texts for ch in t):
        raise ValueError("digits")
    return _letter_counts(texts)


def embedded_lines(spark: SparkSession, sf: str) -> DataFrame:
    chunks = inputs.line_chunks(spark, sf).select("chunk_id", "doc_id", "chunk_text")
    out = embedding.embed_chunks(chunks, _letter_counts, dim=4, attempts=1)
    parts = [F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(4)]
    return out.select("chunk_id", F.size("embedding").alias("dim"), *parts)


_LAST: list = [None]


def _busy_at_first(texts):
    """Fails the first time it is asked for a batch, as long as no other comes between; one hash is remembered."""
    name = hashlib.md5("\0".join(texts).encode()).digest()
    if _LAST[0] != name:
        _LAST[0] = name
        raise RuntimeError("busy")
    _LAST[0] = None
    return _letter_counts(texts)


def embedding_retries(spark: SparkSession, sf: str) -> DataFrame:
    chunks = inputs.line_chunks(spark, sf).select("chunk_id", "doc_id", "chunk_text")
    out = embedding.embed_chunks(chunks, _busy_at_first, dim=4, attempts=2, wait_min=0.0, wait_max=0.0)
    parts = [F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(4)]
    return out.select("chunk_id", F.size("embedding").alias("dim"), *parts, F.col("embed_error").isNull().alias("good"))


def embedding_rejects(spark: SparkSession, sf: str) -> DataFrame:
    chunks = inputs.line_chunks(spark, sf).select("chunk_id", "doc_id", "chunk_text")
    done = staged(embedding.embed_chunks(chunks, _fails_on_digits, dim=4, attempts=1), "embedded")
    good, rejects = embedding.settle_embeddings(done)
    kept = good.groupBy("doc_id").agg(F.count("embedding").alias("n_embedded"))
    return (kept.select("doc_id", "n_embedded", F.lit("ok").alias("reason"))
            .unionByName(rejects.select("doc_id", F.lit(0).cast("long").alias("n_embedded"), "reason")))


def hashed_embedding(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of documents, of their words backwards and of their words twice: length, and likeness to both."""
    words = F.split("text", " ")
    docs = inputs.documents(spark, sf).select("doc_id", "text", F.array_join(F.reverse(words), " ").alias("back"), F.concat_ws(" ", "text", "text").alias("twice"))
    for name in ("text", "back", "twice"):
        docs = embedding.hash_embed(docs, text=name, dim=256, output=f"v_{name}")
    dot = lambda a, b: F.round(F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x), 4)
    other = F.array_join(F.transform(words, lambda w: F.concat(w, F.lit("x"))), " ")
    docs = embedding.hash_embed(docs.withColumn("other", other), text="other", dim=256, output="v_other")
    return docs.select("doc_id", F.size("v_text").alias("dim"), dot("v_text", "v_text").alias("length"), dot("v_text", "v_back").alias("backwards"),
                       dot("v_text", "v_twice").alias("twice"), (dot("v_text", "v_other") < 1).alias("differs"))


# The place of a word, for so many words in a worker.
_PLACES: dict = {}
_PLACES_KEPT = 1 << 17


def _word_counts(texts):
    """Counts of words by the first digits of their MD5 sums."""
    out = []
    for t in texts:
        counts = [0.0] * 64
        for w in t.split(" "):
            if w:
                place = _PLACES.get(w)
                if place is None:
                    place = int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 64
                    if len(_PLACES) < _PLACES_KEPT:
                        _PLACES[w] = place
                counts[place] += 1
        out.append(counts)
    return out


def question_answering(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn of a conversation as a question; the best three chunks with what their documents say of themselves."""
    texts = chunk_documents(spark, sf).groupBy("chunk_text").agg(F.min(F.struct("chunk_id", "doc_id")).alias("c")).select("c.*", "chunk_text")
    chunks = staged(embedding.embed_chunks(texts, _word_counts, dim=64, attempts=1).select("chunk_id", "doc_id", "embedding"), "answers")
    asked = read_table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("turn"), "text")
    asked = asked.select(F.concat_ws(":", "turn.conv_id", "turn.turn").alias("query_id"), "text")
    questions = embedding.embed_chunks(asked, _word_counts, dim=64, text="text", doc_id="query_id", attempts=1)
    best = search.batch_top_k(chunks, questions.withColumnRenamed("embedding", "query_vector"), 3)
    named = best.join(chunks.select(F.col("chunk_id").alias("key"), "doc_id"), "key")
    found = named.join(inputs.documents(spark, sf, "doc_id", "source", "lang"), "doc_id")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias("chunk_id"), "doc_id", "source", "lang", F.round("similarity", 5).alias("similarity"))


# Tables -------------------------------------------------------------------------------------------

def _updates(docs: DataFrame) -> DataFrame:
    """Every document twice, in two batches; the second has the last word."""
    first = docs.withColumns({"batch_no": F.lit(1), "doc_type": F.lit("proposta")})
    second = docs.where(F.col("char_count") % 2 == 0).withColumns({"batch_no": F.lit(2), "doc_type": F.lit("relatorio")})
    return first.unionByName(second)


def upsert_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.document_table(spark, sf)
    updates = _updates(docs).where(F.col("language") != "en")
    return tables.upsert_documents(docs, updates, "batch_no").select("doc_id", "uri", "doc_type", "language", "char_count", "ingest_timestamp")


def upsert_chunks_merge(spark: SparkSession, sf: str) -> DataFrame:
    new = inputs.line_chunks(spark, sf, "new ").where("chunk_index < 3")
    return tables.upsert_chunks(inputs.line_chunks(spark, sf), new, "merge")


def upsert_chunks_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of some sources come again, cut to three lines."""
    new = inputs.line_chunks(spark, sf, "new ", "src1%").where("chunk_index < 3")
    return tables.upsert_chunks(inputs.line_chunks(spark, sf), new)


def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    toxic = read_table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("doc_id"))
    docs, chunks = tables.delete_documents(inputs.document_table(spark, sf), inputs.line_chunks(spark, sf), toxic)
    left = docs.select("doc_id").join(chunks.groupBy("doc_id").agg(F.count("*").alias("n_chunks")), "doc_id", "left")
    return left.select("doc_id", F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"))


def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.document_table(spark, sf)
    broken = (docs.where("language <> 'de'").unionByName(docs.where("language = 'es'"))
              .withColumn("filename", F.when(F.col("doc_type") != "cv", F.col("filename"))))
    size = F.when(F.col("chunk_index") == 2, F.array(F.lit(0.5).cast("float"))).otherwise(F.array(F.lit(0.5).cast("float"), F.lit(1).cast("float")))
    chunks = inputs.line_chunks(spark, sf).withColumn("embedding", size)
    return tables.violations(broken, chunks, dim=2)


def column_defaults(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.document_table(spark, sf).select("doc_id", "uri", "filename", "mime_type", "language",
                                                   F.when(F.col("doc_type") == "cv", "cv").alias("doc_type"))
    rows = tables.document_rows(docs)
    return rows.select(*NARROW, F.to_json("extra_metadata").alias("extra_metadata"), F.col("ingest_timestamp").isNotNull().alias("has_timestamp"))


def created_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of the catalog, filled with the documents and first chunks and read back by their partitions."""
    base = f"folio_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base}")
    tables.create_tables(spark, base)
    rows = {"rag_documents": tables.document_rows(inputs.document_table(spark, sf)), "rag_chunks": tables.chunk_rows(inputs.line_chunks(spark, sf).where("chunk_index = 0"))}
    for name, df in rows.items():
        df.select(*spark.table(f"{base}.{name}").columns).write.insertInto(f"{base}.{name}")
    chunks = spark.table(f"{base}.rag_chunks").select("doc_id", "chunk_id")
    return spark.table(f"{base}.rag_documents").where("doc_type IN ('cv', 'contrato')").join(chunks, "doc_id", "left").select(*NARROW, "chunk_id")


def published_tables(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "tables")
    docs, chunks = inputs.document_table(spark, sf), inputs.line_chunks(spark, sf)
    tables.publish(docs.where("doc_type = 'cv'"), chunks, root, buckets=8)
    _, old_chunks = tables.read_tables(spark, root)
    tables.update(root, staged(tables.document_rows(docs), "documents"), old_chunks.limit(0))
    docs, chunks = tables.read_tables(spark, root)
    return ingest_summary(docs, chunks)


def stored_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of an ingestion whose failed documents come once more, half of them mended."""
    root = scratch(spark, "tables")
    raw = inputs.mixed_raw(spark, sf)
    store(ingest(raw, Settings(embedding_dim=64)), root, 4)
    again = raw.where("filename % 40 = 2").withColumn("content", F.when(F.col("filename") % 80 == 2, F.lit('{"a": 1}').cast("binary")).otherwise(F.col("content")))
    store(ingest(again, Settings(embedding_dim=64)), root)
    return tables.read_rejects(spark, root)


def read_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What a listing finds and a reader refuses: pages over a limit that the caller sets."""
    raw, rejects = read_documents(spark, inputs.page_files(spark, sf), max_bytes=3000)
    kept = raw.select(inputs.page_number(F.col("uri")).alias("page_id"), F.lit("read").alias("stage"), F.lit("ok").alias("reason"))
    with many_files(spark):
        return staged(kept.unionByName(rejects.select(inputs.page_number(F.col("uri")).alias("page_id"), "stage", "reason")), "read")


def upsert_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Every document comes again without an order, and those of even length a second time with one."""
    docs = inputs.document_table(spark, sf)
    first = docs.withColumns({"batch_no": F.lit(None).cast("int"), "doc_type": F.lit("proposta")})
    second = docs.where(F.col("char_count") % 2 == 0).withColumns({"batch_no": F.lit(1), "doc_type": F.lit("relatorio")})
    return tables.upsert_documents(docs, second.unionByName(first), "batch_no").select(*NARROW)


# Retrieval ----------------------------------------------------------------------------------------

def _query_vector(spark: SparkSession, sf: str) -> list[float]:
    return spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id = 0").first()["embedding"]


def _search(spark: SparkSession, sf: str, k: int, where=None) -> DataFrame:
    docs = inputs.documents(spark, sf, "doc_id", "lang", "source", "n_chars")
    chunks = read_table(spark, sf, "embeddings").withColumn("doc_id", F.col("vec_id"))
    found = search.search(chunks, docs, _query_vector(spark, sf), k, where, key="vec_id", foreign_key=False)
    return found.select("vec_id", "lang", "source", "n_chars", F.round("similarity", 6).alias("similarity"))


def cosine_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, 5)


def cosine_top_k_referenced(spark: SparkSession, sf: str) -> DataFrame:
    """Documents made of the vectors' own rows, so that every vector has one."""
    table = read_table(spark, sf, "embeddings")
    docs = table.select(F.col("vec_id").alias("doc_id"), "label")
    found = search.search(table.select(F.col("vec_id").alias("doc_id"), "vec_id", "embedding"), docs, _query_vector(spark, sf), 5, key="vec_id")
    return found.select("vec_id", "label", F.round("similarity", 6).alias("similarity"))


def filtered_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, 10, F.col("lang") == "fr")


def _ranked(found: DataFrame) -> DataFrame:
    return found.select("query_id", F.col("key").alias("vec_id"), F.round("similarity", 6).alias("similarity"), F.col("rank").cast("int").alias("rank"))


def batch_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(search.batch_top_k(inputs.vectors(spark, sf), inputs.label_centroids(spark, sf), 10))


def batch_top_k_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(search.batch_top_k(inputs.vectors(spark, sf), inputs.label_centroids(spark, sf), 10, block_bytes=2048))


def _lists(spark: SparkSession, sf: str):
    indexed, centroids = search.build_lists(inputs.vectors(spark, sf))
    path = scratch(spark, "lists")
    search.write_lists(indexed, path)
    return spark.read.schema(indexed.schema).parquet(path), centroids


def inverted_lists_all(spark: SparkSession, sf: str) -> DataFrame:
    indexed, centroids = _lists(spark, sf)
    return _ranked(search.approximate_top_k(indexed, centroids, inputs.label_centroids(spark, sf), 10, probes=centroids.count()))


def inverted_lists_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    indexed, centroids = _lists(spark, sf)
    return _ranked(search.approximate_top_k(indexed, centroids, inputs.label_centroids(spark, sf), 10, probes=centroids.count(), block_bytes=2048))


def _index(spark: SparkSession, vectors: DataFrame, attribute: str | None = None) -> ann.Index:
    return ann.build_index(vectors, scratch(spark, "cells"), attribute)


def bounded_lists_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth vector against all, visiting lists until their bounds rule out the rest."""
    found, _ = ann.bounded_top_k(_index(spark, inputs.vectors(spark, sf)), inputs.asked_vectors(spark, sf), 10)
    return _ranked(found)


def inverted_lists_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Recall of the bounded search on the vectors as they are, per query."""
    vectors, queries = inputs.vectors(spark, sf), inputs.asked_vectors(spark, sf)
    found, _ = ann.bounded_top_k(_index(spark, vectors), queries, 10)
    return search.recall(found, search.batch_top_k(vectors, queries, 10))


def filtered_lists_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth vector asks for those of one language, which goes by its number."""
    turn = (F.col("query_id") / 20).cast("int") % 4
    wanted = F.when(turn == 0, "fr").when(turn == 1, "de").when(turn == 2, "es").otherwise("en")
    index = _index(spark, inputs.spoken_vectors(spark, sf), "lang")
    found, _ = ann.bounded_top_k(index, inputs.asked_vectors(spark, sf).withColumn("wanted", wanted), 10, "wanted")
    return _ranked(found)


def coded_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth vector against the byte codes of all, the best ranked again by their vectors."""
    vectors = inputs.vectors(spark, sf)
    books = codes.learn_codebooks(vectors)
    return _ranked(codes.coded_top_k(staged(codes.encode(vectors, books), "codes"), vectors, books, inputs.asked_vectors(spark, sf), 10))


def _stored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The document table, published and read back."""
    root = scratch(spark, "tables")
    tables.publish(inputs.document_table(spark, sf), inputs.line_chunks(spark, sf).where("chunk_index = 0"), root, buckets=4)
    return tables.read_tables(spark, root)[0]


def uri_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.by_uri(_stored_documents(spark, sf), "mem://src7/7.txt").select("uri", *NARROW)


def type_language_filter(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.by_type_language(_stored_documents(spark, sf), "contrato", "de").select(*NARROW)


def uri_batch_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every third document's uri and as many unknown ones, looked up in tables whose ids are hashes of uris."""
    root = scratch(spark, "tables")
    docs = inputs.document_table(spark, sf).withColumn("doc_id", document_id(F.col("uri")))
    tables.publish(docs, inputs.line_chunks(spark, sf).where("chunk_index = 0"), root, buckets=16)
    asked = docs.where("cast(substring_index(filename, '.', 1) AS bigint) % 3 = 0").select("uri")
    unknown = asked.select(F.concat("uri", F.lit("x")).alias("uri"))
    return tables.lookup_uris(spark, root, asked.unionByName(unknown)).select("uri", "doc_type", "language", "char_count")


def json_containment(spark: SparkSession, sf: str) -> DataFrame:
    value = F.parse_json("text")
    return inputs.nested_json(spark, sf).select(
        "event_id", catalog.json_contains(value, {"type": "click", "props": {"k": 69}}).alias("click_69"),
        catalog.json_contains(value, {"props": {"k": "69"}}).alias("text_69"), catalog.json_contains(value, {"none": {}}).alias("has_object"),
        catalog.json_has_key(F.col("text"), "props").alias("has_props"), catalog.json_has_key(F.col("text"), "k").alias("has_k"))


def containment_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Every pattern of a type and a number that occurs, and some of other shapes, against the postings of all events."""
    root = scratch(spark, "postings")
    events = inputs.nested_json(spark, sf).withColumnRenamed("event_id", "key")
    postings.write_postings(events, root)
    props = read_table(spark, sf, "events", ["event_type", "props"])
    exact = props.select(F.concat(F.lit('{"props": '), "props", F.lit(', "type": "'), "event_type", F.lit('", "none": {}}')).alias("pattern")).distinct()
    loose = props.select(F.concat(F.lit('{"type": "'), "event_type", F.lit('", "props": {}, "value": 10.0}')).alias("pattern")).distinct()
    wrong = props.select(F.concat(F.lit('{"type": "'), "event_type", F.lit('", "props": {"k": "69"}}')).alias("pattern")).distinct()
    patterns = staged(exact.unionByName(loose).unionByName(wrong).withColumn("pattern_id", F.col("pattern")), "patterns")
    found = postings.containing(spark, root, patterns, events)
    return found.select(F.col("pattern_id").alias("pattern"), F.col("key").alias("event_id"))


def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.chunks_of(inputs.line_chunks(spark, sf), "0")


def ordered_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.ordered_chunks(inputs.line_chunks(spark, sf)).select("doc_id", "chunk_index", "token_count")


def heading_filter(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.by_heading(inputs.line_chunks(spark, sf), "src1%").select("chunk_id", "section_heading")


def ingestion(spark: SparkSession, sf: str) -> DataFrame:
    settings = Settings(ingest_timestamp=inputs.STAMP, embedding_dim=64, profiles=_profiles(spark, sf))
    done = ingest(inputs.mixed_raw(spark, sf), settings)
    return ingest_summary(done.documents, done.chunks).join(done.documents.select("doc_id", "uri", "mime_type", "char_count"), "doc_id").select(
        "uri", "mime_type", "doc_type", "language", "char_count", "n_chunks", "n_tokens")


def ingestion_rejects(spark: SparkSession, sf: str) -> DataFrame:
    done = ingest(inputs.mixed_raw(spark, sf), Settings(embedding_dim=64))
    return reject_summary(done.rejects)


# Paths --------------------------------------------------------------------------------------------

def split_paths(spark: SparkSession, sf: str) -> DataFrame:
    return paths.split_path(inputs.page_paths(spark, sf)).select("page_id", "parent", "name")


def path_lookup(spark: SparkSession, sf: str) -> DataFrame:
    case = F.col("page_id") % 4
    asked = (F.when(case == 0, F.concat(F.lit("/"), "path", F.lit("//"))).when(case == 1, F.concat("path", F.lit("/x")))
             .when(case == 2, paths.parent_of(F.col("path"))).otherwise("/"))
    requests = inputs.page_paths(spark, sf).select("page_id", "ns", asked.alias("path"))
    return paths.lookup(inputs.nodes(spark, sf), requests)


def subtree_listing(spark: SparkSession, sf: str) -> DataFrame:
    return paths.list_subtree(inputs.nodes(spark, sf), "/en/7")


def subtree_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Every directory, roots included, with its pre-order place among all nodes and the nodes below it."""
    labels = paths.label_subtrees(inputs.nodes(spark, sf))
    return labels.where("node_type = 'd'").select("ns", "path", "first", (F.col("last") - F.col("first")).alias("n_below"))


def many_subtrees(spark: SparkSession, sf: str) -> DataFrame:
    """What lies at and below every directory, all in one question."""
    nodes = inputs.nodes(spark, sf)
    labels = staged(paths.label_subtrees(nodes), "labels")
    return paths.list_subtrees(labels, nodes.where("node_type = 'd'").select("ns", "path"))


def tree_listing(spark: SparkSession, sf: str) -> DataFrame:
    return paths.list_subtree(inputs.nodes(spark, sf))


def _thinned(spark: SparkSession, sf: str) -> DataFrame:
    """The tree without files called 5, 7 or 8, which leaves empty directories."""
    return inputs.nodes(spark, sf).where(~((F.col("node_type") == "f") & paths.name_of(F.col("path")).isin("5", "7", "8")))


def empty_directories(spark: SparkSession, sf: str) -> DataFrame:
    return paths.directory_emptiness(_thinned(spark, sf))


def tree_violations(spark: SparkSession, sf: str) -> DataFrame:
    whole = inputs.nodes(spark, sf)
    broken = whole.where(~F.col("path").like("/_%/5")).unionByName(whole.where("path = '/en'"))
    return paths.tree_violations(broken)


def capacity_report(spark: SparkSession, sf: str) -> DataFrame:
    return paths.capacity_report(inputs.nodes(spark, sf), max_entries=5, max_nodes=30, max_name=6)


def _create_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every page asks for its path and all above it, from the top or, on odd pages, from the bottom."""
    turn = F.when(F.col("page_id") % 2 == 0, F.col("depth")).otherwise(9 - F.col("depth"))
    return inputs.steps(spark, sf).select("ns", (F.col("page_id") * 10 + turn).alias("seq"), "path", "node_type")


def bulk_create(spark: SparkSession, sf: str) -> DataFrame:
    stored = inputs.nodes(spark, sf).where("path = '/en'")
    return paths.bulk_create(stored, _create_requests(spark, sf))[0]


def created_nodes(spark: SparkSession, sf: str) -> DataFrame:
    stored = inputs.nodes(spark, sf).where("path = '/en'")
    return paths.bulk_create(stored, _create_requests(spark, sf))[1]


def contested_create(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.page_paths(spark, sf)
    requests = pages.select("ns", F.col("page_id").alias("seq"), F.lit("/race").alias("path"), F.lit("f").alias("node_type"))
    return paths.bulk_create(inputs.nodes(spark, sf), requests)[0]


def _delete_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every page asks to delete its path and all above it; files called 5 are asked for by nobody."""
    return inputs.steps(spark, sf).where("NOT (node_type = 'f' AND path LIKE '%/5')").select(
        "ns", (F.col("page_id") * 10 + 9 - F.col("depth")).alias("seq"), "path")


def bulk_delete(spark: SparkSession, sf: str) -> DataFrame:
    return paths.bulk_delete(inputs.nodes(spark, sf), _delete_requests(spark, sf))[0]


def remaining_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return paths.bulk_delete(inputs.nodes(spark, sf), _delete_requests(spark, sf))[1]


def _move_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every page asks to move the directory two levels down on its path; some ask for what cannot be."""
    case = F.col("page_id") % 5
    source = F.substring_index("path", "/", 3)
    target = (F.when(case == 0, F.concat(source, F.lit("/below"))).when(case == 1, F.lit("/absent/x"))
              .otherwise(F.concat(F.lit("/moved-"), F.substring_index(source, "/", -1))))
    return inputs.page_paths(spark, sf).where("path <> ''").select(
        "ns", F.col("page_id").alias("seq"), source.alias("source"), target.alias("target"))


def bulk_move(spark: SparkSession, sf: str) -> DataFrame:
    return paths.bulk_move(inputs.nodes(spark, sf), _move_requests(spark, sf))[0]


def moved_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return paths.bulk_move(inputs.nodes(spark, sf), _move_requests(spark, sf))[1]


# Extensions ---------------------------------------------------------------------------------------

def skip_ingested(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.documents(spark, sf, "doc_id", "text", "source")
    raw = docs.select(F.concat(F.lit("mem://"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("uri"), F.encode("text", "UTF-8").alias("content"), "source")
    done = raw.where("source = 'src0'").select(catalog.content_hash(F.col("content")).alias("content_sha256"))
    return catalog.new_contents(raw, done)


def arrival_ingest(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch(spark, "arrivals")
    folder = inputs.page_files(spark, sf)
    settings = Settings(embedding_dim=64, profiles=_profiles(spark, sf))
    ingest_arrivals(spark, folder, f"{base}/tables", f"{base}/progress", settings, buckets=4).awaitTermination()
    documents, _ = tables.read_tables(spark, f"{base}/tables")
    return documents.select(inputs.page_number(F.col("uri")).alias("page_id"), "mime_type", "doc_type", "language", "char_count")


def arrival_of_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Pages arrive, then all of them again under other names, every tenth with an addition: what the tables then hold."""
    base = scratch(spark, "arrivals")
    folder = inputs.page_files(spark, sf)
    arrive = lambda: ingest_arrivals(spark, folder, f"{base}/tables", f"{base}/progress", Settings(embedding_dim=64), buckets=4, known=f"{base}/known").awaitTermination()
    arrive()
    again = F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("<p>again</p>"))).otherwise(F.col("html"))
    pages = read_table(spark, sf, "pages", ["page_id", "html"])
    inputs.export_texts(pages.select(F.col("page_id").alias("copy_id"), again.alias("html")), folder)
    arrive()
    documents, _ = tables.read_tables(spark, f"{base}/tables")
    copy = F.regexp_extract("uri", "copy_id=([0-9]+)", 1)
    return documents.select((copy != "").alias("is_copy"), F.when(copy != "", copy.cast("long")).otherwise(inputs.page_number(F.col("uri"))).alias("page_id"), "char_count")


def repeated_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """Pages are ingested twice from their files, once more with others added; documents carry what the rules of their type find."""
    base, folder = scratch(spark, "again"), inputs.page_files(spark, sf)
    rules = spark.createDataFrame([(None, "title", "<title>([^<]*)</title>"), ("unknown", "links", "href=\"([^\"]*)\"")], "doc_type string, name string, pattern string")
    settings = Settings(embedding_dim=64, rules=rules)
    for extra in (False, False, True):
        if extra:
            pages = read_table(spark, sf, "pages", ["page_id", "html"]).where("page_id % 3 = 0")
            inputs.export_texts(pages.select(F.col("page_id").alias("copy_id"), F.concat("html", F.lit("<!-- more -->")).alias("html")), folder)
        store(ingest_files(spark, folder, settings, known=f"{base}/known"), f"{base}/tables", 4, known=f"{base}/known")
    documents, _ = tables.read_tables(spark, f"{base}/tables")
    found = [F.array_join(F.try_variant_get("extra_metadata", f"$.{n}", "array<string>"), " ; ").alias(n) for n in ("title", "links")]
    copy = F.regexp_extract("uri", "copy_id=([0-9]+)", 1)
    return documents.select((copy != "").alias("is_copy"), F.when(copy != "", copy.cast("long")).otherwise(inputs.page_number(F.col("uri"))).alias("page_id"), "doc_type", "char_count", *found)


def health_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive in five parts of six days, every 37th a part too late, and are counted by six hours and type."""
    base = scratch(spark, "health")
    events = read_table(spark, sf, "events", ["event_id", "ts", "event_type", "value"])
    part = F.least(F.lit(4), F.expr("(dayofmonth(ts) - 1) div 6") + (F.col("event_id") % 37 == 0).cast("int"))
    for number in range(5):
        events.where(part == number).write.mode("append").parquet(f"{base}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/events")
        windows = monitor.health_windows(stream, F.col("event_type") == "error", F.col("value"), ["event_type"], width="6 hours", delay="12 hours")
        monitor.watch_health(windows, f"{base}/windows", f"{base}/progress").awaitTermination()
    kept = monitor.watched_windows(spark, f"{base}/windows", ["event_type"])
    return kept.select(F.col("window_start").cast("string").alias("window_start"), "event_type", "n", "n_failed", F.round("mean_latency", 6).alias("mean_latency"), "max_latency")


def health_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of all events with over a quarter of errors, or a latency over 250."""
    events = read_table(spark, sf, "events", ["ts", "event_type", "value"])
    windows = monitor.health_windows(events, F.col("event_type") == "error", F.col("value"))
    return monitor.alerts(windows, 0.25, 250.0, 3).select(F.col("window_start").cast("string").alias("window_start"), "n", "n_failed", "max_latency", "reason")


def fused_search(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn as a question: documents by the words they share, by the nearness of hashed counts, and both fused."""
    texts = staged(inputs.documents(spark, sf).groupBy("text").agg(F.min("doc_id").alias("key")).select("key", "text"), "texts")
    asked = staged(read_table(spark, sf, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("query_id"), F.col("text").alias("query_text")), "asked")
    words = lexical.lexical_top_k(staged(lexical.weigh_terms(texts, gathered=True), "index"), asked, 20)
    vectors = staged(embedding.embed_chunks(texts, _word_counts, dim=64, text="text", doc_id="key", attempts=1).select("key", "embedding"), "vectors")
    questions = embedding.embed_chunks(asked, _word_counts, dim=64, text="query_text", doc_id="query_id", attempts=1).select("query_id", F.col("embedding").alias("query_vector"))
    near = search.batch_top_k(vectors, questions, 20, key="key")
    found = lexical.fuse([words, near], 10)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias("doc_id"), "score")


def rerank_lexical(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty nearest vectors of every label's mean, ranked again by the words they share with the label's first text."""
    texts = inputs.documents(spark, sf)
    labelled = read_table(spark, sf, "embeddings", ["vec_id", "label"]).join(texts, F.col("vec_id") == F.col("doc_id"))
    asked = labelled.groupBy(F.col("label").alias("query_id")).agg(F.min("text").alias("query_text"))
    near = search.batch_top_k(inputs.vectors(spark, sf), inputs.label_centroids(spark, sf), 20)
    candidates = near.join(texts.withColumnRenamed("doc_id", "key"), "key").withColumnRenamed("text", "chunk_text")
    best = search.rerank_lexical(candidates.drop("rank"), asked, 5)
    return best.select("query_id", F.col("key").alias("vec_id"), "overlap", F.col("rank").cast("int").alias("rank"))


def extra_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """All matches of every rule as one text each."""
    out = catalog.extract_metadata(inputs.documents(spark, sf))
    every = [F.array_join(F.try_variant_get("extra_metadata", f"$.{n}", "array<string>"), " ; ").alias(f"all_{n}") for n in catalog.DEFAULT_RULES]
    return out.select("doc_id", *every)


_TYPE_RULES = [("contrato", "amount", r"([0-9]+(?:[.,][0-9]+)+)"), ("contrato", "word", r"([A-Z][a-z]{9,})"), ("cv", "email", r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"),
               ("cv", "word", r"([a-z]{14,})"), ("cv", "word", r"([A-Z][a-z]{9,})"), (None, "url", r"(https?://[^\s\"'<>]+)")]


def type_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """What the rules of each document's type find, one row per document, all matches of every rule as texts."""
    rules = spark.createDataFrame(_TYPE_RULES, "doc_type string, name string, pattern string")
    kinds = inputs.document_table(spark, sf).select(F.col("doc_id").cast("long").alias("doc_id"), "doc_type")
    out = catalog.extract_by_type(inputs.documents(spark, sf).join(kinds, "doc_id"), rules)
    every = [F.array_join(F.try_variant_get("extra_metadata", f"$.{n}", "array<string>"), " ; ").alias(f"all_{n}") for n in ("amount", "word", "email", "url")]
    return out.select("doc_id", "doc_type", *every)


QUERIES = {f.__name__: f for f in (
    mime_detection, file_listing, file_reading, command_log,
    text_decoding, html_to_text, json_to_text, nested_json_to_text, docx_to_text, mixed_extraction,
    doc_type_scores, language_detection, language_accuracy, text_measures, parse_stage, line_headings,
    lines, line_counts, sections, turn_sections, paragraphs, sentences, packed_paragraphs, resplit_paragraphs,
    packed_sentences, chunk_documents, chunk_sectioned, chunk_small, chunk_pages, documents_without_chunks,
    embedded_lines, embedding_retries, embedding_rejects, hashed_embedding, question_answering,
    upsert_documents, upsert_chunks_merge, upsert_chunks_replace, cascade_delete, constraint_violations,
    column_defaults, created_tables, published_tables, stored_rejects, read_rejects, upsert_ties,
    cosine_top_k, cosine_top_k_referenced, filtered_top_k, batch_top_k, batch_top_k_shuffled, inverted_lists_all, inverted_lists_shuffled,
    inverted_lists_recall, bounded_lists_top_k, filtered_lists_top_k, coded_top_k, uri_lookup, uri_batch_lookup, type_language_filter, json_containment, containment_postings, document_chunks, ordered_chunks,
    heading_filter, ingestion, ingestion_rejects,
    split_paths, path_lookup, subtree_listing, tree_listing, subtree_sizes, many_subtrees, empty_directories, tree_violations, capacity_report,
    bulk_create, created_nodes, contested_create, bulk_delete, remaining_nodes, bulk_move, moved_nodes,
    skip_ingested, arrival_ingest, arrival_of_copies, repeated_ingestion, health_windows, health_alerts, rerank_lexical, fused_search, extra_metadata, type_metadata,
)}
