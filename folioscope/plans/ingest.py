"""The whole ingestion: files to tagged documents, embedded chunks and reject rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metadata import DOC_TYPE_KEYWORDS
from ..operators import chunking, tables
from ..operators.catalog import content_hash, extract_by_type, known_contents, next_batch, remember_contents
from ..operators.embedding import BATCH_SIZE, DIM, EmbedFn, embed_chunks, hash_embed, settle_embeddings
from ..operators.extract import parse_documents, parse_rejects
from ..operators.language import Profiles
from ..session import many_files, staged
from ..sources.files import listing, read_contents, too_large, unreadable


@dataclass(frozen=True)
class Settings:
    """Parameters of an ingestion with their defaults. Without ``embed_fn`` the offline embedder is used; with ``rules``
    (doc_type, name, pattern) documents carry what the rules of their type find in them."""
    embed_fn: EmbedFn | None = None
    embedding_dim: int = DIM
    embedding_batch_size: int = BATCH_SIZE
    chunk_max_tokens: int = chunking.MAX_TOKENS
    chunk_overlap_tokens: int = chunking.OVERLAP_TOKENS
    tokenizer: Callable[[str], int] | None = None
    profiles: Profiles | None = None
    keywords: dict = field(default_factory=lambda: dict(DOC_TYPE_KEYWORDS))
    ingest_timestamp: str | None = None
    max_bytes: int | None = None
    rules: DataFrame | None = None


@dataclass(frozen=True)
class Ingested:
    """The rows of the tables, and with a folder of known hashes those of the contents that are new."""
    documents: DataFrame
    chunks: DataFrame
    rejects: DataFrame
    hashes: DataFrame | None = None


def ingest(raw: DataFrame, settings: Settings = Settings(), rejects: DataFrame | None = None, listed: DataFrame | None = None) -> Ingested:
    """Raw documents to the two tables and the rejects. With ``listed`` (uri, length) files that gave no row are rejected.

    Text is extracted once and chunks are embedded once, each written before its several readers.
    Chunks come straight from the parsed rows; only keys and a few numbers are ever shuffled.
    """
    s = settings
    parsed = parse_documents(raw, s.profiles, s.keywords, s.ingest_timestamp)
    parsed = staged(parsed if s.rules is None else extract_by_type(parsed, s.rules), "parsed")
    cut = chunking.chunk_documents(parsed, s.chunk_max_tokens, s.chunk_overlap_tokens, tokenizer=s.tokenizer)
    if s.embed_fn is None:
        embedded = hash_embed(cut, dim=s.embedding_dim).withColumn("embed_error", F.lit(None).cast("string"))
    else:
        embedded = embed_chunks(cut, s.embed_fn, s.embedding_batch_size, s.embedding_dim)
    embedded = staged(embedded, "embedded")
    chunks, embed_rejects = settle_embeddings(embedded)

    meta = parsed.drop("text")
    produced, no_chunks = tables.with_documents_kept(meta, embedded)
    documents = produced.join(embed_rejects.select("doc_id"), "doc_id", "left_anti")

    uris = meta.select("doc_id", "uri")
    late = no_chunks.unionByName(embed_rejects).join(uris, "doc_id").select("uri", "stage", "reason")
    lost = parse_rejects(parsed).unionByName(late)
    if rejects is not None:
        lost = lost.unionByName(rejects)
    if listed is not None:
        lost = lost.unionByName(unreadable(listed, parsed, s.max_bytes))
    return Ingested(tables.document_rows(documents.drop("parse_error")), tables.chunk_rows(chunks), lost)


def ingest_files(spark: SparkSession, prefix: str, settings: Settings = Settings(), known: str | None = None) -> Ingested:
    """All supported files below a prefix. With ``known``, a folder of hashes that ``store`` keeps, contents that were
    ingested before are left out, and of equal new ones all but that of the lowest uri; they are no rejects."""
    with many_files(spark):
        return _ingest_files(spark, prefix, settings, known)


def _ingest_files(spark: SparkSession, prefix: str, settings: Settings, known: str | None) -> Ingested:
    return ingest_listed(spark, prefix, listing(spark, prefix), settings, known, 0 if known is None else next_batch(spark, known))


def ingest_listed(spark: SparkSession, prefix: str, listed: DataFrame, settings: Settings, known: str | None, batch: int) -> Ingested:
    """The files of a written listing (uri, length) below a prefix. With ``known`` contents of batches before number
    ``batch`` are left out, and of equal new ones all but that of the lowest uri."""
    raw = read_contents(spark, prefix, max_bytes=settings.max_bytes, listed=listed)
    rejects = too_large(listed, settings.max_bytes)
    if known is None:
        return ingest(raw, settings, rejects, listed)
    hashed = staged(raw.select("uri", content_hash(F.col("content")).alias("content_sha256")), "hashes")
    once = hashed.groupBy("content_sha256").agg(F.min("uri").alias("uri"))
    fresh = staged(once.join(known_contents(spark, known, once, batch), "content_sha256", "left_anti"), "fresh")
    # What was hashed was read: only the others and the fresh ones are held against the result.
    others = hashed.join(fresh, ["uri", "content_sha256"], "left_anti")
    wanted = staged(listed.join(fresh.select("uri"), "uri", "left_semi"), "wanted")
    raw = read_contents(spark, prefix, max_bytes=settings.max_bytes, listed=wanted)
    return replace(ingest(raw, settings, rejects, listed.join(others.select("uri"), "uri", "left_anti")), hashes=fresh)


def store(result: Ingested, root: str, buckets: int | None = None, known: str | None = None) -> None:
    """Upsert an ingestion into the tables at ``root``, rejects too.

    ``buckets`` counts when the tables are new; unless given it follows their rows. The hashes of new contents go to
    ``known`` when the tables are written.
    """
    # The chunks are read where the ingestion has written them.
    tables.update(root, staged(result.documents, "documents"), result.chunks, staged(result.rejects, "rejects"), buckets=buckets)
    if known is not None and result.hashes is not None:
        remember_contents(result.hashes, known, next_batch(result.hashes.sparkSession, known))
