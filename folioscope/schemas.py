"""Explicit schemas of the tables; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("uri", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("mime_type", T.StringType(), False),
    T.StructField("content", T.BinaryType()),
])
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("uri", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("mime_type", T.StringType(), False),
    T.StructField("doc_type", T.StringType(), False),
    T.StructField("language", T.StringType(), False),
    T.StructField("char_count", T.IntegerType(), False),
    T.StructField("ingest_timestamp", T.TimestampType(), False),
    T.StructField("extra_metadata", T.VariantType(), False),
])
CHUNKS = T.StructType([
    T.StructField("chunk_id", T.StringType(), False),
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("section_heading", T.StringType()),
    T.StructField("chunk_text", T.StringType(), False),
    T.StructField("token_count", T.IntegerType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])
REJECTS = T.StructType([
    T.StructField("uri", T.StringType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
])
NODES = T.StructType([
    T.StructField("ns", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("node_type", T.StringType(), False),
])
# Literal values a missing column gets, as SQL expressions.
DOCUMENT_DEFAULTS = {"doc_type": "'unknown'", "language": "'unknown'", "char_count": "0",
                     "ingest_timestamp": "current_timestamp()", "extra_metadata": "parse_json('{}')"}
CHUNK_DEFAULTS = {"token_count": "0"}
