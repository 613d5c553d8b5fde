"""Inputs of the registered queries, derived by Spark from the given tables, whole and row by row."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metadata import DOCX, HTML, JSON, MARKDOWN, PDF, PLAIN
from ..functions.strings import fallback_tokens
from ..operators.extract import PARSED_ROWS
from ..operators.paths import normalize_path, prefixes_of
from ..session import scratch
from ..sources.tables import read_table

STAMP = "2024-01-01 00:00:00"


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return read_table(spark, sf, "documents", list(columns) or ["doc_id", "text"])


def sectioned(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose lines are paragraphs and whose short lines are headings of the three kinds."""
    def line(x: Column) -> Column:
        n = F.char_length(x)
        return (F.when(~n.between(4, 60), x).when(n % 3 == 0, F.concat(F.lit("## "), x))
                .when(n % 3 == 1, F.concat(F.lit("2.1 "), x)).otherwise(F.upper(F.translate(x, ".,ß", ""))))
    return documents(spark, sf).withColumn("text", F.array_join(F.transform(F.split("text", "\n"), line), "\n\n"))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn of a conversation as a text headed by its role."""
    return read_table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("## "), "role", F.lit("\n"), "text").alias("text"))


def typed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents opened by the words of a type, one kind of them by a tie."""
    case = F.col("doc_id") % 6
    opening = (F.when(case == 0, "Contrato cláusula ").when(case == 1, "proposta ").when(case == 2, "relatório ")
               .when(case == 3, "Curriculum vitae ").when(case == 4, "contrato proposta ").otherwise(""))
    return documents(spark, sf).select("doc_id", F.concat(opening, "text").alias("text"),
                                       F.concat(F.lit("report_"), F.col("doc_id").cast("string")).alias("filename"))


def document_table(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as rows of the document table."""
    case = F.col("doc_id") % 5
    return documents(spark, sf, "doc_id", "lang", "source", "n_chars").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit("mem://"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("uri"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), F.lit(PLAIN).alias("mime_type"),
        F.when(case == 0, "cv").when(case == 1, "contrato").otherwise("unknown").alias("doc_type"),
        F.col("lang").alias("language"), F.col("n_chars").cast("int").alias("char_count"),
        F.lit(STAMP).cast("timestamp").alias("ingest_timestamp"))


def line_chunks(spark: SparkSession, sf: str, version: str = "", source: str = "src%") -> DataFrame:
    """Rows of the chunk table: one chunk per line of a document, headed by its source on even lines."""
    lines = documents(spark, sf, "doc_id", "source", "text").where(F.col("source").like(source)).select(
        F.col("doc_id").cast("string").alias("doc_id"), "source", F.posexplode(F.split("text", "\n")).alias("chunk_index", "line"))
    return lines.select(F.concat_ws(":", "doc_id", F.col("chunk_index").cast("string")).alias("chunk_id"), "doc_id",
                        "chunk_index", F.when(F.col("chunk_index") % 2 == 0, F.col("source")).alias("section_heading"),
                        F.concat(F.lit(version), "line").alias("chunk_text"), fallback_tokens(F.col("line")).alias("token_count"))


def mixed_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as bytes of several media types; of forty, one is broken JSON and one of an unsupported type."""
    case = F.col("doc_id") % 4
    as_json = F.when(F.col("doc_id") % 40 == 2, F.concat(F.lit("{oops"), "text")).otherwise(F.to_json(F.struct("text")))
    escaped = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    as_html = F.concat(F.lit("<html><head><title>t</title><body><p>"), escaped, F.lit("</p><script>x()</script></body></html>"))
    return documents(spark, sf).select(
        F.concat(F.lit("mem://"), F.col("doc_id").cast("string")).alias("uri"),
        F.col("doc_id").cast("string").alias("filename"),
        F.when(case == 0, PLAIN).when(case == 1, MARKDOWN).when(case == 2, JSON).when(F.col("doc_id") % 40 == 39, PDF).otherwise(HTML).alias("mime_type"),
        F.encode(F.when(case == 2, as_json).when(case == 3, as_html).otherwise(F.col("text")), "UTF-8").alias("content"))


def nested_json(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested JSON texts."""
    events = read_table(spark, sf, "events", ["event_id", "event_type", "value", "props"])
    text = F.concat(F.lit('{"type": "'), "event_type", F.lit('", "value": '), F.col("value").cast("string"),
                    F.lit(', "props": '), "props", F.lit(', "tags": ["x", true, null, {"deep": [1, 2]}], "none": {}}'))
    return events.select("event_id", text.alias("text"))


def _docx(text: str) -> bytes:
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in text.split("\n"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def docx_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as word-processing files, one paragraph per line."""
    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for lo in range(0, max(1, len(texts)), PARSED_ROWS):
                yield pa.array([_docx(t) for t in texts[lo:lo + PARSED_ROWS].to_pylist()], pa.binary())
    return documents(spark, sf).select("doc_id", F.lit(DOCX).alias("mime_type"), pack("text").alias("content"))


def export_texts(rows: DataFrame, folder: str) -> None:
    """Add (key, text) to a folder as ``write.partitionBy(key).text`` would: a folder per key, a line per row.

    Each task writes its own rows, so that an export of any size needs no shuffle. Hadoop's local file system starts four
    processes for every file, to set permissions: into a folder of that kind tasks write the files themselves.
    """
    key, _ = rows.columns
    spark = rows.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        rows.write.mode("append").partitionBy(key).text(folder)
        return
    fs.mkdirs(place)
    top, run = fs.makeQualified(place).toUri().getPath(), uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task that comes again writes the same files.
        name, last, n = f"part-{TaskContext.get().partitionId():05d}-{run}.txt", (), 0
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = f"{top}/{key}={'__HIVE_DEFAULT_PARTITION__' if k is None else k}"
                os.makedirs(own, exist_ok=True)
                with open(f"{own}/{name}", "ab" if last == (k,) else "wb") as file:
                    file.write((text or "").encode() + b"\n")
                last, n = (k,), n + 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.sortWithinPartitions(key).mapInArrow(write, "n long").agg(F.sum("n")).collect()


def page_files(spark: SparkSession, sf: str) -> str:
    """The folder of a fresh export of all pages, one text file each."""
    folder = scratch(spark, "pages")
    export_texts(read_table(spark, sf, "pages", ["page_id", "html"]), folder)
    return folder


def page_number(uri: Column) -> Column:
    return F.regexp_extract(uri, "page_id=([0-9]+)", 1).cast("long")


# Trees of url paths -------------------------------------------------------------------------------

def page_paths(spark: SparkSession, sf: str) -> DataFrame:
    """page_id, ns (last two labels of the host) and path, whose three-digit numbers become three levels."""
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1)
    deep = F.regexp_replace(path, "([0-9])([0-9])([0-9])", "$1/$2/$3")
    return read_table(spark, sf, "pages", ["page_id", "url"]).select(
        "page_id", F.substring_index(host, ".", -2).alias("ns"), normalize_path(deep).alias("path"))


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's path and its ancestors: page_id, ns, path, depth, node_type."""
    pages = page_paths(spark, sf).where(F.col("path") != "")
    each = pages.select("page_id", "ns", F.col("path").alias("leaf"), F.posexplode(prefixes_of(F.col("path"))).alias("d", "path"))
    return each.select("page_id", "ns", "path", (F.col("d") + 1).alias("depth"),
                       F.when(F.col("path") == F.col("leaf"), "f").otherwise("d").alias("node_type"))


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The tree of all paths; what has something below it is a directory."""
    return steps(spark, sf).groupBy("ns", "path").agg(F.min("node_type").alias("node_type"))


# Query vectors ------------------------------------------------------------------------------------

def label_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """The mean vector of every label as a batch of queries."""
    each = read_table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = each.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One entry per dimension, whatever the number of rows.
    return means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v")).select(
        F.col("label").alias("query_id"), F.transform("v", lambda e: e["x"]).alias("query_vector"))


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors, pulled apart by label."""
    apart = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(F.pmod("label", F.lit(64)) == i, F.lit(8.0)).otherwise(F.lit(0.0)))
    table = read_table(spark, sf, "embeddings")
    return table.select("label", F.col("vec_id").alias("chunk_id"), F.zip_with("embedding", apart, lambda x, a: (x + a).cast("float")).alias("embedding"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings").withColumnRenamed("vec_id", "chunk_id")


def asked_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector whose id is divisible by 20, as it is, as a batch of queries."""
    return read_table(spark, sf, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("query_vector"))


def spoken_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors with the language of the document of the same number; vectors beyond the documents have none."""
    langs = documents(spark, sf, "doc_id", "lang")
    return vectors(spark, sf).join(langs.withColumnRenamed("doc_id", "chunk_id"), "chunk_id", "left")
