"""Document files of any Hadoop file system."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metadata import EXTENSION_MIME, detect_mime
from ..functions.strings import basename, extension
from ..session import TASKS_PER_CORE, many_files, staged

# What the binary file source delivers; declared, as a stream has to be told.
BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


def _any_case(suffix: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix.lstrip("."))


# Unsupported files are left out while listing, before any task sees them.
SUPPORTED_GLOB = "*.{" + ",".join(_any_case(e) for e in EXTENSION_MIME) + "}"


# Above so many matches of a prefix the whole folder is listed and filtered, unless it holds so many times as many.
FEW_MATCHES, MOSTLY = 32, 8


def _check_uri(prefix: str) -> None:
    if not re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:/", prefix) and not prefix.startswith("/"):
        raise ValueError(f"not a file system uri: {prefix!r}")


def _local(spark: SparkSession, uri: str) -> str | None:
    """The path of a uri in a file system that all machines mount; None for others."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _hidden(name: str) -> bool:
    """What Spark's file sources leave out."""
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


# So many names or files are one Arrow batch, files of so many bytes at most unless a single one is larger.
BATCH_FILES, BATCH_BYTES = 1024, 4 << 20
# Files are dealt to tasks of so many bytes, small inputs to smaller ones; opening a file counts as 64 KiB.
TASK_BYTES, LEAST_TASK_BYTES, OPENING = 128 << 20, 1 << 20, 1 << 16


def _walked(spark: SparkSession, folder: str, start: str) -> DataFrame:
    """path, modificationTime and length of the supported files below a local folder, in entries that begin with ``start``.

    The entries of the folder are found by one task, those below by many, so that the driver holds none of them.
    """
    endings = tuple(EXTENSION_MIME)
    text = lambda name: name.encode("utf-8", "surrogateescape").decode("utf-8", "replace")

    def below(path: str, first: bool = False) -> Iterator[tuple[str, bool]]:
        try:
            with os.scandir(path) as entries:
                for e in entries:
                    inside = e.is_dir()
                    # Folders that the prefix names are entered whatever their name.
                    if (e.name.startswith(start) and (not _hidden(e.name) or (inside and start != ""))) if first else not _hidden(e.name):
                        if inside or e.name.lower().endswith(endings):
                            yield e.path, inside
        except (FileNotFoundError, NotADirectoryError):
            return

    def entries(found: Iterator[tuple[str, bool]]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for x in found:
            held.append(x)
            if len(held) == BATCH_FILES:
                yield pa.RecordBatch.from_arrays([pa.array([text(p) for p, _ in held], pa.string()), pa.array([d for _, d in held], pa.bool_())], names=["path", "inside"])
                held = []
        yield pa.RecordBatch.from_arrays([pa.array([text(p) for p, _ in held], pa.string()), pa.array([d for _, d in held], pa.bool_())], names=["path", "inside"])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool]]:
        return (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return entries(x for b in batches for _ in range(b.num_rows) for x in below(folder, True))

    def middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return entries(x for path, inside in rows_of(batches) for x in (below(path) if inside else [(path, inside)]))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            waiting, out = [*zip(b.column(0).to_pylist(), b.column(1).to_pylist())][::-1], []
            while waiting:
                path, inside = waiting.pop()
                if inside:
                    waiting.extend(below(path))
                    continue
                try:
                    known = os.stat(path)
                except FileNotFoundError:
                    continue
                # Spark's file sources leave out empty files.
                if known.st_size:
                    out.append((f"file:{path}", known.st_mtime_ns // 1_000_000 * 1000, known.st_size))
                if len(out) == BATCH_FILES:
                    yield table(out)
                    out = []
            yield table(out)

    def table(out: list) -> pa.RecordBatch:
        kinds = [pa.string(), pa.timestamp("us", tz="UTC"), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["path", "modificationTime", "length"])

    deal, kind = TASKS_PER_CORE * spark.sparkContext.defaultParallelism, "path string, inside boolean"
    found = spark.range(1, numPartitions=1).mapInArrow(top, kind).repartition(deal, "path").mapInArrow(middle, kind)
    return found.repartition(deal, "path").mapInArrow(leaves, "path string, modificationTime timestamp, length long")


def _opened(listed: DataFrame, partitions: int | None) -> DataFrame:
    """path, length and content of the local files of a written listing (uri, length); those that can't be read give no row."""
    spark = listed.sparkSession
    known = listed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    size = known["n"] * OPENING + known["bytes"]
    most = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    n = partitions or max(1, min(most, size // LEAST_TASK_BYTES), size // TASK_BYTES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                try:
                    with open(uri[len("file:"):], "rb") as file:
                        content = file.read()
                except OSError:
                    continue
                if held and (len(held) == BATCH_FILES or size + len(content) > BATCH_BYTES):
                    yield table(held)
                    held, size = [], 0
                held.append((uri, len(content), content))
                size += len(content)
        yield table(held)

    def table(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.binary()))], names=["path", "length", "content"])

    return listed.select("uri").repartition(n, "uri").mapInArrow(read, "path string, length long, content binary")


def _files(spark: SparkSession, prefix: str) -> DataFrame:
    """Files whose uri starts with ``prefix``, a string prefix as object stores have it.

    Spark's own listing goes through the driver, with all that it knows of every file. Local files, as many as there may
    be, are listed and read by tasks.
    """
    _check_uri(prefix)
    root = _local(spark, f"{prefix.rpartition('/')[0]}/")
    if root is not None:
        supported = extension(F.col("path")).isin(*EXTENSION_MIME)
        return _walked(spark, root, prefix.rpartition("/")[2]).where(supported)
    folder, _, start = prefix.rpartition("/")
    # Glob characters of the prefix stand for themselves.
    escaped = re.sub(r"([\\*?\[\]{}])", r"\\\1", prefix if not start else f"{folder}/{start}")
    reader = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", SUPPORTED_GLOB).option("ignoreMissingFiles", "true")
              .option("ignoreCorruptFiles", "true"))
    pattern = escaped + ("*" if start else "")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    matched = fs.globStatus(path)
    # A prefix that matches nothing is an empty listing, as object stores have it.
    if not matched:
        return spark.createDataFrame([], BINARY_FILE)
    supported = extension(F.col("path")).isin(*EXTENSION_MIME)
    # Each match of a pattern is a root of its own, which Spark looks up one by one: many are found from their folder.
    above = path.getParent()
    if start and len(matched) > FEW_MATCHES and len(fs.listStatus(above)) <= MOSTLY * len(matched):
        supported &= F.startswith(F.col("path"), F.lit(fs.makeQualified(jvm.org.apache.hadoop.fs.Path(above, start)).toString()))
        pattern = re.sub(r"([\\*?\[\]{}])", r"\\\1", folder)
    with many_files(spark):
        return reader.load(pattern).where(supported)


def list_documents(spark: SparkSession, prefix: str) -> DataFrame:
    """Supported files below a prefix: uri, filename, mime_type, length, modified. No content is read."""
    return _files(spark, prefix).select(
        F.col("path").alias("uri"), basename(F.col("path")).alias("filename"),
        detect_mime(basename(F.col("path"))).alias("mime_type"), "length",
        F.col("modificationTime").alias("modified"))


def arrived(spark: SparkSession, folder: str) -> DataFrame:
    """uri, length and time of the supported files of a folder and its subfolders."""
    with many_files(spark):
        return _files(spark, f"{folder.rstrip('/')}/").select(F.col("path").alias("uri"), "length", F.col("modificationTime").alias("modified"))


def to_raw(files: DataFrame, hint: Column | None = None) -> DataFrame:
    """Rows of the binary file source as raw documents."""
    name = basename(F.col("path"))
    return files.select(F.col("path").alias("uri"), name.alias("filename"),
                        detect_mime(name, hint).alias("mime_type"), "content")


def listing(spark: SparkSession, prefix: str) -> DataFrame:
    """uri and length of every supported file, written once, so that what is lost later is known."""
    with many_files(spark):
        return staged(_files(spark, prefix).select(F.col("path").alias("uri"), "length"), "listing")


def too_large(listed: DataFrame, max_bytes: int | None) -> DataFrame:
    """Rejects by the listing alone; without a limit there are none."""
    over = F.lit(False) if max_bytes is None else F.col("length") > max_bytes
    return listed.where(over).select("uri", F.lit("read").alias("stage"), F.lit("too_large").alias("reason"))


def unreadable(listed: DataFrame, seen: DataFrame, max_bytes: int | None) -> DataFrame:
    """Rejects for listed files that are not among the rows ``seen`` that came out of reading."""
    within = listed if max_bytes is None else listed.where(F.col("length") <= max_bytes)
    return within.join(seen.select("uri"), "uri", "left_anti").select("uri", F.lit("read").alias("stage"), F.lit("unreadable").alias("reason"))


def read_contents(spark: SparkSession, prefix: str, hint: Column | None = None, max_bytes: int | None = None,
                  partitions: int | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Raw documents of all files that can be read. Only with ``max_bytes`` are larger files left out, before they are read.

    The scan packs files into tasks by size; ``partitions`` spreads a short list of slow files further. With ``listed``,
    a written part of the listing (uri, length), just these files.
    """
    if _local(spark, f"{prefix.rpartition('/')[0]}/") is not None:
        own = listing(spark, prefix) if listed is None else listed.select("uri", "length")
        return to_raw(_opened(own if max_bytes is None else own.where(F.col("length") <= max_bytes), partitions), hint)
    files = _files(spark, prefix)
    if listed is not None:
        files = files.join(listed.select(F.col("uri").alias("path")), "path", "left_semi")
    small = files if max_bytes is None else files.where(F.col("length") <= max_bytes)
    if partitions:
        small = small.repartition(partitions)
    return to_raw(small.where(F.col("content").isNotNull()), hint)


def read_documents(spark: SparkSession, prefix: str, hint: Column | None = None, max_bytes: int | None = None,
                   partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw documents, rejects). Every file listed now is in one of them, however reading it goes.

    Evaluating the rejects reads the contents again; ``ingest_files`` compares the listing to its parsed table instead.
    """
    listed = listing(spark, prefix)
    raw = read_contents(spark, prefix, hint, max_bytes, partitions, listed)
    return raw, unreadable(listed, raw, max_bytes).unionByName(too_large(listed, max_bytes))
