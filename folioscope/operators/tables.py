"""Maintenance of the document and chunk tables: upsert, cascade, checks, storage."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metadata import document_id
from ..schemas import CHUNK_DEFAULTS, CHUNKS, DOCUMENT_DEFAULTS, DOCUMENTS, REJECTS


def latest_per_key(updates: DataFrame, key: str, order_by: str | None) -> DataFrame:
    """One row per key, the last in ``order_by``. Combined per partition first, so a hot key costs one row each.

    NULL comes before every order; equal orders are settled by a hash of the row. Without ``order_by`` the row that
    comes last in the table wins, by partition and place in it: for rows in an order of their own name a column.
    """
    rest = [c for c in updates.columns if c != key]
    tie = F.xxhash64(*[F.to_json(c) if isinstance(updates.schema[c].dataType, T.VariantType) else F.col(c) for c in rest])
    if order_by is None:
        place = [F.monotonically_increasing_id()]
    else:
        place = [F.col(order_by).isNotNull(), F.col(order_by)]
    placed = updates.withColumn("_place", F.struct(*[p.alias(f"p{i}") for i, p in enumerate([*place, tie])]))
    last = placed.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("_place")).alias("_row"))
    return last.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in updates.columns])


def upsert(target: DataFrame, updates: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """Target rows whose key is not updated, plus the last update of every key.

    Only the update keys meet the target, and Spark broadcasts them when they are small.
    """
    last = latest_per_key(updates, key, order_by)
    kept = target.join(updates.select(key).distinct(), key, "left_anti")
    return kept.unionByName(last.select(*target.columns))


def upsert_documents(target: DataFrame, updates: DataFrame, order_by: str | None = None) -> DataFrame:
    return upsert(target, updates, "doc_id", order_by)


def upsert_chunks(target: DataFrame, updates: DataFrame, mode: str = "replace_by_doc",
                  order_by: str | None = None) -> DataFrame:
    """``replace_by_doc`` removes every old chunk of an updated document, so a shrunken document
    leaves none behind; ``merge`` replaces equal chunk ids only."""
    if mode == "merge":
        return upsert(target, updates, "chunk_id", order_by)
    if mode != "replace_by_doc":
        raise ValueError(f"unknown mode {mode!r}")
    kept = target.join(updates.select("doc_id").distinct(), "doc_id", "left_anti")
    return kept.select(*target.columns).unionByName(
        latest_per_key(updates, "chunk_id", order_by).select(*target.columns))


def delete_documents(documents: DataFrame, chunks: DataFrame, doc_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the given documents: their chunks go with them."""
    gone = doc_ids.select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti"), chunks.join(gone, "doc_id", "left_anti")


def with_documents_kept(documents: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that have chunks, and rejects for those that have none."""
    have = chunks.select("doc_id").distinct()
    kept = documents.join(have, "doc_id", "left_semi")
    lost = documents.join(have, "doc_id", "left_anti").select(
        "doc_id", F.lit("chunk").alias("stage"), F.lit("no_chunks").alias("reason"))
    return kept, lost


def apply_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Fill NULL or absent columns from SQL expressions."""
    return df.withColumns({name: F.coalesce(F.col(name), F.expr(sql)) if name in df.columns else F.expr(sql)
                           for name, sql in defaults.items()})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema])


def document_rows(df: DataFrame) -> DataFrame:
    return conform(apply_defaults(df, DOCUMENT_DEFAULTS), DOCUMENTS)


def chunk_rows(df: DataFrame) -> DataFrame:
    return conform(apply_defaults(df, CHUNK_DEFAULTS), CHUNKS)


def violations(documents: DataFrame, chunks: DataFrame, dim: int = 768) -> DataFrame:
    """Broken constraints as rows (constraint, key, n): unique keys, references, NOT NULL, vector size."""
    def duplicates(df: DataFrame, key: str, name: str) -> DataFrame:
        return (df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"))
                .where((F.col("n") > 1) & F.col("key").isNotNull()).select(F.lit(name).alias("constraint"), "key", "n"))

    def broken(df: DataFrame, condition: Column, key: str, name: str) -> DataFrame:
        return (df.where(condition).groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"))
                .select(F.lit(name).alias("constraint"), "key", "n"))

    orphans = chunks.join(documents.select("doc_id").distinct(), "doc_id", "left_anti")
    parts = [
        duplicates(documents, "doc_id", "documents_key"),
        duplicates(chunks, "chunk_id", "chunks_key"),
        broken(orphans, F.lit(True), "chunk_id", "chunks_document"),
        broken(chunks, F.size("embedding") != dim, "chunk_id", "chunks_dimension"),
    ]
    for df, schema, key, name in ((documents, DOCUMENTS, "doc_id", "documents"), (chunks, CHUNKS, "chunk_id", "chunks")):
        required = [f.name for f in schema if not f.nullable and f.name in df.columns]
        missing = [F.when(F.col(c).isNull(), c) for c in required]
        parts.append(df.withColumn("_missing", F.explode(F.array_compact(F.array(*missing))))
                     .groupBy(F.col(key).cast("string").alias("key"), "_missing").agg(F.count("*").alias("n"))
                     .select(F.concat(F.lit(f"{name}_not_null_"), "_missing").alias("constraint"), "key", "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Stored tables ------------------------------------------------------------------------------------

def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Create both tables in the catalog unless they exist."""
    for name, schema, part in (("rag_documents", DOCUMENTS, "PARTITIONED BY (doc_type, language)"), ("rag_chunks", CHUNKS, "")):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {part}")


# Rows that a bucket of a new table is meant for; a table that grows to so many times as many is dealt out again.
ROWS_PER_BUCKET, GROWTH = 1 << 18, 4
# So many uris are looked up by a filter that Parquet can use; more are joined.
FEW_URIS = 100
# Stored layout: <table>/of=<buckets>/bucket=<n>/[doc_type=…/language=…/], buckets by a hash of the key. The writing with the most
# buckets that Spark has marked complete is the current one. Per table: schema, key, folders within a bucket, order within a file.
_STORED = {"documents": (DOCUMENTS, "doc_id", ["doc_type", "language"], ["uri"]), "chunks": (CHUNKS, "doc_id", [], ["doc_id", "chunk_index"]),
           "rejects": (REJECTS, "uri", [], ["uri"])}


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def writings(spark: SparkSession, root: str, table: str) -> list[int]:
    """The bucket counts of a table's complete writings, the current one last."""
    folder, fs = _folder(spark, f"{root}/{table}")
    names = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(p.getName()[3:]) for p in names if p.getName().startswith("of=") and fs.exists(p.suffix("/_SUCCESS")))


def _read(spark: SparkSession, root: str, table: str, buckets=None, with_bucket: bool = False) -> DataFrame:
    """The current rows, of the given buckets only; these are folders, so no other is opened."""
    schema = _STORED[table][0]
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    held = writings(spark, root, table)
    rows = spark.read.schema(whole).parquet(f"{root}/{table}/of={held[-1]}") if held else spark.createDataFrame([], whole)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(sorted(buckets)))
    return rows.select(*schema.names, *["bucket"] * with_bucket)


def _write(rows: DataFrame, root: str, table: str, n: int, whole: bool = True) -> None:
    """Rows (with ``bucket``) into their folders, as all that there is or in place of what these folders hold.

    A bucket with most rows is split into files.
    """
    _, _, folders, order = _STORED[table]
    keys = ["bucket", *folders]
    writer = rows.hint("rebalance", *keys).sortWithinPartitions(*keys, *order).write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
    if "uri" in rows.columns:
        writer = writer.option("parquet.bloom.filter.enabled#uri", "true")
    writer.partitionBy(*keys).parquet(f"{root}/{table}/of={n}")


def _publish(rows: DataFrame, root: str, table: str, buckets: int | None) -> None:
    """Write a table whole beside its earlier writings, which rows may come from. Tables of unknown size are counted."""
    spark, key = rows.sparkSession, _STORED[table][1]
    n = buckets or max(1, math.ceil(rows.count() / ROWS_PER_BUCKET))
    n = max([n, *[w + 1 for w in writings(spark, root, table)]])
    _write(rows.withColumn("bucket", _bucket(key, n)), root, table, n)


def publish(documents: DataFrame, chunks: DataFrame, root: str, rejects: DataFrame | None = None, buckets: int | None = None) -> None:
    """Write both tables whole, and the rejects: documents, then chunks, each visible when it is complete.

    ``buckets`` follows the number of rows unless given. Nothing stored is overwritten, so the rows may come from the
    tables they replace; ``drop_superseded`` removes these.
    """
    _publish(document_rows(documents), root, "documents", buckets)
    _publish(chunk_rows(chunks), root, "chunks", buckets)
    if rejects is not None:
        _publish(conform(rejects, REJECTS), root, "rejects", buckets)


def _replace(rows: DataFrame, root: str, table: str, touched: set[int]) -> None:
    """Put the rows of the touched buckets in place of what these hold: Spark overwrites the folders that get rows, those that
    are left without any go. Where buckets have grown long, the table is dealt into more."""
    spark = rows.sparkSession
    _, key, folders, _ = _STORED[table]
    n = writings(spark, root, table)[-1]
    # What is read lies where is written: Spark puts written folders in place of the old ones when all rows are read.
    kept = rows.withColumn("bucket", _bucket(key, n))
    if touched and kept.count() > GROWTH * ROWS_PER_BUCKET * len(touched):
        others = _read(spark, root, table, with_bucket=True).where(~F.col("bucket").isin(sorted(touched)))
        _publish(others.unionByName(kept).drop("bucket"), root, table, None)
        return
    leaves = lambda df: {tuple(r) for r in df.select("bucket", *folders).distinct().collect()}  # noqa: E731  a row per folder
    before, after = leaves(_read(spark, root, table, touched, True)), leaves(kept)
    _write(kept, root, table, n, whole=False)
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for leaf in before - after:
        inner = "/".join(f"{c}={escape(str(v))}" for c, v in zip(["bucket", *folders], leaf))
        path, fs = _folder(spark, f"{root}/{table}/of={n}/{inner}")
        fs.delete(path, True)


def update(root: str, documents: DataFrame, chunks: DataFrame, rejects: DataFrame | None = None,
           mode: str = "replace_by_doc", order_by: str | None = None, buckets: int | None = None) -> None:
    """Upsert into the stored tables, documents first; only the buckets that hold an updated key are read and written.

    All other buckets stay the files they are. A uri that comes again loses its old rejects. Give written tables, as
    each is read several times; ``buckets`` counts for a new store only. There is one writer at a time; an update that
    failed is repeated, which leaves the same rows. Where a catalog has MERGE, prefer it.
    """
    spark = documents.sparkSession
    for table, new in (("documents", documents), ("chunks", chunks), ("rejects", rejects)):
        if new is not None and not writings(spark, root, table):
            # An empty writing has no folders; the count of its buckets follows the first rows.
            n = buckets or max(1, math.ceil(new.count() / ROWS_PER_BUCKET))
            _write(spark.createDataFrame([], _STORED[table][0]).withColumn("bucket", F.lit(0)), root, table, n)
    touched = lambda table, key, *dfs: {r["b"] for d in dfs for r in d.select(_bucket(key, writings(spark, root, table)[-1]).alias("b")).distinct().collect()}
    in_docs, in_chunks = touched("documents", "doc_id", documents), touched("chunks", "doc_id", documents, chunks)
    new_docs, new_chunks = (documents, chunks) if order_by else (document_rows(documents), chunk_rows(chunks))
    merged = upsert_documents(_read(spark, root, "documents", in_docs), new_docs, order_by)
    _replace(document_rows(merged), root, "documents", in_docs)
    _replace(chunk_rows(upsert_chunks(_read(spark, root, "chunks", in_chunks), new_chunks, mode, order_by)), root, "chunks", in_chunks)
    if rejects is not None:
        seen = touched("rejects", "uri", rejects, documents)
        again = rejects.select("uri").unionByName(documents.select("uri")).distinct()
        kept = _read(spark, root, "rejects", seen).join(again, "uri", "left_anti")
        _replace(kept.unionByName(conform(rejects, REJECTS).distinct()), root, "rejects", seen)


def read_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Documents and chunks as they are stored, empty if there are none yet."""
    return _read(spark, root, "documents"), _read(spark, root, "chunks")


def lookup_uris(spark: SparkSession, root: str, uris: DataFrame) -> DataFrame:
    """The stored documents of the given uris, if their ids are the hashes of their uris, as the ingestion has them.

    A uri gives its id and so its bucket: only these buckets are opened, and within them the row groups whose range and
    bloom filter may hold one of a few uris.
    """
    held = writings(spark, root, "documents")
    asked = uris.select("uri", document_id(F.col("uri")).alias("doc_id")).distinct()
    placed = asked.withColumn("b", _bucket("doc_id", held[-1] if held else 1))
    few = placed.limit(FEW_URIS + 1).collect()
    if len(few) <= FEW_URIS:
        return _read(spark, root, "documents", {r["b"] for r in few}).where(F.col("uri").isin([r["uri"] for r in few]))
    touched = {r["b"] for r in placed.select("b").distinct().collect()}
    return _read(spark, root, "documents", touched).join(asked, ["uri", "doc_id"], "left_semi").select(*DOCUMENTS.names)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "rejects")


def drop_superseded(spark: SparkSession, root: str) -> int:
    """Remove all writings but the current one of every table; how many went. Rows that were read from them are lost."""
    gone = 0
    for table in _STORED:
        for n in writings(spark, root, table)[:-1]:
            path, fs = _folder(spark, f"{root}/{table}/of={n}")
            fs.delete(path, True)
            gone += 1
    return gone


# Relational target --------------------------------------------------------------------------------

def merge_statement(table: str, staging: str, key: str, columns: list[str], casts: Mapping[str, str] | None = None) -> str:
    """The statement that moves a staging table into its PostgreSQL target."""
    casts = casts or {}
    values = ", ".join(f"{c}::{casts[c]}" if c in casts else c for c in columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return (f"INSERT INTO {table} ({', '.join(columns)}) SELECT {values} FROM {staging} "
            f"ON CONFLICT ({key}) DO UPDATE SET {updates}")


def stage_jdbc(df: DataFrame, url: str, staging: str, properties: Mapping[str, str], partitions: int = 8) -> None:
    """Write the staging table of ``merge_statement`` through JDBC.

    Vectors and variants travel as text. ``partitions`` bounds the connections to the database.
    """
    def plain(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return F.concat(F.lit("["), F.array_join(F.col(f.name).cast("array<string>"), ","), F.lit("]")).alias(f.name)
        if isinstance(f.dataType, T.VariantType):
            return F.to_json(f.name).alias(f.name)
        return F.col(f.name)

    (df.select(*[plain(f) for f in df.schema]).repartition(partitions)
     .write.mode("overwrite").jdbc(url, staging, properties=dict(properties)))
