"""Filters over the stored tables, content hashes and metadata rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged


def by_uri(documents: DataFrame, uri: str) -> DataFrame:
    return documents.where(F.col("uri") == uri)


def by_type_language(documents: DataFrame, doc_type: str | None = None, language: str | None = None) -> DataFrame:
    """Both columns partition the stored table, so only matching folders are read."""
    out = documents
    if doc_type is not None:
        out = out.where(F.col("doc_type") == doc_type)
    if language is not None:
        out = out.where(F.col("language") == language)
    return out


def chunks_of(chunks: DataFrame, doc_id, order: bool = True) -> DataFrame:
    found = chunks.where(F.col("doc_id") == doc_id)
    return found.orderBy("chunk_index") if order else found


def ordered_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.orderBy("doc_id", "chunk_index")


def by_heading(chunks: DataFrame, pattern: str) -> DataFrame:
    """Chunks of sections whose heading is LIKE ``pattern``; chunks without heading never match."""
    return chunks.where(F.col("section_heading").isNotNull() & F.col("section_heading").like(pattern))


# JSON ---------------------------------------------------------------------------------------------

def _path(keys: tuple[str, ...]) -> str:
    return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)


def json_contains(value: Column, pattern: Mapping) -> Column:
    """True if the variant holds every scalar of ``pattern`` at its place, with its type.

    Numbers equal by value (1 is 1.0) but never a string; nested objects are matched by key.
    """
    def conditions(part: Mapping, at: tuple[str, ...]):
        for key, expected in part.items():
            path = _path(at + (key,))
            kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
            if isinstance(expected, Mapping):
                yield F.startswith(kind, F.lit("OBJECT"))
                yield from conditions(expected, at + (key,))
            elif expected is None:
                yield kind == "VOID"
            elif isinstance(expected, bool):
                yield (kind == "BOOLEAN") & (F.try_variant_get(value, path, "boolean") == expected)
            elif isinstance(expected, (int, float)):
                number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
                cast = "decimal(38,0)" if isinstance(expected, int) else "double"
                exact = F.try_variant_get(value, path, cast) == F.lit(str(expected)).cast(cast)
                yield number & exact & (F.try_variant_get(value, path, "double") == float(expected))
            elif isinstance(expected, str):
                yield (kind == "STRING") & (F.try_variant_get(value, path, "string") == expected)
            else:
                raise TypeError(f"containment of {type(expected).__name__} is not supported")

    out = F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))
    for condition in conditions(pattern, ()):
        out = out & condition
    return F.coalesce(out, F.lit(False))


def json_has_key(text: Column, key: str) -> Column:
    """True if the JSON text is an object with that key at its top level, be its value null."""
    return F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))


# Content hashes -----------------------------------------------------------------------------------

def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def skip_ingested(raw: DataFrame, ingested: DataFrame | None = None, content: str = "content",
                  uri: str = "uri") -> DataFrame:
    """Raw documents of new content, one per content (lowest uri), with ``content_sha256``.

    Hashes and uris decide; ``new_contents`` gives just these, for a reader that fetches the winners by their uri.
    """
    hashed = raw.withColumn("content_sha256", content_hash(F.col(content)))
    return hashed.join(new_contents(raw, ingested, content, uri), [uri, "content_sha256"], "left_semi")


def new_contents(raw: DataFrame, ingested: DataFrame | None = None, content: str = "content", uri: str = "uri") -> DataFrame:
    """(uri, content_sha256) of new contents, one per content (lowest uri).

    Contents are hashed where they are read and dropped; hashes are written once and combined per partition, so a
    content with a third of all copies costs one row per partition. No exchange carries a content.
    """
    hashes = staged(raw.select(uri, content_hash(F.col(content)).alias("content_sha256")), "hashes")
    first = hashes.groupBy("content_sha256").agg(F.min(uri).alias(uri))
    if ingested is not None:
        first = first.join(ingested.select("content_sha256").distinct(), "content_sha256", "left_anti")
    return first.select(uri, "content_sha256")


def _part(digest: Column) -> Column:
    return F.substring(digest, 1, 2)


def known_contents(spark: SparkSession, root: str, asked: DataFrame, before: int) -> DataFrame:
    """The hashes among ``asked`` (content_sha256) that batches before number ``before`` left at ``root``.

    The stored set lies in folders by the first two digits, of which only those asked for are opened.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return asked.select("content_sha256").limit(0)
    parts = [r["part"] for r in asked.select(_part(F.col("content_sha256")).alias("part")).distinct().collect()]  # at most 256
    stored = spark.read.schema("content_sha256 string, part string, batch long").parquet(root).where(F.col("part").isin(parts) & (F.col("batch") < before))
    return stored.join(asked.select("content_sha256"), "content_sha256", "left_semi").select("content_sha256")


def next_batch(spark: SparkSession, root: str) -> int:
    """The number after those of the batches at ``root``, as their folders' names have them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/part=*/batch=*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return max([int(f.getPath().getName().split("=")[1]) + 1 for f in found], default=0)


def remember_contents(hashes: DataFrame, root: str, batch: int) -> None:
    """Add a batch's hashes to the stored set. A batch that comes again replaces what it left."""
    rows = hashes.select("content_sha256", _part(F.col("content_sha256")).alias("part"), F.lit(batch).cast("long").alias("batch"))
    writer = rows.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("part", "batch").parquet(root)


# Extra metadata -----------------------------------------------------------------------------------

# Patterns for a few facts that documents state; the first group of each is the value.
DEFAULT_RULES = {
    "email": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    "date": r"([0-9]{4}-[0-9]{2}-[0-9]{2})",
    "amount": r"((?:€|EUR|USD|\$) ?[0-9]+(?:[.,][0-9]+)*)",
    "url": r"(https?://[^\s\"'<>]+)",
}


def extract_metadata(df: DataFrame, rules: Mapping[str, str] = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add ``extra_metadata``: per rule the distinct matches in order; rules without a match are absent."""
    found = F.struct(*[F.nullif(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))),
                                F.array().cast("array<string>")).alias(name) for name, pattern in rules.items()])
    return df.withColumn("extra_metadata", F.parse_json(F.to_json(found)))


def extract_by_type(df: DataFrame, rules: DataFrame, doc_type: str = "doc_type", text: str = "text") -> DataFrame:
    """Add ``extra_metadata`` by the rules (doc_type, name, pattern) of each document's type; a rule without type is for all.

    The rules of a type are one row, so a document meets them in a join by type that adds no rows. Per name the
    distinct matches of the pattern's first group, in order; several rules of one name add up, in the order of their
    patterns; names without a match are absent, and a document without rules or text gets an empty object.
    """
    own = rules.where(F.col("doc_type").isNotNull()).groupBy(F.col("doc_type").alias("_type")).agg(F.collect_list(F.struct("name", "pattern")).alias("_own"))
    common = [(r["name"], r["pattern"]) for r in rules.where(F.col("doc_type").isNull()).select("name", "pattern").distinct().collect()]
    kind = "array<struct<name: string, pattern: string>>"
    general = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("pattern")) for n, p in common]).cast(kind)
    joined = df.join(own, F.col(doc_type) == F.col("_type"), "left")
    every = F.array_sort(F.array_distinct(F.concat(F.coalesce(F.col("_own").cast(kind), F.array().cast(kind)), general)))
    found = F.transform(every, lambda r: F.struct(r["name"].alias("name"), F.regexp_extract_all(F.col(text), r["pattern"], F.lit(1)).alias("m")))
    names = F.array_distinct(F.transform(every, lambda r: r["name"]))
    merged = F.transform(names, lambda n: F.struct(n.alias("key"), F.array_distinct(F.flatten(F.transform(F.filter(F.col("_found"), lambda x: x["name"] == n), lambda x: x["m"]))).alias("value")))
    full = F.filter(F.col("_merged"), lambda e: F.size(e["value"]) > 0)
    out = joined.withColumn("_found", found).withColumn("_merged", merged)
    value = F.coalesce(F.parse_json(F.to_json(F.map_from_entries(full))), F.parse_json(F.lit("{}")))
    return out.withColumn("extra_metadata", value).drop("_type", "_own", "_found", "_merged")
