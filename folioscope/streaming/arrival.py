"""Files are ingested as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.catalog import remember_contents
from ..plans.ingest import Settings, ingest_listed, store
from ..session import staged
from ..sources.files import arrived

# What a list of arrivals says of a file.
ARRIVED = "uri string, length long"
# So many arrivals are one file of the list.
LIST_FILES = 1 << 18


def list_arrivals(spark: SparkSession, folder: str, seen: str, max_files: int | None = None) -> None:
    """Add the supported files of a folder and its subfolders that are not yet in the list at ``seen``, oldest first.

    The list is a table, which tasks compare with what they find. A writing that fails leaves some arrivals to the next.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(seen)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    new = staged(arrived(spark, folder).join(spark.read.schema(ARRIVED).parquet(seen).select("uri"), "uri", "left_anti"), "arrived")
    n = new.count()
    if n:
        ordered = new.orderBy("modified", "uri").coalesce(1) if max_files else new.repartition(-(-n // LIST_FILES))
        ordered.select("uri", "length").write.mode("append").option("maxRecordsPerFile", max_files or 0).parquet(seen)


def ingest_arrivals(spark: SparkSession, folder: str, root: str, checkpoint: str,
                    settings: Settings = Settings(), max_files: int | None = None, buckets: int | None = None,
                    known: str | None = None) -> StreamingQuery:
    """Ingest all files that arrived since the last run, then stop.

    A stream of files would hold every path in the driver; this one reads the list of arrivals beside its checkpoint,
    which names each file once. A batch that is repeated after a failure replaces the same ids, so it leaves the same
    tables. Each batch rewrites the buckets it touches and appends its rejects; choose ``max_files`` large enough that
    rewriting buckets is worth it. A file that is gone when its batch comes is rejected as unreadable.

    With ``known``, a folder that keeps the hashes of all contents that were ingested, a content is ingested once: of
    equal files the lowest uri of the first batch that has it. A content stays known when its document is replaced. The
    hashes are kept after the tables are written, under the batch's number, which its repetition leaves out of account.
    """
    below, seen = f"{folder.rstrip('/')}/", f"{checkpoint.rstrip('/')}/arrivals"

    def batch(files: DataFrame, batch_id: int) -> None:
        done = ingest_listed(spark, below, staged(files, "listing"), settings, known, batch_id)
        store(done, root, buckets)
        if known is not None:
            remember_contents(done.hashes, known, batch_id)

    list_arrivals(spark, folder, seen, max_files)
    reader = spark.readStream.schema(ARRIVED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", 1)
    return (reader.parquet(seen).writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
