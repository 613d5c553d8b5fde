"""Session settings and durable intermediate results."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # The plans are large expressions; noting a Python call site for each part takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "folioscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes; keywords use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (builder.config("spark.driver.host", "127.0.0.1")
                       .config("spark.driver.bindAddress", "127.0.0.1"))
    for key, value in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a session in one process may fall back to a temporary folder: executors of their own would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    root = tempfile.mkdtemp(prefix="folioscope-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# Folder names below the session's own, innermost last: see ``inner_stages``.
_INNER: list[str] = []


def _stages(spark: SparkSession) -> str:
    return "/".join([f"{shared_dir(spark)}/stages-{spark.sparkContext.applicationId}", *_INNER])


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stages(spark: SparkSession) -> None:
    """Remove what ``staged`` and ``scratch`` gave in this session. Results that still read from it are lost, so call it at the end."""
    _drop(spark, _stages(spark))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name below the session's own in the shared folder."""
    return f"{_stages(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def inner_stages(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is staged inside goes at the end, but for the tables that the given function writes."""
    outer = _stages(spark)
    _INNER.append(f"inner-{uuid.uuid4().hex}")
    own = _stages(spark)

    def keep(df: DataFrame, name: str = "kept") -> DataFrame:
        return _written(df, f"{outer}/{name}-{uuid.uuid4().hex}")

    try:
        yield keep
    finally:
        _INNER.pop()
        _drop(spark, own)


# Folders are listed, and small files read, by so many tasks for each core; Spark's own choice is 10,000 tasks for any listing.
_LISTING, _OPENING = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"
TASKS_PER_CORE = 4


@contextlib.contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """While it lasts, folders of many small files are listed by a few tasks per core, and opening a file counts as 64 KiB."""
    own = {_LISTING: str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism), _OPENING: str(1 << 16)}
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage and lets several consumers share one computation; unlike a cache
    the result survives the loss of executors.
    """
    return _written(df, scratch(df.sparkSession, name))
