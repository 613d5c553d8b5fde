"""Progress and errors of running streams, and the health of what they report, by time window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class IngestMonitor(StreamingQueryListener):
    """Passes rows, latency and failures of every batch to ``report(event, values)``."""

    def __init__(self, report: Callable[[str, dict], None]):
        self.report = report

    def onQueryStarted(self, event):
        self.report("started", {"id": str(event.id), "name": event.name})

    def onQueryProgress(self, event):
        p = event.progress
        self.report("progress", {"id": str(p.id), "batch": p.batchId, "rows": p.numInputRows,
                                 "milliseconds": dict(p.durationMs)})

    def onQueryIdle(self, event):
        self.report("idle", {"id": str(event.id)})

    def onQueryTerminated(self, event):
        self.report("terminated", {"id": str(event.id), "error": event.exception})


def health_windows(events: DataFrame, failed: Column, latency: Column, by: Sequence[str] = (), time: str = "ts",
                   width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Per window of ``width`` and key: window_start, ``by``, n, n_failed, error_rate, mean_latency, max_latency.

    For tables and streams alike. In a stream an event that comes after its window ended ``delay`` before the newest
    event of an earlier batch is late and counts nowhere; that bounds the windows that are held. NULL latencies are
    left out of the latencies, NULL times of everything.
    """
    seen = events.withColumns({"_failed": failed.cast("long"), "_latency": latency.cast("double"), "_time": F.col(time).cast("timestamp")}).withWatermark("_time", delay)
    found = seen.groupBy(F.window("_time", width).alias("_window"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_failed"), F.lit(0)).alias("n_failed"), F.avg("_latency").alias("mean_latency"), F.max("_latency").alias("max_latency"))
    rate = F.col("n_failed") / F.col("n")
    return found.select(F.col("_window.start").alias("window_start"), *by, "n", "n_failed", rate.alias("error_rate"), "mean_latency", "max_latency")


def watch_health(windows: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep the windows of a stream at ``root``, as far as events have arrived, then stop.

    Each batch writes the windows it changed, under its number: a batch that is repeated after a failure replaces them.
    """
    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/batch={number}")

    return (windows.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def watched_windows(spark: SparkSession, root: str, by: Sequence[str] = ()) -> DataFrame:
    """The windows that ``watch_health`` keeps, each as its last batch left it."""
    rows = spark.read.parquet(root)
    keys, rest = ["window_start", *by], [c for c in rows.columns if c not in ("window_start", "batch", *by)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*keys, "_last.*")


def alerts(windows: DataFrame, max_error_rate: float, max_latency: float, min_events: int = 1) -> DataFrame:
    """Windows of at least ``min_events`` events over a limit, with ``reason``: errors, latency, or both."""
    errors, slow = F.col("error_rate") > max_error_rate, F.col("max_latency") > max_latency
    reason = F.when(errors & slow, "errors and latency").when(errors, "errors").when(slow, "latency")
    return windows.where(F.col("n") >= min_events).withColumn("reason", reason).where("reason IS NOT NULL")
