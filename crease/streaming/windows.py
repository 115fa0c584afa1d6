"""Event-time windows per match, with late balls counted in a side table.

The watermark before a micro-batch is the latest event time of the batches before it,
less ``delay``.  A ball is late when its window ended by then; late balls do not change
a closed window, they are counted by match and window beside it.  Each micro-batch is
aggregated once, ``<sink>/sums/batch=<id>/late=true|false``, and its part of every window is
added up when read, so that no window, match or batch is rewritten; the watermark is
one row, versioned, and completes the batch.  A retried batch rewrites its own folder
from the same watermark.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crease.functions import count_if, is_present
from crease.sources.storage import committed
from crease.streaming.versioned import latest_version, read_latest, write_version

SUMS = ("match_id string, window_start timestamp, window_end timestamp, runs long, balls long, "
        "wickets long, seen timestamp, late boolean")
PROGRESS = "watermark timestamp, seen timestamp"


def _mark(spark: SparkSession, base: str, before: int | None = None) -> dt.datetime | None:
    """The watermark after the last complete batch (below ``before``)."""
    table = read_latest(spark, f"{base}/progress", PROGRESS, before=before)
    return None if table is None else table.first()["watermark"]


def window_sink(base: str, width: str, delay: str):
    """foreachBatch callback: one aggregate of the batch, then the new watermark."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if latest_version(spark, f"{base}/progress") == batch_id:      # a retried batch that was complete
            return
        mark = _mark(spark, base, before=batch_id)
        late = F.lit(False) if mark is None else F.col("w.end") <= F.lit(mark)
        (batch_df.filter("event_time IS NOT NULL").withColumn("w", F.window("event_time", width))
         .groupBy("match_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                  late.alias("late"))
         .agg(F.sum("runs_off_bat").alias("runs"), F.count(F.lit(1)).alias("balls"),
              count_if(is_present("wicket")).alias("wickets"), F.max("event_time").alias("seen"))
         .write.mode("overwrite").partitionBy("late").parquet(f"{base}/sums/batch={batch_id}"))
        now = spark.read.schema(SUMS).parquet(f"{base}/sums/batch={batch_id}").select("seen")
        earlier = read_latest(spark, f"{base}/progress", PROGRESS, before=batch_id)
        if earlier is not None:
            now = now.unionByName(earlier.select("seen"))
        write_version(now.agg(F.max("seen").alias("seen")).select(
            (F.col("seen") - F.expr(f"INTERVAL {delay}")).alias("watermark"), "seen").coalesce(1),
            f"{base}/progress", batch_id)
    return sink


def start_windows(parsed: DataFrame, sink_path: str, checkpoint: str, width: str = "1 hour",
                  delay: str = "12 hours", trigger: dict | None = None) -> StreamingQuery:
    """Start the query; its source bounds the micro-batches."""
    rows = parsed.select("match_id", "event_time", "runs_off_bat", "wicket")
    return (rows.writeStream.outputMode("append")
            .foreachBatch(window_sink(sink_path.rstrip("/"), width, delay))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start())


def _sums(spark: SparkSession, base: str) -> DataFrame:
    last = latest_version(spark, f"{base}/progress")
    done = [b for b in committed(spark, f"{base}/sums", "batch") if last is not None and b <= last]
    if not done:
        return spark.createDataFrame([], SUMS)
    return (spark.read.schema(SUMS).option("basePath", f"{base}/sums")
            .parquet(*[f"{base}/sums/batch={b}" for b in done]))


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("match_id", "window_start", "window_end").agg(
        *[F.sum(c).alias(c) for c in ("runs", "balls", "wickets")])


def read_windows(spark: SparkSession, sink_path: str) -> DataFrame:
    """The windows of every match, and whether the watermark has closed them."""
    base = sink_path.rstrip("/")
    mark = _mark(spark, base)
    closed = F.lit(False) if mark is None else F.col("window_end") <= F.lit(mark)
    return _added(_sums(spark, base).filter("NOT late")).withColumn("closed", closed)


def read_late(spark: SparkSession, sink_path: str) -> DataFrame:
    """What came after its window was closed, by match and window."""
    return _added(_sums(spark, sink_path.rstrip("/")).filter("late"))
