"""Running batter totals over the whole topic, sunk per micro-batch.

``complete`` mode: each micro-batch carries the full result (one row per
batter -- state grows with batters, not with balls), written as a new
version of the result table.  ``update`` mode: only changed batters arrive
and are merged into the previous version by key (keyed upsert).
Nothing is collected to the driver; an empty micro-batch writes nothing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crease.functions import batting_totals, rate
from crease.streaming.versioned import (
    latest_version, merge_latest, read_latest, state_settings, write_version,
)

LIVE_COLUMNS = ["batter_name", "live_runs", "live_balls", "live_fours", "live_sixes", "live_sr"]


def live_stats(parsed: DataFrame) -> DataFrame:
    """Per-batter running totals; works on batch and streaming input alike."""
    return (parsed.groupBy("batter")
            .agg(*batting_totals("live_runs", "live_balls", "live_fours", "live_sixes"))
            .withColumn("live_sr", rate("live_runs", "live_balls", 100, 2)))


def without_redelivery(parsed: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each message once, for messages that come again within ``delay`` of event time.

    A message is its key and its offset at the producer.  The state holds a key for
    ``delay`` behind the latest event, then drops it: it is bounded by the messages of
    that time, not by the stream.
    """
    return (parsed.withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["message_key", "kafka_offset"]))


def _sink_rows(batch_df: DataFrame, batch_id: int) -> DataFrame:
    return batch_df.select(
        F.col("batter").alias("batter_name"), "live_runs", "live_balls", "live_fours",
        "live_sixes", F.coalesce(F.col("live_sr"), F.lit(0.0)).alias("live_sr"),
        F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.current_timestamp().alias("updated_at"))


def complete_sink(base: str, jdbc: dict | None = None):
    """foreachBatch callback for complete mode: the batch *is* the new table."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()          # the guard and the write would each run the batch
        try:
            if batch_df.isEmpty():
                return
            rows = _sink_rows(batch_df, batch_id)
            if jdbc:
                (rows.write.mode("overwrite").option("truncate", "true")
                 .jdbc(jdbc["url"], jdbc.get("table", "live_batter_stats"),
                       properties=jdbc.get("properties", {})))
            else:
                write_version(rows, base, batch_id)
        finally:
            batch_df.unpersist()
    return sink


def upsert_sink(base: str):
    """foreachBatch callback for update mode: merge changed keys into the last version."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if latest_version(spark, base) == batch_id:   # retried batch already published
            return
        batch_df.persist()
        try:
            if batch_df.isEmpty():
                return
            merged = merge_latest(read_latest(spark, base, before=batch_id),
                                  _sink_rows(batch_df, batch_id), ["batter_name"])
            write_version(merged, base, batch_id)
        finally:
            batch_df.unpersist()
    return sink


def start_live_stats(parsed_stream: DataFrame, sink_base: str, checkpoint: str,
                     mode: str = "complete", trigger: dict | None = None,
                     jdbc: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Start the live-stats query; ``trigger`` defaults to a 10 second interval.

    ``partitions`` fixes the state partition count at the first start.
    """
    trigger = trigger or {"processingTime": "10 seconds"}
    sink = complete_sink(sink_base, jdbc) if mode == "complete" else upsert_sink(sink_base)
    with state_settings(parsed_stream.sparkSession, partitions):
        return (live_stats(parsed_stream).writeStream
                .outputMode(mode)
                .foreachBatch(sink)
                .option("checkpointLocation", checkpoint)
                .trigger(**trigger)
                .start())


def read_live_table(spark: SparkSession, base: str) -> DataFrame | None:
    return read_latest(spark, base)


def live_leaderboard(spark: SparkSession, base: str, top_n: int | None = None) -> DataFrame | None:
    """Latest live table, most runs first (the sort the stream itself skips:
    sorting a streaming aggregate is legal only in complete mode and would
    re-sort the whole state every trigger)."""
    t = read_latest(spark, base)
    if t is None:
        return None
    t = t.orderBy(F.col("live_runs").desc(), F.col("batter_name").asc())
    return t.limit(top_n) if top_n else t
