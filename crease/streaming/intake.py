"""Message intake: readable messages, dead letters and an audit, per micro-batch.

A message that cannot be read -- no value, no JSON object, a field of the wrong
type -- is a dead letter: it is kept with its offset, its payload and the reason,
instead of turning into nulls that later filters drop.  A micro-batch is written by
one job, ``<sink>/rows/batch=<id>/kind=good|dead``; the same pass observes what the
batch holds (null counts, rows that cleaning would remove), and one row of it goes to
``<sink>/audit/batch=<id>``.  A retried batch rewrites its own folders.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crease import schema as S
from crease.functions import count_if
from crease.operators.quality import valid_delivery
from crease.sources.storage import committed

CORRUPT = "unread"
NO_VALUE, NOT_JSON, WRONG_TYPE = "no value", "not a JSON object", "field of a wrong type"
COLUMNS = ["kafka_offset", "event_time", "message_key", "match_id", "batting_team", "batter", "bowler",
           "over_num", "ball_num", "runs_off_bat", "total_runs", "wicket", "payload", "reason"]
ROWS = ("kafka_offset long, event_time timestamp, message_key string, match_id string, batting_team string, "
        "batter string, bowler string, over_num int, ball_num int, runs_off_bat int, total_runs int, "
        "wicket string, payload string, reason string, kind string")
AUDIT = ("batch_id long, messages long, dead long, rows_before long, rows_after long, "
         "batter_nulls long, bowler_nulls long, runs_nulls long")


def judged_messages(envelope: DataFrame) -> DataFrame:
    """Every message with its fields, or its payload and the reason it cannot be read.

    Each value is parsed once: the struct is expanded by ``inline``.
    """
    schema = T.StructType([*S.EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # one row a message whatever the value holds: a null struct gives null fields
    rows = envelope.select(
        F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("event_time"),
        F.col("key").cast("string").alias("message_key"), text.alias("payload"), F.inline(F.array(parsed)))
    # a value that parses in part only is an object with a field of a wrong type
    whole = F.get_json_object("payload", "$").startswith("{")
    reason = (F.when(F.col("payload").isNull(), NO_VALUE)
              .when(F.trim("payload") == "", NOT_JSON)
              .when(F.col(CORRUPT).isNotNull(), F.when(whole, WRONG_TYPE).otherwise(NOT_JSON)))
    rows = rows.withColumn("reason", reason).withColumnsRenamed({"over": "over_num", "ball": "ball_num"})
    good = F.col("reason").isNull()
    fields = [F.when(good, F.col(c)).alias(c) for c in COLUMNS[3:12]]
    return rows.select(*COLUMNS[:3], *fields, F.when(~good, F.col("payload")).alias("payload"), "reason",
                       F.when(good, "good").otherwise("dead").alias("kind"))


def audit_metrics() -> list[Column]:
    good = F.col("reason").isNull()
    return [F.count(F.lit(1)).alias("messages"), count_if(~good).alias("dead"),
            count_if(good).alias("rows_before"), count_if(good & valid_delivery()).alias("rows_after"),
            *[count_if(good & F.col(c).isNull()).alias(n) for c, n in (
                ("batter", "batter_nulls"), ("bowler", "bowler_nulls"), ("runs_off_bat", "runs_nulls"))]]


def intake_sink(base: str):
    """foreachBatch callback: one pass writes both kinds of rows and observes them."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        seen = Observation(f"intake-{batch_id}")
        (batch_df.observe(seen, *audit_metrics()).write.mode("overwrite")
         .partitionBy("kind").parquet(f"{base}/rows/batch={batch_id}"))
        # one row: the observed numbers of the batch
        numbers = [F.lit(int(seen.get.get(c, 0) or 0)).cast("long").alias(c)
                   for c in (f.split()[0] for f in AUDIT.split(", ")[1:])]
        (spark.range(1).select(F.lit(int(batch_id)).cast("long").alias("batch_id"), *numbers)
         .coalesce(1).write.mode("overwrite").parquet(f"{base}/audit/batch={batch_id}"))
    return sink


def start_intake(envelope: DataFrame, sink_path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    return (judged_messages(envelope).writeStream.outputMode("append")
            .foreachBatch(intake_sink(sink_path.rstrip("/")))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start())


def _batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    paths = [f"{folder}/batch={b}" for b in committed(spark, folder, "batch")]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*paths)


def read_messages(spark: SparkSession, sink_path: str) -> DataFrame:
    """The readable messages of all complete micro-batches."""
    return _batches(spark, f"{sink_path.rstrip('/')}/rows", ROWS).filter("kind = 'good'").select(*COLUMNS[:12])


def read_dead_letters(spark: SparkSession, sink_path: str) -> DataFrame:
    """kafka_offset, event_time, message_key, payload and reason of what could not be read."""
    return (_batches(spark, f"{sink_path.rstrip('/')}/rows", ROWS).filter("kind = 'dead'")
            .select(*COLUMNS[:3], "payload", "reason"))


def read_audit(spark: SparkSession, sink_path: str) -> DataFrame:
    """One row a micro-batch: what it held and what cleaning would remove."""
    return _batches(spark, f"{sink_path.rstrip('/')}/audit", AUDIT)
