"""Ball messages: keyed JSON on a message bus (Kafka envelope columns).

``encode_messages`` turns delivery rows into (key = match id, value = JSON)
so one match stays in one bus partition and keeps its order;
``parse_messages`` is the inverse used by every consumer, identical for a
batch DataFrame and a streaming one.  The bus format is a parameter: the
``kafka`` source/sink in production, Parquet files of the same envelope in
tests (the Kafka connector jar is not bundled with Spark).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schema as S

MESSAGE_FIELDS = ["match_id", "batting_team", "batter", "bowler", "over", "ball",
                  "runs_off_bat", "extras", "total_runs", "wicket"]


def encode_messages(deliveries: DataFrame) -> DataFrame:
    """(key, value) strings; nulls are written as explicit JSON nulls."""
    d = deliveries
    if "extras" not in d.columns:
        d = d.withColumn("extras", F.col("total_runs") - F.col("runs_off_bat"))
    value = F.to_json(F.struct(
        F.col("match_id").alias("match_id"), F.col("batting_team").alias("batting_team"),
        F.col("batter").alias("batter"), F.col("bowler").alias("bowler"),
        F.col("over_num").alias("over"), F.col("ball_num").alias("ball"),
        F.col("runs_off_bat").alias("runs_off_bat"), F.col("extras").alias("extras"),
        F.col("total_runs").alias("total_runs"), F.col("wicket").alias("wicket")),
        {"ignoreNullFields": "false"})
    return d.select(F.col("match_id").alias("key"), value.alias("value"),
                    *[c for c in ("kafka_offset", "event_time") if c in d.columns])


def to_envelope(deliveries: DataFrame, topic: str = "balls", partitions: int = 1) -> DataFrame:
    """Envelope rows as the Kafka source would return them (offset = kafka_offset)."""
    enc = encode_messages(deliveries)
    return enc.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col("key")), F.lit(partitions)).cast("int").alias("partition"),
        F.col("kafka_offset").cast("long").alias("offset"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def write_messages(messages: DataFrame, fmt: str = "kafka", **options) -> None:
    """Keyed message sink, e.g. ``fmt="kafka", kafka.bootstrap.servers=.., topic=..``."""
    w = messages.select("key", "value").write.format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def read_messages(spark: SparkSession, streaming: bool = False, fmt: str = "kafka",
                  path: str | None = None, **options) -> DataFrame:
    """Envelope DataFrame from the bus (``kafka``) or from envelope files.

    Kafka defaults follow the source job: earliest offsets, no failure on
    data loss.  For files the envelope schema is given, never inferred.
    """
    r = spark.readStream if streaming else spark.read
    r = r.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}
    else:
        r = r.schema(S.ENVELOPE)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


def parse_messages(envelope: DataFrame, clean: bool = True) -> DataFrame:
    """value bytes -> JSON struct -> flat columns; bad JSON gives nulls (PERMISSIVE).

    With ``clean`` rows without a batter or with runs outside 0..6 are
    dropped.  ``offset`` and ``timestamp`` are kept as ``kafka_offset`` and
    ``event_time``.
    """
    ev = F.from_json(F.col("value").cast("string"), S.EVENT)
    # ``inline`` expands the parsed struct through a generator: later filters
    # on its fields cannot be pushed below it, so each message is parsed once
    # (pushed through a plain projection, every predicate would re-parse it).
    out = envelope.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("event_time"),
        F.inline(F.array(ev)),
    ).select(
        "match_id", "batting_team", "batter", "bowler",
        F.col("over").alias("over_num"), F.col("ball").alias("ball_num"),
        "runs_off_bat", "total_runs", "wicket",
        "event_time", "kafka_offset", "message_key")
    if clean:
        out = out.filter(F.col("batter").isNotNull()).filter(
            F.col("runs_off_bat").between(S.MIN_RUNS, S.MAX_RUNS))
    return out
