"""Snapshot history and columns of an existing Iceberg table, read from its
``metadata/*.metadata.json`` files with the JSON reader (no Iceberg jar).

The newest metadata file (highest ``last-updated-ms``) holds the whole
snapshot log, every schema version and the current schema id, so both views
are a handful of ``explode``s over one small document.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIELD_ID = "parquet.field.id"


def metadata_document(history: DataFrame, *schemas: StructType) -> DataFrame:
    """One row in the form of such a document, from a table's loads (``load_history``; a
    row a load) and its schemas, oldest first, whose fields carry Parquet field ids."""
    at = F.unix_millis(F.to_timestamp("committed_at"))
    number = F.col("sequence_number").cast("long")
    snapshot = F.struct(
        number.alias("snapshot-id"), number.alias("sequence-number"), at.alias("timestamp-ms"),
        F.least(number - 1, F.lit(len(schemas) - 1)).cast("int").alias("schema-id"),
        F.struct("operation", F.col("added_records").cast("string").alias("added-records"),
                 F.col("total_records").cast("string").alias("total-records"),
                 F.lit(None).cast("string").alias("added-data-files")).alias("summary"))
    fields = [F.struct(F.lit(k).alias("schema-id"), F.array(*[
        F.struct(F.lit(f.metadata[FIELD_ID]).alias("id"), F.lit(f.name).alias("name"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.lit(not f.nullable).alias("required"))
        for f in s.fields if FIELD_ID in f.metadata]).alias("fields")) for k, s in enumerate(schemas)]
    return history.agg(
        F.max(at).alias("last-updated-ms"), F.lit(len(schemas) - 1).alias("current-schema-id"),
        F.array(*fields).alias("schemas"), F.sort_array(F.collect_list(snapshot)).alias("snapshots"),
        F.sort_array(F.collect_list(F.struct(number.alias("snapshot-id"), at.alias("timestamp-ms"))))
        .alias("snapshot-log"))


def read_current_metadata(spark: SparkSession, metadata_dir: str,
                          names: str = "*.metadata.json") -> DataFrame:
    """One row: the newest metadata document of the table."""
    docs = spark.read.option("multiLine", True).option("pathGlobFilter", names).json(metadata_dir)
    newest = docs.agg(F.max("`last-updated-ms`").alias("m"))
    return docs.join(newest, docs["`last-updated-ms`"] == newest["m"]).drop("m")


def snapshot_history(meta: DataFrame) -> DataFrame:
    """snapshot id, commit time (UTC), operation and record counts, oldest first."""
    log = meta.select(F.explode("`snapshot-log`").alias("l")).select(
        F.col("l.`snapshot-id`").alias("snapshot_id"),
        F.col("l.`timestamp-ms`").alias("timestamp_ms"))
    snaps = meta.select(F.explode("snapshots").alias("s")).select(
        F.col("s.`snapshot-id`").alias("snapshot_id"),
        F.col("s.`sequence-number`").alias("sequence_number"),
        F.col("s.summary.operation").alias("operation"),
        F.col("s.summary.`added-records`").cast("long").alias("added_records"),
        F.col("s.summary.`total-records`").cast("long").alias("total_records"),
        F.col("s.summary.`added-data-files`").cast("long").alias("added_files"),
        F.col("s.`schema-id`").alias("schema_id"))
    return (log.join(snaps, "snapshot_id", "left")
            .select("sequence_number", "snapshot_id",
                    F.date_format(F.timestamp_millis("timestamp_ms"),
                                  "yyyy-MM-dd HH:mm:ss").alias("committed_at"),
                    "operation", "added_records", "total_records", "added_files", "schema_id")
            .orderBy("timestamp_ms"))


def table_columns(meta: DataFrame) -> DataFrame:
    """Columns of the current schema: (field_id, name, type, required)."""
    cur = meta.select(F.col("`current-schema-id`").alias("cur"),
                      F.explode("schemas").alias("s"))
    return (cur.filter(F.col("s.`schema-id`") == F.col("cur"))
            .select(F.explode("s.fields").alias("f"))
            .select(F.col("f.id").alias("field_id"), F.col("f.name").alias("name"),
                    F.col("f.type").alias("type"), F.col("f.required").alias("required"))
            .orderBy("field_id"))
