"""The lake table: 14-column delivery rows as Parquet, one folder a load.

``<table>/load_id=<n>/batting_team=<team>``: every load attempt writes a folder of
its own number, never into another one, and counts once its job has ended (its
``_SUCCESS`` file is there).  What an interrupted attempt left is never read, and a
retry takes the next number.  Loads keep the path of their source document, so an
idempotent append skips sources that are loaded already.

Columns have ids, written to the files as Parquet field ids, and readers resolve them by
id: a later load may have more columns (older loads give nulls), or may have renamed one
(older loads give its values under the new name).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease import schema as S
from crease.functions import count_if, is_present
from crease.session import scratch_path
from crease.sources.storage import committed, delete, started
from crease.sources.table_metadata import FIELD_ID

SOURCE_COL = "file_path"
SOURCE_ID = 1_000_000        # field id of the source path, out of the columns' way
_SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
                "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}


def lake_rows(deliveries: DataFrame) -> DataFrame:
    """Project deliveries onto the lake columns (uncleaned: runs 7 and blank names
    stay), with the source document's path if they carry one.

    Null names stay null; an empty wicket kind becomes null; the boundary
    flag is runs >= 4 (fives and sixes included), the six flag runs == 6.
    """
    runs = F.col("runs_off_bat")
    return deliveries.select(
        F.col("match_id").cast("string").alias("match_id"),
        F.col("match_id").cast("string").alias("match_date"),
        F.col("venue").cast("string").alias("venue"),
        F.col("batting_team").cast("string").alias("batting_team"),
        F.col("batter").cast("string").alias("batter"),
        F.col("bowler").cast("string").alias("bowler"),
        F.col("over_num").cast("int").alias("over_num"),
        F.col("ball_num").cast("int").alias("ball_num"),
        runs.cast("int").alias("runs_off_bat"),
        F.col("total_runs").cast("int").alias("total_runs"),
        F.col("extras").cast("int").alias("extras"),
        F.nullif(F.col("wicket"), F.lit("")).alias("wicket_kind"),
        (runs >= 4).alias("is_boundary"),
        (runs == 6).alias("is_six"),
        *[F.col(c) for c in (SOURCE_COL,) if c in deliveries.columns])


def lake_schema(*added: tuple[str, str], renamed: dict[str, str] | None = None) -> T.StructType:
    """The lake's columns with their ids, further (name, type) columns under the next
    ids, the source path and load.  ``renamed`` gives columns new names, not new ids."""
    new = renamed or {}
    fields = [*S.LAKE_FIELDS, *[(len(S.LAKE_FIELDS) + 1 + k, n, t) for k, (n, t) in enumerate(added)]]
    return T.StructType(
        [T.StructField(new.get(n, n), _SPARK_TYPES[t], metadata={FIELD_ID: i}) for i, n, t in fields]
        + [T.StructField(SOURCE_COL, T.StringType(), metadata={FIELD_ID: SOURCE_ID}),
           T.StructField("load_id", T.LongType())])


def append_load(rows: DataFrame, path: str, partition_col: str = S.LAKE_PARTITION,
                schema: T.StructType | None = None) -> int:
    """Append rows as a load of its own; returns its number.  A rerun appends again.

    Columns get the ids that ``schema`` gives their names; a column without a name there
    is a mistake, not a new column.
    """
    spark = rows.sparkSession
    ids = {f.name: f.metadata for f in (schema or lake_schema()).fields}
    unknown = [c for c in rows.columns if c not in ids]
    if unknown:
        raise ValueError(f"columns without an id in the lake's schema: {unknown}")
    rows = rows.select(*[F.col(c).alias(c, metadata=ids[c]) for c in rows.columns])
    load = max(started(spark, path, "load_id"), default=0) + 1
    # rebalance on the partition column: AQE sizes the files and splits a hot team
    # over several writers instead of one task a team
    (rows.hint("rebalance", partition_col)
     .write.partitionBy(partition_col).parquet(f"{path.rstrip('/')}/load_id={load}"))
    return load


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None,
         as_of: int | None = None) -> DataFrame:
    """All complete loads (up to ``as_of``) under one schema; older loads give null
    for columns they lack.  Filters on ``batting_team`` and ``load_id`` prune folders."""
    schema = schema or lake_schema()
    spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
    spark.conf.set("spark.sql.parquet.fieldId.read.ignoreMissing", "true")   # loads without any ids
    loads = [n for n in committed(spark, path, "load_id") if as_of is None or n <= as_of]
    if not loads:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    return (spark.read.schema(schema).option("basePath", base)
            .parquet(*[f"{base}/load_id={n}" for n in loads]))


def append_new(rows: DataFrame, path: str, key: str = SOURCE_COL, schema: T.StructType | None = None) -> int:
    """Idempotent append: drop incoming rows of sources that are loaded already.

    Left-anti join on the source path, one column of the table, distinct; two
    matches of one date are two sources.  The list of loaded sources is written first:
    its size is known when the join is planned, so that the rows are shuffled for it
    only if the list is too large to be sent to every task.
    """
    spark = rows.sparkSession
    listed = scratch_path(spark, "lake-sources")
    loaded = scan(spark, path).select(F.col(key).alias("loaded_key")).distinct()
    loaded.write.parquet(listed)
    loaded = spark.read.schema(loaded.schema).parquet(listed)
    new = rows.join(loaded, rows[key].eqNullSafe(F.col("loaded_key")), "left_anti")
    load = append_load(new, path, schema=schema)
    delete(spark, listed)
    return load


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """Loads in order: when they ended (UTC, seconds), rows added, rows so far.

    Counts come from the files' footers; the running total is over one row a load.
    """
    rows = scan(spark, path).select("load_id", F.col("_metadata.file_modification_time").alias("at"))
    loads = rows.groupBy("load_id").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("added_records"))
    return loads.select(
        F.col("load_id").alias("sequence_number"),
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("committed_at"),
        F.lit("append").alias("operation"), "added_records",
        F.expr("sum(added_records) OVER (ORDER BY load_id)").alias("total_records"))


def column_profile(lake_df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """(id, name, type, n_values): the table's columns and how many rows have a value.

    One aggregate over the table, then one row a column.
    """
    fields = [f for f in (schema or lake_schema()).fields if f.name not in (SOURCE_COL, "load_id")]
    counts = lake_df.agg(*[F.count(f.name).alias(f.name) for f in fields])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.metadata[FIELD_ID]).alias("id"), F.lit(f.name).alias("name"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n_values"))
        for f in fields])))


def lake_quick_stats(lake_df: DataFrame) -> DataFrame:
    """Rows, boundaries, sixes, wickets -- one global partial aggregate."""
    return lake_df.agg(F.count(F.lit(1)).alias("total_rows"),
                       count_if(F.col("is_boundary")).alias("boundaries"),
                       count_if(F.col("is_six")).alias("sixes"),
                       count_if(is_present("wicket_kind")).alias("wickets"))


def lake_teams(lake_df: DataFrame) -> DataFrame:
    """Distinct batting teams in name order."""
    return lake_df.select("batting_team").distinct().orderBy("batting_team")
