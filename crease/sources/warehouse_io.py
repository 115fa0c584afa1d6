"""Warehouse sink and read-back.

Target is either ``{"jdbc": url, "properties": {...}}`` -- each table is
replaced with ``mode("overwrite").option("truncate", True)``, written in
parallel by the executors, never row by row from the driver -- or a base
path.  Under a path all tables are one refresh: each is written to
``<path>/refresh=<n>/<table>``, and then one small table, the manifest, names the
folder of every table.  Readers go by the latest complete manifest, so they see all
tables of a refresh or none, whatever a crash leaves behind.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schema as S
from crease.sources.storage import committed, delete, started


MANIFEST = "table_name string, folder string, refreshed_at timestamp"
KEEP = 2                     # refreshes: the current one, and the one a reader may still scan


def refresh_tables(tables: dict[str, DataFrame], target: dict) -> None:
    """Full refresh of every table, stamped with one ``updated_at``.

    Column types follow the DataFrame (counts and sums are BIGINT).
    A path target is published as a whole (see above).  JDBC truncate + insert is per
    table (not one transaction across tables); for an atomic swap write staging tables
    and rename them in one transaction on the database side.  ``numPartitions`` in the
    target's properties caps concurrent connections per table (Spark coalesces to it).
    """
    spark = next(iter(tables.values())).sparkSession
    now = F.lit(spark.range(1).select(F.current_timestamp()).first()[0])
    base, n = target.get("path", "").rstrip("/"), 0
    if base:
        n = max(started(spark, base, "refresh"), default=0) + 1

    def write(name: str, df: DataFrame) -> None:
        out = df.withColumn("updated_at", now)
        if "jdbc" in target:
            w = out.write.mode("overwrite").option("truncate", "true")
            w.jdbc(target["jdbc"], name, properties=target.get("properties", {}))
        else:
            out.write.parquet(f"{base}/refresh={n}/{name}")

    # the tables are small aggregates: submit their jobs together so the
    # cluster runs them side by side instead of one idle-heavy job at a time
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        for f in [pool.submit(write, t, d) for t, d in tables.items()]:
            f.result()
    if base:
        _publish(spark, base, n, list(tables), now)


def _publish(spark: SparkSession, base: str, n: int, names: list[str], now) -> None:
    """Write the manifest of refresh ``n``: its ``_SUCCESS`` file is the commit."""
    # tables of earlier refreshes that this one left out keep their folders
    rows = spark.createDataFrame([(t, f"refresh={n}/{t}") for t in names], "table_name string, folder string")
    rows = rows.withColumn("refreshed_at", now)
    before = manifest(spark, base)
    kept = before.join(rows.select("table_name"), "table_name", "left_anti").select(*rows.columns)
    rows.unionByName(kept).coalesce(1).write.parquet(f"{base}/manifest/n={n}")
    done = committed(spark, f"{base}/manifest", "n")
    named = {r["folder"].split("/")[0] for m in done[-KEEP:]
             for r in _manifest(spark, base, m).select("folder").collect()}     # a row a table
    for old in started(spark, base, "refresh"):
        if old < done[-KEEP:][0] and f"refresh={old}" not in named:
            delete(spark, f"{base}/refresh={old}")


def _manifest(spark: SparkSession, base: str, n: int) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{base}/manifest/n={n}")


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """table_name, folder and refreshed_at of every published table."""
    done = committed(spark, f"{base.rstrip('/')}/manifest", "n")
    return _manifest(spark, base.rstrip("/"), done[-1]) if done else spark.createDataFrame([], MANIFEST)


def read_table(spark: SparkSession, target: dict, name: str) -> DataFrame:
    if "jdbc" in target:
        return spark.read.jdbc(target["jdbc"], name, properties=target.get("properties", {}))
    base = target["path"].rstrip("/")
    row = manifest(spark, base).filter(F.col("table_name") == name).first()
    if row is None:
        raise ValueError(f"table {name} was never published under {base}")
    return spark.read.parquet(f"{base}/{row['folder']}")


def verify_top_batters(spark: SparkSession, target: dict, n: int = S.READBACK_N) -> DataFrame:
    return (read_table(spark, target, "agg_batter_stats")
            .select("batter_name", "total_runs", "balls_faced", "strike_rate")
            .orderBy(F.col("total_runs").desc(), F.col("batter_name").asc()).limit(n))


def verify_top_bowlers(spark: SparkSession, target: dict, n: int = S.READBACK_N) -> DataFrame:
    return (read_table(spark, target, "agg_bowler_stats")
            .select("bowler_name", "wickets", "economy_rate")
            .orderBy(F.col("wickets").desc(), F.col("bowler_name").asc()).limit(n))
