"""Versioned result tables for micro-batch sinks.

Each micro-batch writes a complete new version ``<base>/v=<batch_id>``.  The
current version is the highest one whose job ended (its ``_SUCCESS`` file is
there): nothing is ever rewritten in place, so a crash at any point leaves the
version before it, and readers never see a half-written one.  A retried batch
rewrites its own version.  Versions before the previous one are deleted.
"""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.sources.storage import committed, delete

KEEP_VERSIONS = 2             # the current one, and the one a reader may still scan
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_version(df: DataFrame, base: str, version: int) -> None:
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{base}/v={version}")
    for old in committed(spark, base, "v")[:-KEEP_VERSIONS]:
        delete(spark, f"{base}/v={old}")


def latest_version(spark: SparkSession, base: str, before: int | None = None) -> int | None:
    """The highest complete version (below ``before``)."""
    done = [v for v in committed(spark, base, "v") if before is None or v < before]
    return done[-1] if done else None


def read_latest(spark: SparkSession, base: str, schema=None, before: int | None = None) -> DataFrame | None:
    v = latest_version(spark, base, before)
    if v is None:
        return None
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(f"{base}/v={v}")


def merge_latest(previous: DataFrame | None, changes: DataFrame, keys: list[str],
                 version_col: str = "batch_id") -> DataFrame:
    """Keyed upsert: for each key keep the row with the highest version.

    ``max_by`` inside one aggregate: partial per partition, at most two rows
    per key meet in the final aggregate, so no key can be hot.
    """
    rows = changes if previous is None else previous.unionByName(changes)
    others = [c for c in rows.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    return (rows.groupBy(*keys).agg(F.max_by(packed, F.col(version_col)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]))


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """Settings a new stream takes over at its first start: RocksDB state (state
    larger than memory spills to disk and is saved as increments), and the state
    partition count (``None``: the session's), which the checkpoint keeps for good.
    """
    new = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    if partitions is not None:
        new["spark.sql.shuffle.partitions"] = str(partitions)
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
