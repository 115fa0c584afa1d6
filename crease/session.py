"""Session construction and shared-storage scratch paths."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "crease", driver_memory: str | None = None) -> SparkSession:
    """Session with the settings every job here relies on.

    * UTC session zone: match ids are dates cast from timestamps.
    * AQE on: coalesces small shuffles, splits skewed join partitions.
    * ``spark.sql.shuffle.partitions`` is an upper bound that AQE coalesces;
      on a cluster set it from the input size (~128 MB per partition).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:   # local mode: the driver JVM is the executor (only before it starts)
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only on a local master (a
    laptop or a unit test) a private folder is made when it is unset; on a cluster
    that is an error, since executors would not see such a folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="crease-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for tables a query writes and reads back (lake, warehouse, stream
    sinks and checkpoints), so that every executor and a restarted driver see
    the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/crease-scratch/{name}-{uuid.uuid4().hex[:12]}"
