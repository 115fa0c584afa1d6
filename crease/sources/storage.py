"""Names of folders in whatever store Spark writes to (no data is read)."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; none when nothing exists."""
    p, fs = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def committed(spark: SparkSession, base: str, key: str) -> list[int]:
    """Numbers n of the folders ``<base>/<key>=<n>`` whose writing job ended."""
    done = matching(spark, f"{base.rstrip('/')}/{key}=*/_SUCCESS")
    return sorted(int(p.split("/")[-2].split("=", 1)[1]) for p in done)


def started(spark: SparkSession, base: str, key: str) -> list[int]:
    """Numbers of all such folders, of interrupted jobs too."""
    return sorted(int(p.rsplit("=", 1)[1]) for p in matching(spark, f"{base.rstrip('/')}/{key}=*"))
