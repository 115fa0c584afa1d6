"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, gone: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage at a table that survives lost executors; every later read
    sees the same rows in the same files.  The path is added to ``gone``, the list
    of what the caller deletes when no later plan reads it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if gone is not None:
        gone.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no later plan reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def delete_all(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        delete_path(spark, paths.pop())


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``, also where a column has a dot in its name: the function
    sees the columns as c0, c1, ... and returns those of ``schema`` in its order."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(function, schema)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (what ``--py-files`` does).

    Workers then import the operators by name, so per-process caches live as
    long as a worker.  Spark itself copies the archive to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_crease_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="crease-py-"), "crease.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("crease", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._crease_shipped = True


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, also those with a dot or a backtick in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def row_hash(df: DataFrame, seed: int) -> Column:
    """64 bits of a whole row; which columns are null counts, too."""
    return F.xxhash64(F.lit(seed), *[x for c in own_columns(df) for x in (c.isNull(), c)])


BITMAP_WORDS = 1 << 20       # of 64 bits: 8 MB, however many keys go in


def hash_bitmap(keys: DataFrame, h: Column) -> DataFrame:
    """(b_word, b_bits): which values of 26 bits of the long ``h`` occur in ``keys``.

    At most ``BITMAP_WORDS`` rows whatever the keys' number, so it may be broadcast.
    """
    return (keys.select(_word(h).alias("b_word"), _bit(h).alias("b_bit"))
            .groupBy("b_word").agg(F.bit_or("b_bit").alias("b_bits")))


def split_by_bitmap(rows: DataFrame, h: Column, bitmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be among the keys, rows that are surely not), without a shuffle.

    The first part holds false positives, the more the fuller the bitmap; an exact
    join on it decides.
    """
    marked = rows.select("*", _word(h).alias("b_own"), _bit(h).alias("b_bit")).join(
        F.broadcast(bitmap), F.col("b_own") == F.col("b_word"), "left")
    hit = F.coalesce(F.col("b_bits").bitwiseAND(F.col("b_bit")) != 0, F.lit(False))
    own = [F.col(c) for c in rows.columns]
    return marked.filter(hit).select(*own), marked.filter(~hit).select(*own)


def _word(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BITMAP_WORDS.bit_length() + 1)


def _bit(h: Column) -> Column:
    return F.call_function(
        "shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63).cast("long")).cast("int"))
