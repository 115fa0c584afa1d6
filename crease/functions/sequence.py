"""Order-dependent numbering without sending a whole group to one task.

A plain ``row_number().over(Window.partitionBy(k).orderBy(o))`` sorts every
row of a key in one task; one hot match or batter holding a third of the
input would make that task the whole job.  The helpers here split each group
into bounded blocks, aggregate per block, prefix-sum the (small) block table
and add the in-block running value -- the classic two-level parallel scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.session import scratch_path

DEFAULT_BLOCK = 1 << 16


def running_totals(df: DataFrame, keys: list[str], order_col: str,
                   measures: dict[str, Column], block_width: int = DEFAULT_BLOCK,
                   with_totals: bool = False, group_mins: dict[str, Column] | None = None,
                   next_col: str | None = None) -> DataFrame:
    """Add cumulative sums of ``measures`` per ``keys`` in ``order_col`` order.

    ``order_col`` must be integral and unique within a group (a message
    offset, a snapshot number), so a block of ``block_width`` values
    holds at most ``block_width`` rows of any group.  Rows up to and
    including the current one are summed.  Keys may be null.

    From the same block table (no extra pass) each row can also get:

    * ``<measure>_total`` (``with_totals``): the group's grand total;
    * ``group_mins``: the group-wide minimum of each given expression;
    * ``next_col``: the next ``order_col`` value in the group (null for the
      last row) -- a ``lead`` that crosses block boundaries.

    Plan: one partial/final aggregate to (group, block) rows, a window over
    that block table (size <= rows / block_width per group), then one shuffle
    of the input on (key, block) shared by the join and the in-block window.
    The key is one struct of the key columns: equality and grouping of structs
    treat nulls inside as equal, so join and window ask for the same partitioning.
    """
    group_mins = group_mins or {}
    cols = df.columns
    b = (df.withColumn("_rt_key", F.struct(*keys))
         .withColumn("_rt_blk", F.expr(
             f"({order_col} - pmod({order_col}, {block_width})) div {block_width}")))
    for name, expr in measures.items():
        b = b.withColumn(f"_rt_m_{name}", expr)
    for name, expr in group_mins.items():
        b = b.withColumn(f"_rt_g_{name}", expr)
    per_block = b.groupBy("_rt_key", "_rt_blk").agg(
        *[F.sum(f"_rt_m_{n}").alias(f"_rt_s_{n}") for n in measures],
        *[F.min(f"_rt_g_{n}").alias(f"_rt_gm_{n}") for n in group_mins],
        F.min(order_col).alias("_rt_first"))
    ordered = Window.partitionBy("_rt_key").orderBy("_rt_blk")
    wb = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_rt_key")
    extra = []
    if with_totals:
        extra += [F.sum(f"_rt_s_{n}").over(whole).alias(f"{n}_total") for n in measures]
    extra += [F.min(f"_rt_gm_{n}").over(whole).alias(n) for n in group_mins]
    if next_col:
        extra.append(F.lead("_rt_first").over(ordered).alias("_rt_next_blk"))
    base = per_block.select(
        "_rt_key", "_rt_blk",
        *[F.coalesce(F.sum(f"_rt_s_{n}").over(wb), F.lit(0)).alias(f"_rt_b_{n}") for n in measures],
        *extra)
    joined = b.join(base, ["_rt_key", "_rt_blk"])
    in_block = Window.partitionBy("_rt_key", "_rt_blk").orderBy(order_col)
    wr = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = [*[F.col(c) for c in cols],
           *[(F.col(f"_rt_b_{n}") + F.sum(f"_rt_m_{n}").over(wr)).alias(n) for n in measures],
           *[F.col(f"{n}_total") for n in measures if with_totals],
           *[F.col(n) for n in group_mins]]
    if next_col:
        out.append(F.coalesce(F.lead(order_col).over(in_block), F.col("_rt_next_blk"))
                   .alias(next_col))
    return joined.select(*out)


def sequential_ids(df: DataFrame, order_cols: list[str], id_col: str = "id",
                   num_partitions: int | None = None) -> DataFrame:
    """Number rows 1..n in ``order_cols`` order (rows should be distinct on them).

    Range-partition by the order columns, number rows inside each range
    partition, then add the row count of all earlier partitions.  The ranges are
    sampled, so planning them twice may cut them differently: the rows are written
    once, with their partition number, and both the counts and the numbering read
    that table.  The count table has one row per partition (a proven bound), so it
    is broadcast.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranged")
    (df.repartitionByRange(n, *order_cols).withColumn("_sq_pid", F.spark_partition_id())
     .write.parquet(path))
    ranged = spark.read.parquet(path)
    local = ranged.withColumn(
        "_sq_local", F.row_number().over(Window.partitionBy("_sq_pid").orderBy(*order_cols)))
    counts = ranged.groupBy("_sq_pid").agg(F.count(F.lit(1)).alias("_sq_n"))
    # at most n rows: the single-partition window below is bounded by the partition count
    offsets = counts.select(
        "_sq_pid",
        F.coalesce(F.sum("_sq_n").over(Window.orderBy("_sq_pid")
                                       .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_sq_base"))
    return (local.join(F.broadcast(offsets), "_sq_pid")
            .withColumn(id_col, (F.col("_sq_base") + F.col("_sq_local")).cast("long"))
            .drop("_sq_pid", "_sq_local", "_sq_base"))
