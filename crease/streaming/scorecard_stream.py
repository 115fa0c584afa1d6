"""30-ball scorecard on the message stream, with keyed state sharded by offset block.

Balls are grouped by (match, block of ``BLOCK`` offsets), so a match that holds most
balls is spread over many tasks.  The state operator keeps for each block how many
balls it has seen and which (one bit an offset): it numbers new balls inside their
block and drops messages that come again.  State is one row of bounded size a block,
in RocksDB; a micro-batch reads and writes the blocks it touches and no others.

Numbered balls are appended, ``<sink>/balls/batch=<id>``; a batch counts once its job
has ended, and a retried batch rewrites its own folder from the same state.  Reading
adds the ball counts of earlier blocks (one row a block) and ranks the scorecards.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from crease import schema as S
from crease.operators.scorecard import normalised, snapshots
from crease.sources.storage import committed
from crease.streaming.versioned import state_settings

BLOCK = 4096                 # offsets of a match whose balls one state row numbers
BALLS = ("match_id string, block long, block_no long, batter string, runs_off_bat int, "
         "kafka_offset long")

# workers get the processor by value: no installation of this package on them
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BallNumbers(StatefulProcessor):
    """Numbers the balls of one (match, block) in offset order, each offset once."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("block", "balls long, seen binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd
        balls, seen = 0, np.zeros(BLOCK, bool)
        if self.state.exists():
            balls, bits = self.state.get()
            seen = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        batch = pd.concat(list(rows)).drop_duplicates("kafka_offset").sort_values("kafka_offset")
        place = (batch["kafka_offset"] % BLOCK).to_numpy()
        batch = batch[~seen[place]]
        seen[place] = True
        self.state.update((balls + len(batch), np.packbits(seen).tobytes()))
        if len(batch):
            yield pd.DataFrame({
                "match_id": key[0], "block": int(key[1]), "block_no": balls + 1 + np.arange(len(batch)),
                "batter": batch["batter"].to_numpy(), "runs_off_bat": batch["runs_off_bat"].to_numpy(),
                "kafka_offset": batch["kafka_offset"].to_numpy()})


def numbered_balls(messages: DataFrame) -> DataFrame:
    """Stream of balls -> balls numbered inside their (match, block)."""
    rows = normalised(messages).select(
        "match_id", F.floor(F.col("kafka_offset") / BLOCK).alias("block"), "batter",
        "runs_off_bat", "kafka_offset")
    return rows.groupBy("match_id", "block").transformWithStateInPandas(
        BallNumbers(), outputStructType=BALLS, outputMode="append", timeMode="none")


def balls_sink(base: str):
    """foreachBatch callback: a micro-batch's numbered balls as a folder of its own."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{base}/balls/batch={batch_id}")
    return sink


def start_scorecard_stream(messages: DataFrame, sink_path: str, checkpoint: str,
                           trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Start the query; bound its micro-batches at the source (``max_offsets``,
    ``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``)."""
    with state_settings(messages.sparkSession, partitions):
        return (numbered_balls(messages).writeStream.outputMode("append")
                .foreachBatch(balls_sink(sink_path.rstrip("/")))
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "10 seconds"}))
                .start())


def read_balls(spark: SparkSession, sink_path: str) -> DataFrame:
    """The numbered balls of all complete micro-batches."""
    base = f"{sink_path.rstrip('/')}/balls"
    folders = [f"{base}/batch={b}" for b in committed(spark, base, "batch")]
    return spark.read.schema(BALLS).parquet(*folders) if folders else spark.createDataFrame([], BALLS)


def read_scorecards(spark: SparkSession, sink_path: str, every: int = S.SCORECARD_EVERY,
                    top: int = S.SCORECARD_TOP) -> DataFrame:
    """Scorecards of all complete micro-batches, as :func:`scorecard_every` gives them."""
    balls = read_balls(spark, sink_path).withColumn("shard", F.struct("match_id", "block"))
    blocks = balls.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    of_match = Window.partitionBy("shard.match_id")
    earlier = of_match.orderBy("shard.block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                           F.sum("n").over(of_match).alias("all"))
    sums = (balls.join(blocks, "shard")
            .groupBy("match_id", "batter",
                     F.expr(f"(before + block_no + {every - 1}) div {every}").alias("snap"))
            .agg(F.sum("runs_off_bat").alias("s_runs"), F.count(F.lit(1)).alias("s_balls"),
                 F.min("kafka_offset").alias("s_first"),
                 F.max(F.expr(f"all div {every}")).alias("last_snap")))
    return snapshots(sums, every, top)
