"""Order-dependent scorecards over the ball stream (batch form).

Input: ball rows with ``match_id``, ``kafka_offset`` (unique, arrival
order), ``batter``, ``runs_off_bat``, ``wicket``, ``over_num``, ``ball_num``.
Uncleaned: every message counts; a missing batter is ``'unknown'``.
Counters run per match (one match is one ordered partition of the topic).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease import schema as S
from crease.functions import is_present, over_ball, rate, rate_or_zero, running_totals
from crease.functions.sequence import DEFAULT_BLOCK
from crease.session import scratch_path

SNAP_BLOCK = 4096     # block width of the per-batter scan over intervals
CONTEST = 8           # snapshots for which the contenders are chosen at once


def normalised(df: DataFrame) -> DataFrame:
    return (df.withColumn("batter", F.coalesce(F.col("batter"), F.lit(S.UNKNOWN)))
            .withColumn("runs_off_bat", F.coalesce(F.col("runs_off_bat"), F.lit(0))))


def scorecard_final(df: DataFrame) -> DataFrame:
    """All batters of each match: runs, balls, strike rate, position.

    Position = runs desc, then first appearance.  The ranking window runs on
    the aggregate (one row per match and batter), not on the balls.
    """
    agg = (normalised(df).groupBy("match_id", "batter")
           .agg(F.sum("runs_off_bat").alias("runs"),
                F.count(F.lit(1)).alias("balls"),
                F.min("kafka_offset").alias("first_offset"))
           .withColumn("strike_rate", rate_or_zero("runs", "balls", 100, 1)))
    w = Window.partitionBy("match_id").orderBy(F.col("runs").desc(), F.col("first_offset").asc())
    return agg.withColumn("position", F.row_number().over(w).cast("long"))


def fall_of_wickets(df: DataFrame, block_width: int | None = None) -> DataFrame:
    """Wickets in arrival order per match, numbered, with the ``over.ball`` label."""
    w = (normalised(df).filter(is_present("wicket"))
         .select("match_id", "kafka_offset", "batter", F.col("wicket").alias("kind"),
                 over_ball("over_num", "ball_num").alias("over_ball")))
    return running_totals(w, ["match_id"], "kafka_offset", {"wicket_no": F.lit(1)},
                          block_width=block_width or DEFAULT_BLOCK)


def interval_totals(balls: DataFrame, every: int, block_width: int | None = None) -> DataFrame:
    """Balls -> (match, batter, interval) sums; an interval is ``every`` balls of a match.

    The ball number per match is a distributed running count (no per-match sort).
    """
    d = running_totals(normalised(balls).select("match_id", "kafka_offset", "batter", "runs_off_bat"),
                       ["match_id"], "kafka_offset", {"ball_no": F.lit(1)},
                       block_width=block_width or DEFAULT_BLOCK, with_totals=True)
    return (d.withColumn("snap", F.expr(f"(ball_no + {every - 1}) div {every}"))
            .withColumn("last_snap", F.expr(f"ball_no_total div {every}"))
            .groupBy("match_id", "batter", "snap")
            .agg(F.sum("runs_off_bat").alias("s_runs"),
                 F.count(F.lit(1)).alias("s_balls"),
                 F.min("kafka_offset").alias("s_first"),
                 F.max("last_snap").alias("last_snap")))


def _merged(x: str, y: str, top: int) -> str:
    """SQL: the best ``top`` of two lists of (lost, first_offset, batter, balls), by batter.

    ``lost`` is minus the runs, so that the natural order of the structs ranks them; of
    two entries of one batter the later one has more runs or more balls.
    """
    both = f"concat({x}, coalesce({y}, array()))"
    return (f"slice(array_sort(array_distinct(filter({both}, a -> NOT exists({both}, b -> b.batter <=> a.batter "
            f"AND (b.lost < a.lost OR (b.lost = a.lost AND b.balls > a.balls)))))), 1, {top})")


def leaders_before(totals: DataFrame, top: int) -> DataFrame:
    """(match, blk, leaders): the ``top`` batters of the match before each block of snapshots.

    Totals never fall, so a batter among the leaders after a block was among the best of
    the last block that he batted in: the best of each block are enough.  They are merged
    by doubling steps (each takes in the list of 1, 2, 4, ... blocks before) over one row
    a block; a block's leaders are those after the block before.
    """
    last = totals.groupBy("match_id", "blk", "batter").agg(
        F.max(F.struct("snap", "runs", "balls")).alias("t"), F.min("first_offset").alias("first_offset"))
    last = last.select("match_id", "blk", "batter", (-F.col("t.runs")).alias("lost"), "first_offset",
                       F.col("t.balls").alias("balls")).repartition("match_id", "blk")
    rank = Window.partitionBy("match_id", "blk").orderBy("lost", "first_offset")
    best = (last.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= top)
            .groupBy("match_id", "blk")
            .agg(F.collect_list(F.struct("lost", "first_offset", "batter", "balls")).alias("leaders")))
    steps = int(totals.agg(F.max("blk")).first()[0] or 0).bit_length()
    in_order = Window.partitionBy("match_id").orderBy("blk")
    for k in range(steps):
        best = best.withColumn("earlier", F.lag("leaders", 1 << k).over(in_order)).withColumn(
            "leaders", F.expr(_merged("leaders", "earlier", top)))
    return best.select("match_id", "blk", F.lag("leaders", 1).over(in_order).alias("leaders"))


def contenders(per_snap: DataFrame, top: int, block_width: int | None = None) -> DataFrame:
    """(match, batter, totals, snapshots from .. upto) of all who can be among the ``top``.

    Only leaders before a block of ``CONTEST`` snapshots, and who bats in the block from
    then on, can be among the best of its snapshots: everyone else had ``top`` batters
    ahead at the block's start, and still has.  So rows grow with the balls, for any number of
    batters a match has.
    """
    spark = per_snap.sparkSession
    cum = running_totals(
        per_snap.filter(F.col("snap") <= F.col("last_snap")), ["match_id", "batter"], "snap",
        {"runs": F.col("s_runs"), "balls": F.col("s_balls")},
        block_width=block_width or SNAP_BLOCK, group_mins={"first_offset": F.col("s_first")})
    path = scratch_path(spark, "scorecard-totals")
    (cum.select("match_id", "batter", "snap", "last_snap", "runs", "balls", "first_offset",
                F.expr(f"(snap - 1) div {CONTEST}").alias("blk")).write.parquet(path))
    totals = spark.read.parquet(path)
    lasts = totals.groupBy("match_id", "blk").agg(F.max("last_snap").alias("last_snap"))
    # a match's blocks all have balls, and both tables have one row for each
    leaders = (leaders_before(totals, top).select("match_id", "blk", F.inline("leaders"))
               .withColumn("block", F.struct("match_id", "blk"))
               .join(lasts.select(F.struct("match_id", "blk").alias("block"), "last_snap"), "block")
               .select("match_id", "batter", (F.col("blk") * CONTEST).alias("snap"), "last_snap",
                       (-F.col("lost")).alias("runs"), "balls", "first_offset", "blk"))
    rows = totals.select(*leaders.columns).unionByName(leaders)
    own = Window.partitionBy("match_id", "blk", "batter").orderBy("snap")
    until = F.least((F.col("blk") + 1) * CONTEST, F.col("last_snap"))
    return (rows.repartition("match_id", "blk", "batter")
            .withColumn("upto", F.least(F.coalesce(F.lead("snap").over(own) - 1, until), until))
            .withColumn("from", F.greatest("snap", F.col("blk") * CONTEST + 1))
            .filter(F.col("from") <= F.col("upto")))


def snapshots(per_snap: DataFrame, every: int, top: int, block_width: int | None = None) -> DataFrame:
    """(match, batter, interval) sums -> the top batters after every interval.

    Ranking is inside (match, snapshot) after an explicit repartition on both keys, so the
    snapshots of one long match spread over many tasks.
    """
    held = (contenders(per_snap, top, block_width)
            .withColumn("snapshot", F.explode(F.sequence("from", "upto")))
            .repartition("match_id", "snapshot"))
    wr = Window.partitionBy("match_id", "snapshot").orderBy(F.col("runs").desc(),
                                                            F.col("first_offset").asc())
    return (held.withColumn("position", F.row_number().over(wr).cast("long"))
            .filter(F.col("position") <= top)
            .select("match_id", (F.col("snapshot") * every).cast("long").alias("after_balls"),
                    "position", "batter", "runs", "balls",
                    rate("runs", "balls", 100, 1).alias("strike_rate")))


def scorecard_every(df: DataFrame, every: int = S.SCORECARD_EVERY, top: int = S.SCORECARD_TOP,
                    block_width: int | None = None) -> DataFrame:
    """After every ``every`` balls of a match, the top ``top`` batters so far.

    Ranked rows grow with the balls alone (:func:`contenders`), not with batters times
    snapshots.
    ``block_width`` (tests) sets the block size of both scans.
    """
    return snapshots(interval_totals(df, every, block_width), every, top, block_width)
