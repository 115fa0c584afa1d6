"""Warehouse views kept up to date load by load.

A load is the deliveries of some source documents.  It is aggregated once, per source
and key, and its partial rows are stored, ``<base>/load=<n>/<view>``; the source list is
written last and completes the load.  Reading a view adds up the partial rows of each
source's latest load: a source that is loaded again replaces what it had added before,
and no delivery is ever read twice.  Partial rows are keyed by source, so a view grows
with the documents (a match has some tens of batters), not with the deliveries.

Distinct match dates per venue are kept in two forms: exactly, from the partial rows of
the match view, and as one HyperLogLog sketch a venue and load, united when read.  A
sketch cannot forget: a replaced source's dates stay in it until its load is dropped.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schema as S
from crease.functions import count_if, is_present, phase, rate, rate_or_zero
from crease.session import scratch_path
from crease.sources.storage import delete, matching, started

SOURCE = "file_path"
SKETCH_BITS = 12             # 4,096 registers: relative standard error 1.04 / 64

# what the views read of a delivery
READ = (SOURCE, "match_id", "venue", "batting_team", "batter", "bowler", "over_num", "runs_off_bat",
        "total_runs", "wicket")
SUMS = ("runs", "balls", "wickets", "fours", "sixes")


def _views(rows: DataFrame) -> dict[str, DataFrame]:
    """The partial rows of one load: per source and key, all sums a view may need."""
    bat, given = F.col("runs_off_bat"), F.col("total_runs")

    def partial(df: DataFrame, keys: list[str], runs=bat) -> DataFrame:
        return df.groupBy(SOURCE, *keys).agg(
            F.sum(runs).alias("runs"), F.count(F.lit(1)).alias("balls"),
            count_if(is_present("wicket")).alias("wickets"),
            count_if(bat == 4).alias("fours"), count_if(bat == 6).alias("sixes"))

    phased = rows.withColumn("phase", phase("over_num", S.PHASE_SHORT))
    return {
        "batters": partial(rows.filter(is_present("batter")), ["batter"]),
        "bowlers": partial(rows.filter(is_present("bowler")), ["bowler"], given),
        "phases": partial(phased.filter("phase IS NOT NULL"), ["batting_team", "phase"]),
        "matches": partial(rows, ["match_id", "venue"]),
        "venue_dates": rows.groupBy("venue").agg(
            F.hll_sketch_agg(F.col("match_id"), F.lit(SKETCH_BITS)).alias("dates")),
    }


def add_load(deliveries: DataFrame, base: str, sources: DataFrame | None = None) -> int:
    """Aggregate and store one load; returns its number.

    ``sources`` (one column, the paths) names the load's documents when some may hold
    no delivery any more; else they are those of the deliveries.
    The deliveries are read once and staged, so that each view scans its own columns
    instead of reading and deriving the load again.  The views' jobs run side by side; the
    source list completes the load, so that an interrupted one is never read and a retry
    takes the next number.
    """
    spark, base = deliveries.sparkSession, base.rstrip("/")
    n = max(started(spark, base, "load"), default=0) + 1
    staged = scratch_path(spark, "load-rows")
    rows = deliveries.select(*READ)
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    views = _views(rows)
    with ThreadPoolExecutor(max_workers=len(views)) as pool:
        for f in [pool.submit(v.write.parquet, f"{base}/load={n}/{name}") for name, v in views.items()]:
            f.result()
    named = rows.select(SOURCE) if sources is None else sources.toDF(SOURCE)
    named.distinct().write.parquet(f"{base}/load={n}/sources")
    delete(spark, staged)
    return n


def _loads(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the complete loads: those whose source list is there."""
    done = matching(spark, f"{base.rstrip('/')}/load=*/sources/_SUCCESS")
    return sorted(int(p.split("/")[-3].split("=", 1)[1]) for p in done)


def _read(spark: SparkSession, base: str, view: str) -> DataFrame:
    """The rows of a view from all complete loads, with their load's number."""
    base = base.rstrip("/")
    parts = [f"{base}/load={n}/{view}" for n in _loads(spark, base)]
    if not parts:
        raise ValueError(f"no complete load under {base}")
    return spark.read.option("basePath", base).parquet(*parts)


def current(spark: SparkSession, base: str, view: str) -> DataFrame:
    """A view's partial rows of each source's latest load."""
    latest = _read(spark, base, "sources").groupBy(F.col(SOURCE).alias("s")).agg(F.max("load").alias("l"))
    return (_read(spark, base, view)
            .join(latest, F.col(SOURCE).eqNullSafe(F.col("s")) & (F.col("load") == F.col("l")), "left_semi")
            .drop("load"))


def _totals(spark: SparkSession, base: str, view: str, keys: list[str]) -> DataFrame:
    return current(spark, base, view).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def batter_stats(spark: SparkSession, base: str) -> DataFrame:
    return _totals(spark, base, "batters", ["batter"]).select(
        F.col("batter").alias("batter_name"), F.col("runs").alias("total_runs"),
        F.col("balls").alias("balls_faced"), "fours", "sixes",
        rate_or_zero("runs", "balls", 100, 2).alias("strike_rate"))


def bowler_stats(spark: SparkSession, base: str) -> DataFrame:
    return _totals(spark, base, "bowlers", ["bowler"]).filter("wickets > 0").select(
        F.col("bowler").alias("bowler_name"), "wickets", F.col("runs").alias("runs_given"),
        F.col("balls").alias("balls_bowled"), rate_or_zero("runs", "balls", 6, 2).alias("economy_rate"))


def phase_stats(spark: SparkSession, base: str) -> DataFrame:
    return _totals(spark, base, "phases", ["batting_team", "phase"]).select(
        F.col("batting_team").alias("team_name"), "phase", "runs", "balls",
        F.col("wickets").alias("wickets_lost"), rate_or_zero("runs", "balls", 6, 2).alias("run_rate"))


def match_summary(spark: SparkSession, base: str) -> DataFrame:
    """One row a match date; its venue is the last source's, in path order."""
    return current(spark, base, "matches").groupBy(F.col("match_id").alias("match_date")).agg(
        F.max_by("venue", SOURCE).alias("venue"), F.sum("runs").alias("total_runs"),
        F.sum("wickets").alias("total_wickets"), F.sum("sixes").alias("total_sixes"),
        F.sum("fours").alias("total_fours"))


def venue_dates(spark: SparkSession, base: str) -> DataFrame:
    """Distinct match dates of each venue, exact and estimated, and runs a match."""
    exact = current(spark, base, "matches").groupBy("venue").agg(
        F.sum("runs").alias("total_runs"), F.countDistinct("match_id").alias("matches"))
    united = _read(spark, base, "venue_dates").groupBy(F.col("venue").alias("v")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("dates", F.lit(False))).alias("estimate"))
    return (exact.join(united, F.col("venue").eqNullSafe(F.col("v")), "left")
            .select("venue", "total_runs", "matches", "estimate",
                    rate("total_runs", "matches", 1, 1).alias("avg_runs_per_match")))
