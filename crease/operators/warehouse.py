"""Warehouse summary tables over the *uncleaned* delivery fact.

Every delivery row counts as a ball; names are kept unless null or empty
(blank names such as '  ' stay); a wicket is any non-empty wicket kind.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease import schema as S
from crease.functions import count_if, is_present, phase, phase_order, rate_or_zero, sequential_ids


def wh_batter_stats(raw_df: DataFrame) -> DataFrame:
    return (raw_df.filter(is_present("batter"))
            .groupBy(F.col("batter").alias("batter_name"))
            .agg(F.sum("runs_off_bat").alias("total_runs"),
                 F.count(F.lit(1)).alias("balls_faced"),
                 count_if(F.col("runs_off_bat") == 4).alias("fours"),
                 count_if(F.col("runs_off_bat") == 6).alias("sixes"))
            .withColumn("strike_rate", rate_or_zero("total_runs", "balls_faced", 100, 2)))


def wh_bowler_stats(raw_df: DataFrame, require_wicket: bool = True) -> DataFrame:
    """Bowler table; by default only bowlers with at least one wicket are kept."""
    out = (raw_df.filter(is_present("bowler"))
           .groupBy(F.col("bowler").alias("bowler_name"))
           .agg(count_if(is_present("wicket")).alias("wickets"),
                F.sum("total_runs").alias("runs_given"),
                F.count(F.lit(1)).alias("balls_bowled"))
           .withColumn("economy_rate", rate_or_zero("runs_given", "balls_bowled", 6, 2)))
    return out.filter(F.col("wickets") > 0) if require_wicket else out


def wh_phase_stats(raw_df: DataFrame, labels=S.PHASE_SHORT) -> DataFrame:
    """Team and phase as two columns (no delimiter-joined key)."""
    return (raw_df.withColumn("phase", phase("over_num", labels))
            .filter(F.col("phase").isNotNull())
            .groupBy(F.col("batting_team").alias("team_name"), "phase")
            .agg(F.sum("runs_off_bat").alias("runs"),
                 F.count(F.lit(1)).alias("balls"),
                 count_if(is_present("wicket")).alias("wickets_lost"))
            .withColumn("run_rate", rate_or_zero("runs", "balls", 6, 2))
            .withColumn("phase_order", phase_order("phase", labels)))


def wh_match_summary(raw_df: DataFrame) -> DataFrame:
    """One row per match id (= first match date).

    Two documents with the same date merge; their venue is taken from the
    last source file in path order (``max_by``).  Counting happens in a hash
    aggregate keyed by (match, venue[, file]) -- a string max has no
    fixed-width buffer and would force a sort-based aggregate over every
    ball -- and the venue is picked from that far smaller table.
    """
    has_file = "file_path" in raw_df.columns
    keys = ["match_id", "venue"] + (["file_path"] if has_file else [])
    per_source = (raw_df.groupBy(*keys)
                  .agg(F.sum("runs_off_bat").alias("runs"),
                       count_if(is_present("wicket")).alias("wickets"),
                       count_if(F.col("runs_off_bat") == 6).alias("sixes"),
                       count_if(F.col("runs_off_bat") == 4).alias("fours")))
    venue = F.max_by("venue", "file_path") if has_file else F.max("venue")
    return (per_source.groupBy(F.col("match_id").alias("match_date"))
            .agg(venue.alias("venue"),
                 F.sum("runs").alias("total_runs"),
                 F.sum("wickets").alias("total_wickets"),
                 F.sum("sixes").alias("total_sixes"),
                 F.sum("fours").alias("total_fours")))


def dim_batters(raw_df: DataFrame) -> DataFrame:
    """Distinct batter names with a dense id in name order (distributed numbering)."""
    names = raw_df.filter(is_present("batter")).select(F.col("batter").alias("batter_name")).distinct()
    return sequential_ids(names, ["batter_name"], "batter_id").select("batter_id", "batter_name")


def dim_teams(raw_df: DataFrame) -> DataFrame:
    names = (raw_df.filter(is_present("batting_team"))
             .select(F.col("batting_team").alias("team_name")).distinct())
    return sequential_ids(names, ["team_name"], "team_id").select("team_id", "team_name")


def warehouse_tables(raw_df: DataFrame, require_wicket: bool = True) -> dict[str, DataFrame]:
    """The four populated summary tables plus the two dimensions."""
    return {
        "agg_batter_stats": wh_batter_stats(raw_df),
        "agg_bowler_stats": wh_bowler_stats(raw_df, require_wicket),
        "agg_phase_stats": wh_phase_stats(raw_df).drop("phase_order"),
        "agg_match_summary": wh_match_summary(raw_df),
        "dim_batters": dim_batters(raw_df),
        "dim_teams": dim_teams(raw_df),
    }
