"""Cleaning rules and data-quality profiles (one pass each)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import schema as S
from crease.functions import count_if


def valid_runs(col: str = "runs_off_bat") -> Column:
    """Runs off the bat inside 0..6; null is invalid."""
    return F.col(col).between(S.MIN_RUNS, S.MAX_RUNS)


def valid_delivery() -> Column:
    """Clean-row predicate: valid runs, non-blank batter, non-null bowler."""
    return (valid_runs()
            & F.col("batter").isNotNull() & (F.trim(F.col("batter")) != F.lit(""))
            & F.col("bowler").isNotNull())


def normalise_wicket(df: DataFrame, col: str = "wicket") -> DataFrame:
    """An empty wicket kind means no wicket."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit("")))


def clean(df: DataFrame) -> DataFrame:
    """Valid deliveries only, wicket '' -> null; a narrow filter, no shuffle."""
    return normalise_wicket(df.filter(valid_delivery()))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per key column, one global aggregate (partial per partition)."""
    return df.agg(count_if(F.col("batter").isNull()).alias("batter_nulls"),
                  count_if(F.col("bowler").isNull()).alias("bowler_nulls"),
                  count_if(F.col("runs_off_bat").isNull()).alias("runs_nulls"))


def clean_audit(df: DataFrame) -> DataFrame:
    """Rows before / after cleaning and removed, in a single scan."""
    return (df.agg(F.count(F.lit(1)).alias("rows_before"),
                   count_if(valid_delivery()).alias("rows_after"))
            .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))
