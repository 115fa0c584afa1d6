"""Scheduled batch job: validate inputs -> analyse -> report.

The three steps of the daily schedule as one Spark application: the input
check lists files only, the analysis is the reduced batter leaderboard, and
the report is a one-row table partitioned by run date (a rerun for the same
date replaces its partition).
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crease.operators.leaderboards import daily_top_batters
from crease.operators.quality import valid_runs
from crease.sources.matches import validate_inputs

OUTPUT_NAME = "daily_top_batters"


def run_daily(spark: SparkSession, raw: DataFrame, out_base: str, run_date: str,
              inputs_path: str | None = None, inputs_glob: str = "*.json") -> DataFrame:
    """Run the job; return the report row(s) read back from the report table."""
    files = None
    if inputs_path is not None:
        files = validate_inputs(spark, inputs_path, inputs_glob).first()["files"]
    obs = Observation(f"daily_{uuid.uuid4().hex[:8]}")
    counted = raw.filter(valid_runs()).observe(obs, F.count(F.lit(1)).alias("rows"))
    # daily_top_batters applies the same runs filter again; it is idempotent
    daily_top_batters(counted).write.mode("overwrite").parquet(f"{out_base}/{OUTPUT_NAME}")
    processed = int(obs.get["rows"])
    report = spark.createDataFrame(
        [(run_date, files, processed, OUTPUT_NAME, "SUCCESS")],
        "run_date string, input_files long, deliveries_processed long, output_name string, "
        "status string")
    (report.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").json(f"{out_base}/reports"))
    # the same report as a plain-text file per run date
    text = F.format_string(
        "Daily report %s\nInput files          : %s\nDeliveries processed : %,d\n"
        "Output               : %s\nStatus               : %s",
        "run_date", F.coalesce(F.col("input_files").cast("string"), F.lit("-")),
        "deliveries_processed", "output_name", "status")
    (report.select("run_date", text.alias("value")).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").text(f"{out_base}/reports_text"))
    return (spark.read.schema("input_files long, deliveries_processed long, output_name string, "
                              "status string, run_date string")
            .json(f"{out_base}/reports").filter(F.col("run_date") == run_date))
