"""Season batch job: documents -> flatten -> clean -> leaderboards -> files.

One parse of the documents feeds all outputs.  By default the cleaned fact
is staged as a Parquet table under the shared checkpoint folder: each
leaderboard then scans only its own columns, and a lost executor costs no
JSON re-parse.  ``stage="cache"`` keeps it in executor memory (spilling to
disk) as the source job did; ``stage=None`` recomputes per output.  The
cleaning audit is collected with ``observe`` during the first pass instead
of extra ``count()`` jobs.  Leaderboards are top-k (bounded), so the
single-file CSV copy is written from at most ``top_n`` rows.
"""
from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crease import schema as S
from crease.functions import count_if
from crease.operators.leaderboards import phase_stats, top_batters, top_bowlers
from crease.operators.quality import normalise_wicket, valid_delivery
from crease.session import scratch_path
from crease.sources.matches import flatten, read_match_documents
from crease.sources.storage import delete

TOP_BATTERS_CSV_SCHEMA = ("batter string, runs long, balls_faced long, fours long, sixes long, "
                          "strike_rate double")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file (callers pass bounded, top-k results)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_top_batters_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(TOP_BATTERS_CSV_SCHEMA).csv(path)


def leaderboard_outputs(clean_df: DataFrame, out_base: str, top_n: int = S.TOP_N) -> None:
    """Write the result tables; their (independent) jobs are submitted together."""
    out = out_base.rstrip("/")
    batters, bowlers = top_batters(clean_df, top_n), top_bowlers(clean_df, top_n)
    writes = [
        lambda: batters.write.mode("overwrite").parquet(f"{out}/top_batters"),
        lambda: write_csv(batters, f"{out}/top_batters_csv"),
        lambda: bowlers.write.mode("overwrite").parquet(f"{out}/top_bowlers"),
        lambda: write_csv(bowlers, f"{out}/top_bowlers_csv"),
        lambda: phase_stats(clean_df).write.mode("overwrite").parquet(f"{out}/phase_stats"),
    ]
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for f in [pool.submit(w) for w in writes]:
            f.result()


def run_season(spark: SparkSession, docs_path: str, out_base: str, multi_line: bool = True,
               top_n: int = S.TOP_N, stage: str | None = "table",
               glob: str | None = "*.json") -> dict:
    """Run the job; returns the cleaning audit (rows before / after / removed)."""
    docs = read_match_documents(spark, docs_path, multi_line=multi_line, glob=glob)
    obs = Observation(f"season_{uuid.uuid4().hex[:8]}")
    flat = flatten(docs).observe(obs, F.count(F.lit(1)).alias("rows_before"),
                                 count_if(valid_delivery()).alias("rows_after"))
    cleaned = normalise_wicket(flat.filter(valid_delivery()))
    if stage == "table":
        path = scratch_path(spark, "season-fact")
        cleaned.write.parquet(path)
        cleaned = spark.read.parquet(path)
    elif stage == "cache":
        cleaned = cleaned.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        leaderboard_outputs(cleaned, out_base, top_n)
    finally:
        if stage == "cache":
            cleaned.unpersist()
        elif stage == "table":
            delete(spark, path)            # the outputs are written; nothing reads it again
    m = obs.get
    return {"rows_before": m["rows_before"], "rows_after": m["rows_after"],
            "rows_removed": m["rows_before"] - m["rows_after"]}
