"""Warehouse refresh / read-back, daily job reruns, versioned sink tables."""
import os

from pyspark.sql import functions as F

from crease.operators import warehouse as WH
from crease.plans.daily import run_daily
from crease.sources import warehouse_io as WIO
from crease.sources.testtables import deliveries_from_lineitem
from crease.streaming.live import live_leaderboard, upsert_sink
from crease.streaming.versioned import latest_version, merge_latest, read_latest, write_version
from tests.conftest import SF_SMALL, rows


def test_warehouse_refresh_and_read_back(spark, tmp_dir):
    raw = deliveries_from_lineitem(spark, SF_SMALL)
    target = {"path": os.path.join(tmp_dir, "wh")}
    WIO.refresh_tables(WH.warehouse_tables(raw), target)
    assert sorted(r["table_name"] for r in WIO.manifest(spark, target["path"]).collect()) == sorted(
        ["agg_batter_stats", "agg_bowler_stats", "agg_phase_stats", "agg_match_summary",
         "dim_batters", "dim_teams"])
    b = WIO.read_table(spark, target, "agg_batter_stats")
    assert "updated_at" in b.columns and b.filter(F.col("updated_at").isNull()).count() == 0
    top = WIO.verify_top_batters(spark, target).collect()
    assert len(top) == 5 and top[0].total_runs >= top[-1].total_runs
    assert WIO.read_table(spark, target, "agg_bowler_stats").filter("wickets = 0").count() == 0
    # refresh again: full replace, no duplicates
    WIO.refresh_tables(WH.warehouse_tables(raw), target)
    assert WIO.read_table(spark, target, "dim_teams").count() == 12


def test_daily_job_reruns_replace_their_date(spark, tmp_dir):
    raw = deliveries_from_lineitem(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "daily")
    files = f"{SF_SMALL}/lineitem.parquet"
    r1 = run_daily(spark, raw, out, "2024-03-22", inputs_path=files, inputs_glob="*.parquet")
    assert r1.count() == 1                   # read before the rerun replaces its files
    r1b = run_daily(spark, raw, out, "2024-03-22", inputs_path=files, inputs_glob="*.parquet")
    assert r1b.count() == 1
    run_daily(spark, raw, out, "2024-03-23")
    allr = spark.read.json(os.path.join(out, "reports"))
    assert sorted(str(r.run_date) for r in allr.select("run_date").collect()) == ["2024-03-22", "2024-03-23"]
    rep = r1b.first()
    assert rep.status == "SUCCESS" and rep.input_files == 1
    assert rep.deliveries_processed == raw.filter(F.col("runs_off_bat").between(0, 6)).count()
    assert spark.read.parquet(os.path.join(out, "daily_top_batters")).count() == 10
    text = spark.read.text(os.path.join(out, "reports_text", "run_date=2024-03-22")).collect()
    assert text[0].value == "Daily report 2024-03-22" and "SUCCESS" in text[-1].value
    assert any(f"{rep.deliveries_processed:,}" in r.value for r in text)


def test_versioned_table_and_keyed_merge(spark, tmp_dir):
    base = os.path.join(tmp_dir, "live")
    assert latest_version(spark, base) is None and read_latest(spark, base) is None
    schema = "batter_name string, live_runs long, batch_id long"
    v0 = spark.createDataFrame([("a", 5, 0), ("b", 9, 0)], schema)
    write_version(v0, base, 0)
    v1 = merge_latest(read_latest(spark, base), spark.createDataFrame([("a", 12, 1)], schema),
                      ["batter_name"])
    write_version(v1, base, 1)
    assert latest_version(spark, base) == 1
    assert rows(read_latest(spark, base)) == [("a", 12, 1), ("b", 9, 0)]
    lb = live_leaderboard(spark, base)
    assert [r.batter_name for r in lb.collect()] == ["a", "b"]


def test_upsert_survives_a_crash_between_batches(spark, tmp_dir):
    """A version that never finished is no version: the retry merges onto the one before."""
    base = os.path.join(tmp_dir, "live")
    stats = "batter string, live_runs long, live_balls long, live_fours long, live_sixes long, live_sr double"
    sink = upsert_sink(base)
    sink(spark.createDataFrame([("a", 5, 3, 0, 0, 1.0), ("b", 9, 4, 1, 0, 2.0)], stats), 0)
    change = spark.createDataFrame([("a", 12, 6, 1, 0, 3.0)], stats)
    os.makedirs(os.path.join(base, "v=1"))                    # died while writing
    assert latest_version(spark, base) == 0
    sink(change, 1)
    sink(change, 1)                                           # a retry of a complete batch
    assert [(r.batter_name, r.live_runs) for r in live_leaderboard(spark, base).collect()] == [
        ("a", 12), ("b", 9)]
    for i in range(2, 6):
        sink(change, i)
    assert len(os.listdir(base)) == 2                         # old versions are pruned
    assert live_leaderboard(spark, base).count() == 2


def test_no_private_scratch_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from crease.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf={}))
