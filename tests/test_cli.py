"""The command line runs every job end to end (in-process, shared session)."""
import os

import pytest

from crease.__main__ import main
from crease.sources.matches import write_match_documents
from crease.sources.testtables import deliveries_from_lineitem
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cli-docs") / "docs")
    write_match_documents(deliveries_from_lineitem(spark, SF_SMALL), path)
    return path


def test_batch_commands(spark, docs, tmp_dir):
    n = deliveries_from_lineitem(spark, SF_SMALL).count()
    season = main(["season", "--docs", docs, "--json-lines", "--out", f"{tmp_dir}/season"], spark)
    assert season["rows_before"] == n
    rep = main(["daily", "--docs", docs, "--json-lines", "--out", f"{tmp_dir}/daily",
                "--run-date", "2024-03-22"], spark)
    assert rep["status"] == "SUCCESS" and rep["input_files"] > 0
    wh = main(["warehouse", "--docs", docs, "--json-lines", "--out", f"{tmp_dir}/wh"], spark)
    assert len(wh["batters"]) == 5 and len(wh["bowlers"]) == 5
    lake1 = main(["lake", "--docs", docs, "--json-lines", "--table", f"{tmp_dir}/lake",
                  "--idempotent"], spark)
    lake2 = main(["lake", "--docs", docs, "--json-lines", "--table", f"{tmp_dir}/lake",
                  "--idempotent", "--add-phase"], spark)
    assert lake1["added"] == n and lake2["added"] == 0 and lake2["total_rows"] == n
    assert (lake1["load"], lake2["load"]) == (1, 2)


@pytest.fixture(scope="module")
def event_docs(spark, tmp_path_factory):
    """Documents from the events table: about 33 balls per match, so snapshots exist."""
    from pyspark.sql import functions as F

    from crease.sources.testtables import deliveries_from_events
    path = str(tmp_path_factory.mktemp("cli-event-docs") / "docs")
    balls = (deliveries_from_events(spark, SF_SMALL)
             .withColumn("venue", F.lit("v1"))
             .withColumn("extras", F.col("total_runs") - F.col("runs_off_bat")))
    write_match_documents(balls, path)
    return path


def test_message_commands(spark, event_docs, tmp_dir):
    msgs = f"{tmp_dir}/messages"
    main(["publish", "--docs", event_docs, "--json-lines", "--out", msgs], spark)
    again = f"{tmp_dir}/twice"
    for _ in range(2):
        main(["publish", "--docs", event_docs, "--json-lines", "--out", again], spark)
    offsets = [r.offset for r in spark.read.parquet(again).collect()]
    assert len(set(offsets)) == len(offsets) == 2 * spark.read.parquet(msgs).count()
    main(["scorecards", "--messages", msgs, "--out", f"{tmp_dir}/cards"], spark)
    final = spark.read.parquet(f"{tmp_dir}/cards/final")
    assert final.groupBy().sum("balls").first()[0] == spark.read.parquet(msgs).count()
    main(["live", "--messages", msgs, "--out", f"{tmp_dir}/live",
          "--checkpoint", f"{tmp_dir}/live-ckpt", "--once", "--max-per-trigger", "1"], spark)
    from crease.streaming.live import read_live_table
    live = read_live_table(spark, f"{tmp_dir}/live")
    n_files = len([f for f in os.listdir(msgs) if f.endswith(".parquet")])
    assert live.count() > 0
    assert live.agg({"batch_id": "max"}).first()[0] == n_files - 1   # one file per batch
    main(["scorecard-stream", "--messages", msgs, "--out", f"{tmp_dir}/sc",
          "--checkpoint", f"{tmp_dir}/sc-ckpt", "--once"], spark)
    from crease.streaming.scorecard_stream import read_scorecards
    got = read_scorecards(spark, f"{tmp_dir}/sc").count()
    assert got == spark.read.parquet(f"{tmp_dir}/cards/every_30").count() and got > 0
    assert os.path.isdir(f"{tmp_dir}/sc-ckpt")
