"""Lake table behaviour, stream sinks, restart and equivalences."""
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from crease import schema as S
from crease.functions import phase
from crease.operators import lake as LK
from crease.operators.leaderboards import top_bowlers
from crease.operators.quality import clean
from crease.operators.scorecard import scorecard_every
from crease.plans import catalog as CAT
from crease.sources.message_log import (
    _LogReader, drain, publish, read_log, read_log_stream, resume_position,
)
from crease.sources.messages import parse_messages, to_envelope
from crease.sources.testtables import deliveries_from_events, deliveries_from_lineitem
from crease.streaming.live import live_stats, read_live_table, start_live_stats, without_redelivery
from crease.streaming.scorecard_stream import read_balls, read_scorecards, start_scorecard_stream
from tests.conftest import SF_SMALL, rows


def test_lake_append_evolve_history(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lake")
    src = LK.lake_rows(deliveries_from_lineitem(spark, SF_SMALL))
    n = src.count()
    assert LK.append_load(src, path) == 1
    evolved = LK.lake_schema(("phase", "string"))
    later = src.withColumn("phase", phase("over_num", S.PHASE_SHORT))
    with pytest.raises(ValueError, match="phase"):
        LK.append_load(later, path)
    assert LK.append_load(later, path, schema=evolved) == 2
    table = LK.scan(spark, path, evolved)
    assert table.count() == 2 * n
    assert table.filter("load_id = 1 AND phase IS NOT NULL").count() == 0
    assert LK.scan(spark, path, as_of=1).count() == n                   # an earlier state
    hist = [(r.sequence_number, r.added_records, r.total_records)
            for r in LK.load_history(spark, path).collect()]
    assert sorted(hist) == [(1, n, n), (2, n, 2 * n)]
    parts = {d for d in os.listdir(os.path.join(path, "load_id=1")) if "=" in d}
    assert len(parts) == 12 and all(p.startswith("batting_team=") for p in parts)
    plan = table.filter(F.col("batting_team") == "team_1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batting_team" in plan
    assert {r.name: r.n_values for r in LK.column_profile(table).collect()}["match_id"] == 2 * n


def test_lake_columns_are_read_by_id(spark, tmp_dir):
    """Names may change and even change places; values follow the ids."""
    src = LK.lake_rows(deliveries_from_lineitem(spark, SF_SMALL))
    LK.append_load(src, tmp_dir)
    names = {"batter": "bowler", "bowler": "batter", "extras": "byes"}
    swapped = LK.lake_schema(renamed=names)
    LK.append_load(src.select(*[F.col(c).alias(names.get(c, c)) for c in src.columns]), tmp_dir, schema=swapped)
    table = LK.scan(spark, tmp_dir, swapped)
    want = rows(src.select("bowler", "batter", "extras", "batting_team"))
    for load in (1, 2):
        assert rows(table.filter(F.col("load_id") == load).select("batter", "bowler", "byes", "batting_team")) == want
    assert {(r["id"], r["name"]) for r in LK.column_profile(table, swapped).collect()} >= {
        (5, "bowler"), (6, "batter"), (11, "byes")}


def test_lake_interrupted_append_leaves_no_orphans(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lake")
    src = LK.lake_rows(deliveries_from_lineitem(spark, SF_SMALL))
    assert LK.scan(spark, path).count() == 0
    LK.append_load(src, path)
    n = src.count()
    # a load of twelve teams that died before its job ended
    (src.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .partitionBy("batting_team").parquet(f"{path}/load_id=2"))
    assert LK.scan(spark, path).count() == n
    one = src.filter("batting_team = 'team_3'")
    assert LK.append_load(one, path) == 3                   # the retry takes a fresh folder
    assert LK.scan(spark, path).count() == n + one.count()


def test_lake_idempotent_append_by_source_path(spark, tmp_dir):
    """Two matches of one date are two sources; a rerun adds nothing."""
    path = os.path.join(tmp_dir, "lake")
    rows_ = LK.lake_rows(deliveries_from_lineitem(spark, SF_SMALL).withColumn(
        "file_path", F.concat("match_id", F.lit("-"), F.col("doc_no") % 2)))
    first = rows_.filter("file_path LIKE '%-0'")
    LK.append_new(first, path)
    assert LK.scan(spark, path).count() == first.count() > 0
    LK.append_new(rows_, path)
    LK.append_new(rows_, path)
    assert rows(LK.scan(spark, path).drop("load_id")) == rows(rows_.select(
        *[c for c in LK.scan(spark, path).columns if c != "load_id"]))


def test_rows_are_not_shuffled_for_a_short_list_of_sources(spark, tmp_dir, monkeypatch):
    """Whatever the table holds, its list of sources is small."""
    rows_ = LK.lake_rows(deliveries_from_lineitem(spark, SF_SMALL).withColumn(
        "file_path", F.concat(F.lit("source-"), F.col("doc_no") % 3)))
    LK.append_new(rows_.filter("file_path <> 'source-1'"), tmp_dir)
    plans, append = [], LK.append_load

    def planned(rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return append(rows, *args, **kwargs)

    monkeypatch.setattr(LK, "append_load", planned)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        LK.append_new(rows_, tmp_dir)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert LK.scan(spark, tmp_dir).count() == rows_.count()


def test_one_aggregate_equals_bowlers_joined_with_wickets(spark):
    c = clean(deliveries_from_lineitem(spark, SF_SMALL))
    c.createOrReplaceTempView("c_balls")
    joined = spark.sql("""
        SELECT b.bowler, b.given, b.balls, coalesce(w.n, 0) AS wickets
        FROM (SELECT bowler, sum(total_runs) AS given, count(*) AS balls FROM c_balls GROUP BY bowler) b
        LEFT JOIN (SELECT bowler, count(*) AS n FROM c_balls WHERE wicket IS NOT NULL GROUP BY bowler) w
          ON b.bowler = w.bowler
        WHERE b.balls >= 60 ORDER BY wickets DESC, b.bowler LIMIT 10""")
    assert rows(joined) == rows(top_bowlers(c).select("bowler", "runs_given", "balls_bowled", "wickets"))


AT_ONCE = {"processingTime": "0 seconds"}


def _batch(spark, batches):
    """Positions of a micro-batch, so that the small table makes ``batches`` of them."""
    lo, hi = deliveries_from_events(spark, SF_SMALL).agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
    return -(-(hi - lo + 1) // batches)


def _live(spark, base, mode, max_offsets, change=lambda p: p):
    drain(lambda: start_live_stats(
        change(parse_messages(read_log_stream(spark, f"{base}/log", f"{base}/ckpt", max_offsets))),
        f"{base}/table", f"{base}/ckpt", mode=mode, trigger=AT_ONCE))
    return read_live_table(spark, f"{base}/table")


def _scorecards(spark, base, max_offsets):
    drain(lambda: start_scorecard_stream(
        parse_messages(read_log_stream(spark, f"{base}/log", f"{base}/ckpt", max_offsets), clean=False),
        f"{base}/table", f"{base}/ckpt", trigger=AT_ONCE))
    return read_scorecards(spark, f"{base}/table")


def _board(df, name):
    return rows(df.select(name, "live_runs", "live_balls", "live_fours", "live_sixes"))


def test_stream_equals_batch(spark, tmp_dir):
    env = to_envelope(deliveries_from_events(spark, SF_SMALL))
    want = _board(live_stats(parse_messages(env)), "batter")
    for mode, batches in (("complete", 1), ("update", 3)):
        base = os.path.join(tmp_dir, mode)
        publish(env, f"{base}/log", segment=170)
        got = _live(spark, base, mode, _batch(spark, batches))
        assert _board(got, "batter_name") == want, mode
        assert got.select(F.max("batch_id")).first()[0] == batches - 1


def test_log_reads_by_position(spark, tmp_dir):
    env = to_envelope(deliveries_from_events(spark, SF_SMALL))
    publish(env, tmp_dir, segment=100)
    # an append that died before its job ended is not there
    (env.withColumn("position", F.col("offset") + 5000).write
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_dir}/append=1/segment=50"))
    assert rows(read_log(spark, tmp_dir, 150, 350).drop("position")) == rows(
        env.filter("offset >= 150 AND offset < 350"))
    assert publish(env.limit(0), tmp_dir) == 2
    n = env.count()
    assert publish(env, tmp_dir, F.col("offset") + n) == 3      # a second complete append
    assert read_log(spark, tmp_dir).count() == 2 * n
    assert read_log(spark, tmp_dir, n - 10, n + 10).select("offset").distinct().count() == 20
    plan = read_log(spark, tmp_dir, 150, 350)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(position,150)" in plan


def test_restart_takes_up_where_the_checkpoint_ended(spark, tmp_dir):
    balls = deliveries_from_events(spark, SF_SMALL)
    lo, hi = balls.agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
    cut = lo + 2 * (hi - lo) // 3
    publish(to_envelope(balls.filter(F.col("kafka_offset") < cut)), f"{tmp_dir}/log", segment=64)
    _scorecards(spark, tmp_dir, 300)
    assert resume_position(spark, f"{tmp_dir}/ckpt") == cut
    publish(to_envelope(balls.filter(F.col("kafka_offset") >= cut)), f"{tmp_dir}/log", segment=64)
    assert rows(_scorecards(spark, tmp_dir, 300)) == rows(scorecard_every(balls))
    assert resume_position(spark, f"{tmp_dir}/ckpt") == hi + 1


def test_scorecard_stream_equals_batch_under_redelivery(spark, tmp_dir):
    balls = deliveries_from_events(spark, SF_SMALL)
    batch = rows(scorecard_every(balls, block_width=8))   # many blocks per match
    assert batch == rows(scorecard_every(balls))
    once = to_envelope(balls).withColumn("position", F.col("offset") * 2)
    publish(once.unionByName(once.withColumn("position", F.col("position") + 301)), f"{tmp_dir}/log",
            F.col("position"))
    assert rows(_scorecards(spark, tmp_dir, 700)) == batch
    assert read_balls(spark, f"{tmp_dir}/table").count() == balls.count()


def test_scorecard_stream_with_one_match_of_most_balls(spark, tmp_dir):
    data = [("hot" if i % 10 else f"m{i % 70}", f"b{i * i % 7}", i % 7, i + 1) for i in range(12_000)]
    balls = spark.createDataFrame(data, "match_id string, batter string, runs_off_bat int, kafka_offset long")
    balls = balls.select("*", F.lit("t").alias("batting_team"), F.lit("w").alias("bowler"),
                         F.lit(0).alias("over_num"), F.lit(1).alias("ball_num"),
                         F.col("runs_off_bat").alias("total_runs"),
                         F.lit(None).cast("string").alias("wicket"), F.current_timestamp().alias("event_time"))
    publish(to_envelope(balls), f"{tmp_dir}/log")
    assert rows(_scorecards(spark, tmp_dir, 5000)) == rows(scorecard_every(balls))
    # the hot match is numbered by blocks, none larger than its width
    assert read_balls(spark, f"{tmp_dir}/table").filter("match_id = 'hot'").agg(
        F.countDistinct("block"), F.max("block_no")).first() == (
            3, sum(1 for i in range(12_000) if i % 10 and (i + 1) // 4096 == 1))


def test_messages_that_come_again_count_once(spark, tmp_dir):
    once = to_envelope(deliveries_from_events(spark, SF_SMALL)).withColumn("position", F.col("offset") * 2)
    publish(once.unionByName(once.withColumn("position", F.col("position") + 101)), f"{tmp_dir}/log",
            F.col("position"))
    got = _live(spark, tmp_dir, "update", 900, lambda p: without_redelivery(p, "10 days"))
    assert _board(got, "batter_name") == _board(live_stats(parse_messages(once)), "batter")


def test_micro_batches_grow_with_the_cores(spark, tmp_dir):
    """A log of four batches of 100,000 positions a core is read in four, not in tens."""
    most = CAT.CORE_OFFSETS * spark.sparkContext.defaultParallelism
    balls = spark.range(0, 4 * most, 500).select(
        F.col("id").alias("kafka_offset"), F.timestamp_seconds(F.col("id") / 100).alias("event_time"),
        F.concat(F.lit("m"), F.col("id") % 7).alias("match_id"), F.lit("t").alias("batting_team"),
        F.concat(F.lit("b"), F.col("id") % 11).alias("batter"), F.lit("w").alias("bowler"),
        F.lit(0).alias("over_num"), F.lit(1).alias("ball_num"), (F.col("id") % 9).cast("int").alias("runs_off_bat"),
        F.lit(1).alias("total_runs"), F.lit(None).cast("string").alias("wicket"))
    env = to_envelope(balls)
    publish(env, f"{tmp_dir}/log", segment=most)
    got = read_live_table(spark, CAT._run_live(spark, tmp_dir, "update"))
    assert _board(got, "batter_name") == _board(live_stats(parse_messages(env)), "batter")
    assert got.select(F.max("batch_id")).first()[0] == 3
    assert rows(CAT._scorecards(spark, f"{tmp_dir}/cards", f"{tmp_dir}/log")) == rows(scorecard_every(balls))
    assert len(os.listdir(f"{tmp_dir}/cards/checkpoint/offsets")) // 2 == 4      # each with its checksum


def test_a_complete_append_is_listed_once(spark, tmp_dir):
    publish(to_envelope(deliveries_from_events(spark, SF_SMALL)), tmp_dir, segment=100)
    reader = _LogReader({"path": tmp_dir})
    real, listed, bounds = reader.files, [], reader._bounds()
    reader.files = SimpleNamespace(get_file_info=lambda s: listed.append(s.recursive) or real.get_file_info(s))
    assert reader._bounds() == bounds and bounds[1] > bounds[0]
    assert listed == [False]                                # the appends' names, not their files
    reader.files = real
    publish(to_envelope(deliveries_from_events(spark, SF_SMALL)), tmp_dir, F.col("offset") + bounds[1])
    assert reader._bounds()[1] > bounds[1]
