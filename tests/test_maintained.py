"""Views kept by load, warehouse refreshes as a whole, message intake."""
import os

import pytest
from pyspark.sql import functions as F

from crease.operators import maintained as MV
from crease.operators import warehouse as WH
from crease.sources import warehouse_io as WIO
from crease.sources.message_log import drain, publish, read_log_stream
from crease.sources.testtables import deliveries_from_lineitem
from crease.streaming import intake as IN
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def balls(spark):
    """Deliveries of two documents a date."""
    return deliveries_from_lineitem(spark, SF_SMALL).withColumn(
        "file_path", F.concat("match_id", F.lit("-"), F.col("doc_no") % 2)).persist()


def _views(spark, base):
    return [rows(v(spark, base)) for v in (MV.batter_stats, MV.bowler_stats, MV.phase_stats, MV.match_summary)]


def _whole(balls):
    return [rows(WH.wh_batter_stats(balls)), rows(WH.wh_bowler_stats(balls)),
            rows(WH.wh_phase_stats(balls).drop("phase_order")), rows(WH.wh_match_summary(balls))]


def test_loads_and_a_reload_equal_the_full_computation(spark, balls, tmp_dir):
    first = balls.filter("doc_no % 2 = 0")
    wrong = first.withColumn("runs_off_bat", F.col("runs_off_bat") + 2).withColumn("bowler", F.lit("nobody"))
    assert MV.add_load(wrong, tmp_dir) == 1
    assert _views(spark, tmp_dir) == _whole(wrong)
    MV.add_load(balls.filter("doc_no % 2 = 1 AND match_id < '1995'"), tmp_dir)
    MV.add_load(balls.filter("doc_no % 2 = 1 AND match_id >= '1995'"), tmp_dir)
    MV.add_load(first, tmp_dir)                         # the first load's sources, put right
    assert _views(spark, tmp_dir) == _whole(balls)
    # what is read is the partial rows, at most one a source and key
    assert MV.current(spark, tmp_dir, "batters").groupBy("file_path", "batter").count().filter("count > 1").isEmpty()


def test_a_load_is_read_once(spark, balls, tmp_dir):
    """The views read what is staged, not the load's deliveries again."""
    read = spark.sparkContext.accumulator(0)

    def seen(name):
        read.add(1)
        return name

    MV.add_load(balls.withColumn("batter", F.udf(seen, "string")("batter")), tmp_dir)
    assert read.value == balls.count()
    assert _views(spark, tmp_dir) == _whole(balls)


def test_an_interrupted_load_is_never_read(spark, balls, tmp_dir):
    half = balls.filter("doc_no % 2 = 0")
    MV.add_load(half, tmp_dir)
    # a load that died before its source list was written
    for name, view in MV._views(balls.filter("doc_no % 2 = 1")).items():
        if name != "matches":
            view.write.parquet(f"{tmp_dir}/load=2/{name}")
    assert _views(spark, tmp_dir) == _whole(half)
    assert MV.add_load(balls.filter("doc_no % 2 = 1"), tmp_dir) == 3
    assert _views(spark, tmp_dir) == _whole(balls)
    with pytest.raises(ValueError):
        MV.batter_stats(spark, os.path.join(tmp_dir, "nothing"))


def test_a_source_that_lost_its_rows_of_a_key(spark, balls, tmp_dir):
    """A reload without a batter takes the batter's runs of that source away, also
    where the source has no other delivery."""
    MV.add_load(balls, tmp_dir)
    again = balls.filter("file_path LIKE '%-0'")
    less = again.filter("batter <> 'batter_7'")
    MV.add_load(less, tmp_dir, again.select("file_path"))
    assert _views(spark, tmp_dir)[0] == _whole(balls.filter("file_path LIKE '%-1'").unionByName(less))[0]


def test_sketches_unite_to_within_their_error(spark, tmp_dir):
    for k in range(3):                                  # dates of the loads overlap by half
        load = spark.range(k * 15_000, k * 15_000 + 30_000).select(
            F.lit(f"s{k}").alias("file_path"), F.col("id").cast("string").alias("match_id"),
            F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("venue"), F.lit("t").alias("batting_team"),
            F.lit("x").alias("batter"), F.lit("y").alias("bowler"), F.lit(1).alias("over_num"),
            F.lit(1).alias("runs_off_bat"), F.lit(1).alias("total_runs"), F.lit(None).cast("string").alias("wicket"))
        MV.add_load(load, tmp_dir)
    got = {r["venue"]: (r["matches"], r["estimate"]) for r in MV.venue_dates(spark, tmp_dir).collect()}
    assert {v: n for v, (n, _) in got.items()} == {"a": 20_000, "b": 40_000}
    for n, estimate in got.values():
        assert abs(estimate - n) <= 4 * 1.04 / 2 ** (MV.SKETCH_BITS / 2) * n


def test_a_crash_between_two_tables_leaves_the_old_refresh(spark, balls, tmp_dir):
    target = {"path": tmp_dir}
    names = ["agg_batter_stats", "agg_bowler_stats", "agg_phase_stats", "agg_match_summary", "dim_batters",
             "dim_teams"]

    def state():
        return {t: rows(WIO.read_table(spark, target, t)) for t in names}

    WIO.refresh_tables(WH.warehouse_tables(balls.filter("over_num < 4")), target)
    old = state()
    tables = WH.warehouse_tables(balls)
    boom = tables["agg_match_summary"].withColumn("total_runs", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        WIO.refresh_tables({**tables, "agg_match_summary": boom}, target)
    assert state() == old
    WIO.refresh_tables(tables, target)
    new = state()
    assert all(new[t] != old[t] for t in names)
    assert {r[-1] for t in names for r in new[t]} == {
        r["refreshed_at"] for r in WIO.manifest(spark, tmp_dir).collect()}       # one stamp
    for _ in range(2):
        WIO.refresh_tables(tables, target)
    assert len([d for d in os.listdir(tmp_dir) if d.startswith("refresh=")]) <= 3
    # a refresh of one table leaves the others as they are
    WIO.refresh_tables({"dim_teams": tables["dim_teams"]}, target)
    assert rows(WIO.read_table(spark, target, "agg_batter_stats").drop("updated_at")) == rows(
        tables["agg_batter_stats"])
    with pytest.raises(ValueError):
        WIO.read_table(spark, target, "no_such_table")


VALUES = [('{"match_id":"m","batter":"b","bowler":"w","runs_off_bat":4,"over":1}', ""), ("{}", ""),
          ('{"match_id":"m","ba', IN.NOT_JSON), ('{"match_id":"m","runs_off_bat":"many"}', IN.WRONG_TYPE),
          ('{"over":1.5}', IN.WRONG_TYPE), (None, IN.NO_VALUE), ("", IN.NOT_JSON), ("  ", IN.NOT_JSON),
          ("[1]", IN.NOT_JSON), ("5", IN.NOT_JSON), ('"x"', IN.NOT_JSON), ("null", IN.NOT_JSON),
          ('{"batter":" ","runs_off_bat":9}', "")]


def test_every_message_is_read_or_kept_as_a_dead_letter(spark, tmp_dir):
    env = spark.createDataFrame(
        [(None if i % 2 else bytearray(b"m"), None if v is None else bytearray(v.encode()), i)
         for i, (v, _) in enumerate(VALUES)], "key binary, value binary, offset long").select(
        "key", "value", F.lit("balls").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    publish(env, f"{tmp_dir}/log", segment=4)

    def run():
        drain(lambda: IN.start_intake(read_log_stream(spark, f"{tmp_dir}/log", f"{tmp_dir}/ckpt", 5),
                                      f"{tmp_dir}/table", f"{tmp_dir}/ckpt", {"processingTime": "0 seconds"}))

    run()
    run()                                               # nothing new: nothing changes
    dead = {r["kafka_offset"]: (r["payload"], r["reason"]) for r in
            IN.read_dead_letters(spark, f"{tmp_dir}/table").collect()}
    assert dead == {i: (v, why) for i, (v, why) in enumerate(VALUES) if why}
    good = IN.read_messages(spark, f"{tmp_dir}/table")
    assert sorted(r["kafka_offset"] for r in good.collect()) == [i for i, (_, why) in enumerate(VALUES) if not why]
    audit = IN.read_audit(spark, f"{tmp_dir}/table")
    assert [r["messages"] for r in audit.orderBy("batch_id").collect()] == [5, 5, 3]
    assert audit.agg(F.sum("dead"), F.sum("rows_before"), F.sum("rows_after"), F.sum("batter_nulls"),
                     F.sum("runs_nulls")).first() == (10, 3, 1, 1, 1)
    # a retried batch rewrites its own rows
    IN.intake_sink(f"{tmp_dir}/table")(IN.judged_messages(env.filter("offset >= 10")), 2)
    assert IN.read_dead_letters(spark, f"{tmp_dir}/table").count() == 10
