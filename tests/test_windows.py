"""Event-time windows: late balls, retried and repeated micro-batches."""
import datetime as dt

from pyspark.sql import functions as F

from crease.streaming import windows as EW
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def batch(spark, *balls):
    """(match, minutes, runs, wicket) rows as one micro-batch."""
    return spark.createDataFrame(
        [(m, T0 + dt.timedelta(minutes=t), r, w) for m, t, r, w in balls],
        "match_id string, event_time timestamp, runs_off_bat int, wicket string")


def state(spark, base):
    pick = ["match_id", F.date_format("window_start", "HH:mm"), "runs", "balls", "wickets"]
    return (rows(EW.read_windows(spark, base).select(*pick, "closed")), rows(EW.read_late(spark, base).select(*pick)))


def test_late_balls_are_counted_aside(spark, tmp_dir):
    sink = EW.window_sink(tmp_dir, "10 minutes", "20 minutes")
    assert state(spark, tmp_dir) == ([], [])
    sink(batch(spark, ("m", 1, 4, None), ("m", 31, 1, "bowled"), ("n", 2, 6, "")), 0)
    # the watermark is 00:11: the windows of 00:00 are closed
    assert state(spark, tmp_dir) == (
        [("m", "00:00", 4, 1, 0, True), ("m", "00:30", 1, 1, 1, False), ("n", "00:00", 6, 1, 0, True)], [])
    late = batch(spark, ("m", 5, 2, None), ("m", 12, 3, None), ("n", 9, 1, "caught"), ("m", 65, None, None))
    sink(late, 1)
    sink(late, 1)                                       # a batch that was complete changes nothing
    got = state(spark, tmp_dir)
    assert got == (
        [("m", "00:00", 4, 1, 0, True), ("m", "00:10", 3, 1, 0, True), ("m", "00:30", 1, 1, 1, True),
         ("m", "01:00", None, 1, 0, False), ("n", "00:00", 6, 1, 0, True)],
        [("m", "00:00", 2, 1, 0), ("n", "00:00", 1, 1, 1)])
    # batch 2 wrote its sums and died before its watermark: it is not read, the retry rewrites it
    last = batch(spark, ("m", 66, 5, None))
    last.write.parquet(f"{tmp_dir}/elsewhere")
    (last.select("match_id", F.col("event_time").alias("window_start")).write
     .parquet(f"{tmp_dir}/sums/batch=2/late=false"))
    assert state(spark, tmp_dir) == got
    sink(last, 2)
    assert ("m", "01:00", 5, 2, 0, False) in state(spark, tmp_dir)[0]


def test_empty_batches_keep_the_watermark(spark, tmp_dir):
    sink = EW.window_sink(tmp_dir, "10 minutes", "20 minutes")
    sink(batch(spark, ("m", 31, 1, None)), 0)
    sink(batch(spark).limit(0), 1)
    sink(batch(spark, ("m", 1, 1, None)), 2)
    assert state(spark, tmp_dir) == ([("m", "00:30", 1, 1, 0, False)], [("m", "00:00", 1, 1, 0)])
