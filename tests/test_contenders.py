"""The scorecard's top batters without batters x snapshots."""
import random

from pyspark.sql import functions as F

from crease.operators.scorecard import CONTEST, contenders, interval_totals, scorecard_every
from tests.conftest import rows

BALLS = "match_id string, batter string, runs_off_bat int, kafka_offset long"


def brute(balls, every, top):
    out, matches = [], {}
    for m, b, r, o in sorted(balls, key=lambda x: x[3]):
        seen = matches.setdefault(m, [0, {}])
        seen[0] += 1
        t = seen[1].setdefault(b or "unknown", [0, 0, o])
        t[0] += r or 0
        t[1] += 1
        if seen[0] % every == 0:
            best = sorted(seen[1].items(), key=lambda kv: (-kv[1][0], kv[1][2]))[:top]
            out += [(m, seen[0], i + 1, name, x[0], x[1]) for i, (name, x) in enumerate(best)]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def check(spark, balls, every, top, width=None):
    df = spark.createDataFrame(balls, BALLS)
    got = rows(scorecard_every(df, every, top, width).drop("strike_rate"))
    assert got == brute(balls, every, top)
    return df


def test_random_matches(spark):
    rng = random.Random(11)
    for squad, zero in ((3, 0.2), (12, 0.9), (400, 0.5)):
        balls = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *[f"p{rng.randrange(squad)}"] * 9]),
                  0 if rng.random() < zero else rng.choice([1, 2, 4, 6, None]), 3 * i) for i in range(1500)]
        check(spark, balls, 5, 3, 16)
    check(spark, balls, 30, 3)
    check(spark, balls, 7, 1)


def test_a_new_batter_every_ball(spark):
    """Rows grow with the balls, although there are as many batters."""
    n, every = 6000, 5
    balls = [("m", f"p{i}", (i * 7919) % 7, i) for i in range(n)]
    df = check(spark, balls, every, 3)
    ranked = contenders(interval_totals(df, every), 3).agg(
        F.sum(F.col("upto") - F.col("from") + 1)).first()[0]
    assert ranked <= CONTEST * n + 3 * n // every          # batters x snapshots would be 3.6 million


def test_short_and_empty_matches(spark):
    check(spark, [("m", "x", 1, i) for i in range(29)], 30, 3)
    check(spark, [("m", "x", 1, i) for i in range(30)], 30, 3)
    assert scorecard_every(spark.createDataFrame([], BALLS)).count() == 0
