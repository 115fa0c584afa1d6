"""A hot match far beyond one block of either scan; results equal an incremental
brute force."""
import random

from crease.operators.scorecard import fall_of_wickets, scorecard_every
from tests.conftest import rows


def _brute_force(balls, every=30, top=3):
    out, state, counts = [], {}, {}
    for m, off, b, r, _w in sorted(balls, key=lambda t: t[1]):
        st = state.setdefault(m, {})
        runs, n, first = st.get(b, (0, 0, off))
        st[b] = (runs + r, n + 1, first)
        counts[m] = counts.get(m, 0) + 1
        if counts[m] % every == 0:
            ranked = sorted(st.items(), key=lambda kv: (-kv[1][0], kv[1][2]))[:top]
            for pos, (bat, (rr, nn, _f)) in enumerate(ranked, 1):
                out.append((m, counts[m], pos, bat, rr, nn))
    return sorted(out)


def test_hot_match_scorecard_and_wickets(spark):
    rnd = random.Random(11)
    balls, off = [], 0
    for m, n, squad in (("hot", 130_000, 6), ("a", 95, 4), ("b", 61, 3)):
        for _ in range(n):
            off += rnd.randint(1, 2)
            balls.append((m, off, f"p{rnd.randrange(squad)}", rnd.randint(0, 6),
                          "caught" if rnd.random() < 0.03 else None))
    rnd.shuffle(balls)
    df = spark.createDataFrame(balls, "match_id string, kafka_offset long, batter string, "
                                      "runs_off_bat int, wicket string")
    got = rows(scorecard_every(df).select("match_id", "after_balls", "position", "batter",
                                          "runs", "balls"))
    want = _brute_force(balls)
    assert len(want) > 3 * 4096                       # several blocks of intervals
    assert sorted(got) == want
    w = fall_of_wickets(df.withColumn("over_num", df.kafka_offset % 20)
                          .withColumn("ball_num", df.kafka_offset % 6))
    hot = sorted((r.kafka_offset, r.wicket_no) for r in w.filter("match_id = 'hot'").collect())
    assert [n for _, n in hot] == list(range(1, len(hot) + 1))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_BALL = st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.integers(1, 3),
                  st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 7),
                  st.sampled_from([None, None, None, "", "bowled"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_BALL, min_size=1, max_size=240), st.sampled_from([2, 5, 64, None]))
def test_scorecard_property(spark, raw, block):
    balls, off = [], 0
    for m, gap, b, r, w in raw:
        off += gap
        balls.append((m, off, b, r, w))
    df = spark.createDataFrame(balls, "match_id string, kafka_offset long, batter string, "
                                      "runs_off_bat int, wicket string")
    norm = [(m, o, b if b is not None else "unknown", r, w) for m, o, b, r, w in balls]
    got = sorted(tuple(r) for r in scorecard_every(df, block_width=block).select(
        "match_id", "after_balls", "position", "batter", "runs", "balls").collect())
    assert got == _brute_force(norm)
    w = fall_of_wickets(df.withColumn("over_num", df.kafka_offset % 20)
                          .withColumn("ball_num", df.kafka_offset % 6), block_width=block)
    per = {}
    for r in sorted(w.collect(), key=lambda r: r.kafka_offset):
        per.setdefault(r.match_id, []).append(r.wicket_no)
    assert all(v == list(range(1, len(v) + 1)) for v in per.values())
    assert sum(map(len, per.values())) == sum(1 for *_, wk in balls if wk)
