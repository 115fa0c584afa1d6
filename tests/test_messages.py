"""Message encode / parse, including malformed messages."""
import datetime as dt
import json

from crease.schema import ENVELOPE
from crease.sources.messages import encode_messages, parse_messages
from tests.conftest import rows

# fixed values: the documented sample message
SAMPLE = {"match_id": "2024-04-09", "batting_team": "Sunrisers Hyderabad", "over": 0, "ball": 3,
          "batter": "TM Head", "bowler": "K Rabada", "runs_off_bat": 4, "extras": 0,
          "total_runs": 4, "wicket": None}


def _env(spark, items):
    ts = dt.datetime(2024, 4, 9, 14, 0, 0)
    data = [(None if k is None else k.encode(), v.encode(), "balls", 0, i, ts, 0)
            for i, (k, v) in enumerate(items)]
    return spark.createDataFrame(data, ENVELOPE)


def test_sample_round_trip(spark):
    df = spark.createDataFrame(
        [("2024-04-09", "Sunrisers Hyderabad", "TM Head", "K Rabada", 0, 3, 4, 0, 4, None)],
        "match_id string, batting_team string, batter string, bowler string, over_num int, "
        "ball_num int, runs_off_bat int, extras int, total_runs int, wicket string")
    enc = encode_messages(df).first()
    assert enc.key == "2024-04-09"
    assert json.loads(enc.value) == SAMPLE
    assert '"wicket":null' in enc.value                      # explicit null, not dropped
    parsed = parse_messages(_env(spark, [(enc.key, enc.value)])).first()
    assert (parsed.match_id, parsed.batter, parsed.over_num, parsed.ball_num,
            parsed.runs_off_bat, parsed.total_runs, parsed.wicket) == \
        ("2024-04-09", "TM Head", 0, 3, 4, 4, None)
    assert parsed.message_key == "2024-04-09" and parsed.kafka_offset == 0


def test_malformed_messages(spark):
    good = json.dumps(SAMPLE)
    items = [("m", good),
             ("m", "not json at all"),
             ("m", json.dumps({**SAMPLE, "runs_off_bat": "four"})),
             ("m", json.dumps({k: v for k, v in SAMPLE.items() if k != "batter"})),
             ("m", json.dumps({**SAMPLE, "runs_off_bat": 7})),
             (None, good)]
    env = _env(spark, items)
    kept = rows(parse_messages(env).select("kafka_offset", "message_key"))
    assert kept == [(0, "m"), (5, None)]
    raw = {r.kafka_offset: r for r in parse_messages(env, clean=False).collect()}
    assert raw[1].match_id is None and raw[1].batter is None     # garbage -> nulls
    assert raw[2].runs_off_bat is None and raw[2].batter == "TM Head"
    assert raw[4].runs_off_bat == 7


def test_parse_is_single_pass(spark):
    env = _env(spark, [("m", json.dumps(SAMPLE))])
    plan = parse_messages(env)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_scorecards_need_no_python_worker(spark):
    """Numbering, interval sums and ranking are DataFrame work in batch and stream alike."""
    import re

    from crease.operators.scorecard import scorecard_every
    from crease.sources.testtables import deliveries_from_events
    from tests.conftest import SF_SMALL
    plan = scorecard_every(deliveries_from_events(spark, SF_SMALL))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
