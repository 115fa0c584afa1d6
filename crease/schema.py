"""Schemas and fixed labels.

FIXED VALUES (must equal the source application's for equal results):
  phase labels, long form:  "Powerplay (1-6)", "Middle (7-15)", "Death (16-20)"
  phase labels, short form: "Powerplay", "Middle", "Death"
  phase boundaries (0-based over): over <= 5 -> first, over <= 14 -> second, else third
  bounded phase form drops overs outside 0..19
  minimum balls for the bowler leaderboard: 60
  leaderboard size: 10; warehouse read-back size: 5; scorecard interval: 30 balls, top 3
  runs off the bat are valid in 0..6
  default name for a missing batter in the scorecards: "unknown"
  default match id / venue for a missing value: "unknown"
"""
from __future__ import annotations

from pyspark.sql import types as T

PHASE_LONG = ("Powerplay (1-6)", "Middle (7-15)", "Death (16-20)")
PHASE_SHORT = ("Powerplay", "Middle", "Death")
POWERPLAY_LAST_OVER = 5
MIDDLE_LAST_OVER = 14
BOUNDED_LAST_OVER = 19
MIN_BALLS_BOWLED = 60
TOP_N = 10
READBACK_N = 5
SCORECARD_EVERY = 30
SCORECARD_TOP = 3
MIN_RUNS, MAX_RUNS = 0, 6
UNKNOWN = "unknown"

# One match document (one JSON object): info + innings -> overs -> deliveries.
RUNS = T.StructType([
    T.StructField("batter", T.IntegerType()),
    T.StructField("extras", T.IntegerType()),
    T.StructField("total", T.IntegerType()),
])
WICKET = T.StructType([T.StructField("kind", T.StringType())])
DELIVERY = T.StructType([
    T.StructField("batter", T.StringType()),
    T.StructField("bowler", T.StringType()),
    T.StructField("runs", RUNS),
    T.StructField("wickets", T.ArrayType(WICKET)),
])
OVER = T.StructType([
    T.StructField("over", T.IntegerType()),
    T.StructField("deliveries", T.ArrayType(DELIVERY)),
])
INNINGS = T.StructType([
    T.StructField("team", T.StringType()),
    T.StructField("overs", T.ArrayType(OVER)),
])
INFO = T.StructType([
    T.StructField("dates", T.ArrayType(T.StringType())),
    T.StructField("venue", T.StringType()),
    T.StructField("teams", T.ArrayType(T.StringType())),
])
MATCH = T.StructType([
    T.StructField("info", INFO),
    T.StructField("innings", T.ArrayType(INNINGS)),
])
MATCH_WITH_CORRUPT = T.StructType(MATCH.fields + [T.StructField("_corrupt_record", T.StringType())])

# The flat delivery fact (one row per ball).
DELIVERY_COLUMNS = ["match_id", "match_date", "venue", "batting_team", "batter", "bowler",
                    "over_num", "ball_num", "runs_off_bat", "extras", "total_runs", "wicket"]

# Ball message value (JSON) as read by the stream; extra keys are ignored.
EVENT = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("batting_team", T.StringType()),
    T.StructField("batter", T.StringType()),
    T.StructField("bowler", T.StringType()),
    T.StructField("over", T.IntegerType()),
    T.StructField("ball", T.IntegerType()),
    T.StructField("runs_off_bat", T.IntegerType()),
    T.StructField("total_runs", T.IntegerType()),
    T.StructField("wicket", T.StringType()),
])

# Message-bus envelope (same columns as the Kafka source).
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# Lake table: 14 columns with stable field ids, identity-partitioned by batting_team.
LAKE_FIELDS = [
    (1, "match_id", "string"), (2, "match_date", "string"), (3, "venue", "string"),
    (4, "batting_team", "string"), (5, "batter", "string"), (6, "bowler", "string"),
    (7, "over_num", "int"), (8, "ball_num", "int"), (9, "runs_off_bat", "int"),
    (10, "total_runs", "int"), (11, "extras", "int"), (12, "wicket_kind", "string"),
    (13, "is_boundary", "boolean"), (14, "is_six", "boolean"),
]
LAKE_PARTITION = "batting_team"
