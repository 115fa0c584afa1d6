"""Deliveries derived from the supplied test tables.

The supplied tables are generic (``lineitem``, ``events``); these two column
mappings give them the shape of the delivery fact and of the ball stream.
They are plain SQL expressions so the same text drives the Spark
``selectExpr`` and the DuckDB oracle.

FIXED VALUES: the expressions below are the agreed adapter definitions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# deliveries_from_lineitem (L): order-insensitive operators.
LINEITEM_DELIVERIES = [
    ("match_id", "cast(cast(l_shipdate as date) as varchar(10))"),
    ("match_date", "cast(l_shipdate as date)"),
    ("doc_no", "l_orderkey"),
    ("venue", "concat('venue_', cast(extract(day from l_shipdate)%8 as int))"),
    ("batting_team", "concat('team_', l_orderkey%12)"),
    ("batter", "case when l_partkey%97=0 then '' when l_partkey%89=0 then '  ' "
               "when l_partkey%83=0 then null else concat('batter_', l_partkey%200) end"),
    ("bowler", "case when l_partkey%101=0 then null when l_quantity=50 "
               "then concat('bowler_pt_', l_partkey%40) else concat('bowler_', l_suppkey) end"),
    ("over_num", "cast(l_quantity as int)%22"),
    ("ball_num", "l_linenumber"),
    ("runs_off_bat", "cast(round(l_tax*100) as int)"),
    ("extras", "l_linenumber%2"),
    ("total_runs", "cast(round(l_tax*100) as int)+l_linenumber%2"),
    ("wicket", "case when l_suppkey%10=0 then null when l_partkey%53=0 then '' "
               "when l_returnflag='R' and l_linestatus='F' and l_partkey%4=0 then "
               "case l_partkey%3 when 0 then 'caught' when 1 then 'bowled' else 'run out' end end"),
]

# deliveries_from_events (E): streams and order-sensitive operators.
EVENT_DELIVERIES = [
    ("kafka_offset", "event_id"),
    ("event_time", "ts"),
    ("match_id", "cast(cast(ts as date) as varchar(10))"),
    ("batting_team", "concat('team_', user_id%12)"),
    ("batter", "case when user_id%29=0 then null else concat('batter_', user_id%40) end"),
    ("bowler", "concat('bowler_', user_id%11)"),
    ("over_num", "cast(floor(cast(event_id%120 as int)/6) as int)"),
    ("ball_num", "cast(event_id%120 as int)%6+1"),
    ("runs_off_bat", "cast(floor(value) as int)%8"),
    ("total_runs", "cast(floor(value) as int)%8 + case when event_type='view' then 1 else 0 end"),
    ("wicket", "case event_type when 'error' then case when user_id%3=0 then 'caught' "
               "else 'bowled' end end"),
]


def _select_sql(cols, table: str) -> str:
    return "SELECT " + ",\n       ".join(f"{e} AS {n}" for n, e in cols) + f"\nFROM {table}"


LINEITEM_DELIVERIES_SQL = _select_sql(LINEITEM_DELIVERIES, "lineitem")
EVENT_DELIVERIES_SQL = _select_sql(EVENT_DELIVERIES, "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def deliveries_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (uncleaned) delivery fact from ``lineitem``; reads only 9 columns."""
    return read_table(spark, sf_dir, "lineitem").selectExpr(
        *[f"{e} AS {n}" for n, e in LINEITEM_DELIVERIES])


def deliveries_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered ball stream rows from ``events`` (offset = event_id)."""
    return read_table(spark, sf_dir, "events").selectExpr(
        *[f"{e} AS {n}" for n, e in EVENT_DELIVERIES])
