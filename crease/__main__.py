"""Command line for the batch and streaming jobs.

    python -m crease season     --docs DIR --out DIR [--json-lines]
    python -m crease daily      --docs DIR --out DIR --run-date YYYY-MM-DD
    python -m crease warehouse  --docs DIR (--out DIR | --jdbc URL [--user U --password P])
    python -m crease lake       --docs DIR --table DIR [--add-phase] [--idempotent]
    python -m crease publish    --docs DIR (--out DIR | --kafka SERVERS --topic T)
    python -m crease scorecards --messages DIR|--kafka SERVERS --topic T --out DIR
    python -m crease live       --messages DIR|--kafka SERVERS --topic T --out DIR --checkpoint DIR
                                [--mode complete|update] [--once]
    python -m crease scorecard-stream  (same source options) --out DIR --checkpoint DIR [--once]
        (live / scorecard-stream: --max-per-trigger N bounds each micro-batch.  Files
         are taken in modification-time order, so for the order-sensitive
         scorecard publish files in offset order, one append per range.)

Documents are read as one JSON object per file unless ``--json-lines``.
Message files are Parquet files of the message-bus envelope.
"""
from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from crease import schema as S
from crease.functions import phase


def _docs(spark, a):
    from crease.sources.matches import flatten, read_match_documents
    return flatten(read_match_documents(spark, a.docs, multi_line=not a.json_lines, glob=_glob(a)))


def _glob(a) -> str | None:
    return None if a.json_lines else "*.json"


def _messages(spark, a, streaming: bool):
    from crease.sources.messages import read_messages
    cap = getattr(a, "max_per_trigger", None)
    if a.kafka:
        opts = {"kafka.bootstrap.servers": a.kafka, "subscribe": a.topic}
        if streaming and cap:
            opts["maxOffsetsPerTrigger"] = str(cap)
        return read_messages(spark, streaming=streaming, fmt="kafka", **opts)
    opts = {"maxFilesPerTrigger": str(cap)} if streaming and cap else {}
    return read_messages(spark, streaming=streaming, fmt="parquet", path=a.messages, **opts)


def cmd_season(spark, a):
    from crease.plans.season import run_season
    return run_season(spark, a.docs, a.out, multi_line=not a.json_lines, glob=_glob(a))


def cmd_daily(spark, a):
    from crease.plans.daily import run_daily
    rep = run_daily(spark, _docs(spark, a), a.out, a.run_date, inputs_path=a.docs,
                    inputs_glob=_glob(a) or "*")
    return rep.first().asDict()


def cmd_warehouse(spark, a):
    from crease.operators.warehouse import warehouse_tables
    from crease.sources import warehouse_io as WIO
    target = ({"jdbc": a.jdbc, "properties": {"user": a.user or "", "password": a.password or ""}}
              if a.jdbc else {"path": a.out})
    WIO.refresh_tables(warehouse_tables(_docs(spark, a)), target)
    return {"batters": [r.asDict() for r in WIO.verify_top_batters(spark, target).collect()],
            "bowlers": [r.asDict() for r in WIO.verify_top_bowlers(spark, target).collect()]}


def cmd_lake(spark, a):
    from crease.operators import lake as LK
    rows = LK.lake_rows(_docs(spark, a))
    if a.add_phase:
        rows = rows.withColumn("phase", phase("over_num", S.PHASE_SHORT))
    schema = LK.lake_schema(*((("phase", "string"),) if a.add_phase else ()))
    load = (LK.append_new(rows, a.table, schema=schema) if a.idempotent
            else LK.append_load(rows, a.table, schema=schema))
    table = LK.scan(spark, a.table, schema)
    added = table.filter(f"load_id = {load}").count()
    return {"load": load, "added": added, **LK.lake_quick_stats(table).first().asDict()}


def cmd_publish(spark, a):
    from pyspark.sql import functions as F

    from crease.sources.messages import encode_messages, to_envelope, write_messages
    from crease.sources.storage import matching
    balls = _docs(spark, a)
    if a.kafka:
        write_messages(encode_messages(balls), "kafka",
                       **{"kafka.bootstrap.servers": a.kafka, "topic": a.topic})
        return {"published": True}
    # file envelope: offsets follow document order within each file, after those
    # that earlier publishes have given out
    first = 0
    if matching(spark, f"{a.out.rstrip('/')}/*.parquet"):
        first = spark.read.parquet(a.out).agg(F.max("offset")).first()[0] + 1
    numbered = (balls.withColumn("kafka_offset", F.monotonically_increasing_id() + F.lit(first))
                .withColumn("event_time", F.current_timestamp()))
    to_envelope(numbered).write.mode("append").parquet(a.out)
    return {"published": True, "first_offset": first}


def cmd_scorecards(spark, a):
    from crease.operators.scorecard import fall_of_wickets, scorecard_every, scorecard_final
    from crease.sources.messages import parse_messages
    balls = parse_messages(_messages(spark, a, streaming=False), clean=False)
    scorecard_every(balls).write.mode("overwrite").parquet(f"{a.out}/every_30")
    scorecard_final(balls).write.mode("overwrite").parquet(f"{a.out}/final")
    fall_of_wickets(balls).write.mode("overwrite").parquet(f"{a.out}/fall_of_wickets")
    return {"written": a.out}


def _run_stream(q, once: bool):
    if once:
        q.awaitTermination()
    else:
        try:
            q.awaitTermination()
        except KeyboardInterrupt:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def cmd_live(spark, a):
    from crease.sources.messages import parse_messages
    from crease.streaming.live import start_live_stats
    trigger = {"availableNow": True} if a.once else None
    q = start_live_stats(parse_messages(_messages(spark, a, streaming=True)), a.out,
                         a.checkpoint, mode=a.mode, trigger=trigger)
    _run_stream(q, a.once)
    return {"stopped": True}


def cmd_scorecard_stream(spark, a):
    from crease.sources.messages import parse_messages
    from crease.streaming.scorecard_stream import start_scorecard_stream
    trigger = {"availableNow": True} if a.once else None
    q = start_scorecard_stream(parse_messages(_messages(spark, a, streaming=True), clean=False),
                               a.out, a.checkpoint, trigger=trigger)
    _run_stream(q, a.once)
    return {"stopped": True}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m crease")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def docs_cmd(name, fn):
        c = sub.add_parser(name)
        c.add_argument("--docs", required=True)
        c.add_argument("--json-lines", action="store_true")
        c.set_defaults(fn=fn)
        return c

    c = docs_cmd("season", cmd_season)
    c.add_argument("--out", required=True)
    c = docs_cmd("daily", cmd_daily)
    c.add_argument("--out", required=True)
    c.add_argument("--run-date", required=True)
    c = docs_cmd("warehouse", cmd_warehouse)
    c.add_argument("--out")
    c.add_argument("--jdbc")
    c.add_argument("--user")
    c.add_argument("--password")
    c = docs_cmd("lake", cmd_lake)
    c.add_argument("--table", required=True)
    c.add_argument("--add-phase", action="store_true")
    c.add_argument("--idempotent", action="store_true")
    c = docs_cmd("publish", cmd_publish)
    c.add_argument("--out")
    c.add_argument("--kafka")
    c.add_argument("--topic", default="balls")

    def msg_cmd(name, fn):
        c = sub.add_parser(name)
        c.add_argument("--messages")
        c.add_argument("--kafka")
        c.add_argument("--topic", default="balls")
        c.add_argument("--out", required=True)
        c.set_defaults(fn=fn)
        return c

    msg_cmd("scorecards", cmd_scorecards)
    for name, fn in (("live", cmd_live), ("scorecard-stream", cmd_scorecard_stream)):
        c = msg_cmd(name, fn)
        c.add_argument("--checkpoint", required=True)
        c.add_argument("--once", action="store_true")
        c.add_argument("--max-per-trigger", type=int,
                       help="bound each micro-batch: offsets (kafka) or files")
        if name == "live":
            c.add_argument("--mode", choices=["complete", "update"], default="complete")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    if spark is None:
        from crease.session import build_session
        spark = build_session(a.master, app_name=f"crease-{a.cmd}")
    out = a.fn(spark, a)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
