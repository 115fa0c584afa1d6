"""Reading snapshot history and columns from table metadata JSON (own fixture)."""
import json
import os

from crease.sources.table_metadata import read_current_metadata, snapshot_history, table_columns


def _fields(n):
    names = ["match_id", "match_date", "venue", "batting_team", "batter", "bowler", "over_num",
             "ball_num", "runs_off_bat", "total_runs", "extras", "wicket_kind", "is_boundary",
             "is_six", "phase"][:n]
    types = ["string"] * 6 + ["int"] * 5 + ["string", "boolean", "boolean", "string"]
    return [{"id": i + 1, "name": nm, "type": types[i], "required": False}
            for i, nm in enumerate(names)]


def _meta(version, ts, snapshots, schemas, current):
    return {"format-version": 2, "last-updated-ms": ts, "current-schema-id": current,
            "schemas": [{"type": "struct", "schema-id": sid, "fields": _fields(n)}
                        for sid, n in schemas],
            "snapshots": [{"snapshot-id": sid, "sequence-number": seq, "timestamp-ms": t,
                           "schema-id": 0,
                           "summary": {"operation": "append", "added-records": str(n),
                                       "total-records": str(n), "added-data-files": "12"}}
                          for sid, seq, t, n in snapshots],
            "snapshot-log": [{"snapshot-id": sid, "timestamp-ms": t} for sid, _, t, _ in snapshots]}


def test_history_and_columns(spark, tmp_dir):
    d = os.path.join(tmp_dir, "metadata")
    os.makedirs(d)
    snap = [(777, 1, 1_700_000_010_000, 2263)]
    docs = [_meta(0, 1_700_000_000_000, [], [(0, 14)], 0),
            _meta(1, 1_700_000_010_000, snap, [(0, 14)], 0),
            _meta(2, 1_700_000_011_000, snap, [(0, 14), (1, 15)], 1)]
    for i, doc in enumerate(docs):
        with open(os.path.join(d, f"0000{i}-x.metadata.json"), "w") as f:
            json.dump(doc, f)
    with open(os.path.join(d, "snap-777.avro"), "w") as f:
        f.write("not metadata")
    meta = read_current_metadata(spark, d)
    hist = [tuple(r) for r in snapshot_history(meta).collect()]
    assert hist == [(1, 777, "2023-11-14 22:13:30", "append", 2263, 2263, 12, 0)]
    cols = [(r.field_id, r.name, r.type) for r in table_columns(meta).collect()]
    assert len(cols) == 15 and cols[-1] == (15, "phase", "string") and cols[0][1] == "match_id"
