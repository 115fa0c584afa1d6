"""Match-document edge cases (hand-written files)."""
import json
import os

import pytest
from pyspark.sql import functions as F

from crease.operators import warehouse as WH
from crease.operators.leaderboards import phase_stats
from crease.operators.quality import clean
from crease.sources import matches as M
from crease.sources.testtables import deliveries_from_lineitem
from tests.conftest import SF_SMALL, rows


def _doc(dates=("2024-04-09",), venue="Wankhede", teams=("A", "B"), innings=None):
    info = {}
    if dates is not None:
        info["dates"] = list(dates)
    if venue is not None:
        info["venue"] = venue
    if teams is not None:
        info["teams"] = list(teams)
    d = {"info": info}
    if innings is not None:
        d["innings"] = innings
    return d


def _ball(batter="X", bowler="Y", runs=(0, 0, 0), wickets=None, **kw):
    b = {"batter": batter, "bowler": bowler}
    if runs is not None:
        b["runs"] = {"batter": runs[0], "extras": runs[1], "total": runs[2]}
    if wickets is not None:
        b["wickets"] = wickets
    b.update(kw)
    return b


def _write(folder, name, obj, pretty=True):
    with open(os.path.join(folder, name), "w") as f:
        if isinstance(obj, str):
            f.write(obj)
        else:
            json.dump(obj, f, indent=2 if pretty else None)


@pytest.fixture()
def docs_dir(tmp_dir):
    inn = [{"team": "A", "overs": [
        {"over": 0, "deliveries": [
            _ball("P", "Q", (4, 0, 4)),
            _ball("P", "Q", (1, 1, 2), wickets=[]),
            _ball("R", "Q", (0, 0, 0), wickets=[{"kind": "bowled"}, {"kind": "run out"}]),
        ]},
        {"over": 19, "deliveries": [_ball("S", None, (6, 0, 6))]},
        {"over": 20, "deliveries": [_ball("", "Q", (7, 0, 7))]},
    ]}, {"team": "B|C", "overs": [{"deliveries": [_ball("  ", "Z", None)]}]}]
    _write(tmp_dir, "m1.json", _doc(innings=inn))
    _write(tmp_dir, "m2.json", _doc(dates=None, venue=None, innings=[
        {"team": "B", "overs": [{"over": 1, "deliveries": [{"bowler": "Q"}]}]}]))
    _write(tmp_dir, "m3.json", _doc(dates=[], innings=[
        {"team": "B", "overs": [{"over": 2, "deliveries": [_ball("T", "Q", (2, 0, 2))]}]}]))
    _write(tmp_dir, "m4.json", _doc(innings=None))                  # no innings
    _write(tmp_dir, "m5.json", "{ this is not json")                  # corrupt file
    _write(tmp_dir, "m6.json", _doc(innings=[                          # wrong-typed field
        {"team": "A", "overs": [{"over": "x", "deliveries": [_ball("U", "Q", (1, 0, 1))]}]}]))
    _write(tmp_dir, "m7.json", _doc(dates=("2024-04-09",), venue="Eden", innings=[
        {"team": "B", "overs": [{"over": 3, "deliveries": [_ball("V", "W", (3, 0, 3))]}]}]))
    _write(tmp_dir, "notes.txt", "ignored")
    return tmp_dir


def test_flatten_defaults_and_positions(spark, docs_dir):
    docs = M.read_match_documents(spark, docs_dir)
    flat = M.flatten(docs)
    got = rows(flat.select("match_id", "venue", "batting_team", "batter", "bowler", "over_num",
                           "ball_num", "runs_off_bat", "extras", "total_runs", "wicket"))
    assert ("2024-04-09", "Wankhede", "A", "P", "Q", 0, 1, 4, 0, 4, None) in got
    assert ("2024-04-09", "Wankhede", "A", "P", "Q", 0, 2, 1, 1, 2, None) in got  # wickets: []
    assert ("2024-04-09", "Wankhede", "A", "R", "Q", 0, 3, 0, 0, 0, "bowled") in got  # first only
    assert ("2024-04-09", "Wankhede", "A", "S", "", 19, 1, 6, 0, 6, None) in got  # null bowler
    assert ("2024-04-09", "Wankhede", "A", "", "Q", 20, 1, 7, 0, 7, None) in got
    assert ("2024-04-09", "Wankhede", "B|C", "  ", "Z", 0, 1, 0, 0, 0, None) in got  # no runs/over
    assert ("unknown", "unknown", "B", "", "Q", 1, 1, 0, 0, 0, None) in got      # missing dates
    assert ("unknown", "Wankhede", "B", "T", "Q", 2, 1, 2, 0, 2, None) in got    # empty dates
    assert ("2024-04-09", "Eden", "B", "V", "W", 3, 1, 3, 0, 3, None) in got
    assert len(got) == 9                                       # m4 no rows, m5/m6 quarantined
    dates = {r[0]: r[1] for r in flat.select("match_id", "match_date").distinct().collect()}
    assert dates["unknown"] is None and str(dates["2024-04-09"]) == "2024-04-09"


def test_quarantine_is_whole_file(spark, docs_dir):
    docs = M.read_match_documents(spark, docs_dir)
    q = rows(M.quarantine(docs).select(F.regexp_extract("file_path", r"(m\d)\.json", 1),
                                       "match_id"))
    assert q == [("m5", None), ("m6", "2024-04-09")]
    rep = M.quarantine_report(docs).first()
    assert (rep.documents, rep.valid_documents, rep.quarantined_documents) == (7, 5, 2)
    assert rep.deliveries == 9


def test_same_date_matches_merge_venue_from_last_file(spark, docs_dir):
    flat = M.flatten(M.read_match_documents(spark, docs_dir))
    summary = {r.match_date: r for r in WH.wh_match_summary(flat).collect()}
    assert summary["2024-04-09"].venue == "Eden"        # m7 sorts after m1
    assert summary["2024-04-09"].total_runs == 4 + 1 + 0 + 6 + 7 + 0 + 3


def test_titles(spark, docs_dir):
    t = dict(rows(M.match_titles(M.read_match_documents(spark, docs_dir))))
    assert t["2024-04-09"] == "A vs B"


def test_phases_over_19_and_20(spark, docs_dir):
    flat = clean(M.flatten(M.read_match_documents(spark, docs_dir)))
    free = {(r.batting_team, r.phase): r.balls for r in phase_stats(flat).collect()}
    assert free[("A", "Death (16-20)")] == 1             # over 19; over 20 had runs 7
    bounded = {(r.batting_team, r.phase) for r in phase_stats(flat, bounded=True).collect()}
    assert ("A", "Death (16-20)") in bounded


def test_validate_inputs(spark, docs_dir, tmp_dir):
    assert M.validate_inputs(spark, docs_dir).first()["files"] == 7
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    with pytest.raises(ValueError):
        M.validate_inputs(spark, empty)


def test_nest_then_flatten_round_trip(spark, tmp_dir):
    data = [("2024-01-01", "v1", "A", "P", "Q", 0, 1, 4, 0, 4, None),
            ("2024-01-01", "v1", "A", None, "Q", 0, 2, 1, 1, 2, "caught"),
            ("2024-01-01", "v1", "B", "R", None, 5, 1, 0, 0, 0, ""),
            ("2024-01-02", "v2", "B", "  ", "Z", 19, 1, 6, 0, 6, None)]
    df = spark.createDataFrame(data, "match_id string, venue string, batting_team string, "
                                     "batter string, bowler string, over_num int, ball_num int, "
                                     "runs_off_bat int, extras int, total_runs int, wicket string")
    path = os.path.join(tmp_dir, "docs")
    M.write_match_documents(df, path)
    flat = M.flatten(M.read_match_documents(spark, path, multi_line=False, glob=None))
    got = rows(flat.select("match_id", "venue", "batting_team", "batter", "bowler", "over_num",
                           "ball_num", "runs_off_bat", "extras", "total_runs", "wicket"))
    assert got == rows(df.select(
        "match_id", "venue", "batting_team", F.coalesce("batter", F.lit("")),
        F.coalesce("bowler", F.lit("")), "over_num", "ball_num", "runs_off_bat", "extras",
        "total_runs", F.nullif("wicket", F.lit(""))))


def test_documents_are_written_compressed(spark, tmp_dir):
    raw, written = deliveries_from_lineitem(spark, SF_SMALL), os.path.join(tmp_dir, "docs")
    M.write_match_documents(raw, written)
    lines = spark.read.text(written)
    size = sum(os.path.getsize(os.path.join(written, f)) for f in os.listdir(written) if f.startswith("part-"))
    chars, = lines.agg(F.sum(F.length("value"))).first()
    assert 0 < size * 4 < chars
    assert M.flatten(M.read_match_documents(spark, written, multi_line=False, glob=None)).count() == raw.count()


def test_season_job(spark, docs_dir, tmp_dir):
    from crease.plans.season import read_top_batters_csv, run_season
    out = os.path.join(tmp_dir, "season")
    audit = run_season(spark, docs_dir, out)
    # null bowler reads back as "" (kept); runs 7, blank and missing batters are removed
    assert audit == {"rows_before": 9, "rows_after": 6, "rows_removed": 3}
    top = rows(read_top_batters_csv(spark, os.path.join(out, "top_batters_csv")))
    assert ("P", 5, 2, 1, 0, 250.0) in top and len(top) == 5
    assert spark.read.parquet(os.path.join(out, "top_bowlers")).count() == 0   # nobody has 60 balls
    for stage in ("cache", None):
        other = run_season(spark, docs_dir, os.path.join(tmp_dir, f"season-{stage}"), stage=stage)
        assert other == audit
        assert rows(read_top_batters_csv(
            spark, os.path.join(tmp_dir, f"season-{stage}", "top_batters_csv"))) == top
