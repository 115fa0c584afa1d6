"""Every registered query with oracle SQL equals DuckDB on the same tables (sf0.001)."""
import datetime as dt
import math
import os
import pathlib

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_is_registered_with_oracle_where_sql_can_express_it():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # what has no SQL form is tested against plain Python in tests/llm, by its name
    tests = "".join(p.read_text() for p in pathlib.Path(__file__).parent.glob("llm/test_*.py"))
    assert {n for n in set(q) - set(o) if n not in tests} == set()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(E.oracle_sql()[name])
    want = _canon(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["batter", "runs", "balls_faced", "fours", "sixes", "strike_rate"]
    assert 0 < df.count() <= 10
