"""Every query with SQL gives DuckDB's rows; the others run and have rows."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from sondage.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return str(v)[:19]
    return str(v) if isinstance(v, datetime.date) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    if name not in ORACLES:
        assert got
        return
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == names
    want = sorted((tuple(plain(r[cols.index(c)]) for c in names) for r in res.fetchall()), key=str)
    assert len(got) == len(want)
    assert [x for x in zip(got, want, strict=True) if x[0] != x[1]][:5] == []
