"""A sample of the registered queries against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from circlet.plans.oracles import ORACLES
from circlet.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
SAMPLE = ("c_positions", "r_competitive", "m_hits", "d_pairs", "d_events", "q_conflicts", "k_clusters", "k_numbered", "p_spanning", "f_impact", "z_checks")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value if isinstance(value, str) else round(float(value), 6)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted((tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False)), key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, name):
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    assert rows(QUERIES[name](spark, str(DATA)).toPandas()) == rows(con.execute(ORACLES[name]).df())


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
