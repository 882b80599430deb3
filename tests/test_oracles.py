"""Every registered query with an oracle, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_oracles import canonical
from waypost.plans.fixtures import TABLES

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()

@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_registry():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    have = canonical([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert have == canonical(cur.fetchall(), cols)
