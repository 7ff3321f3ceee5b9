"""Every registered query against its DuckDB SQL at sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from regstar.plans.queries import ORACLES, QUERIES
from regstar.sources.tables import TABLES
from tools.check_oracles import digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_names, d_rows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "TEMP_REGISTRATION_NUMBER" and len(df.columns) == 16
    assert df.count() > 0
