"""Every registered query against its DuckDB oracle on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as E
from conflux.plans import registry
from tests.test_plans import forbidden_in
from tools.oracle_check import TABLES, digest

#: The llm queries have tests of their own.
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.ORACLES) == set(NAMES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    assert not forbidden_in(df), f"{name}: {forbidden_in(df)}"
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "job_inst_id" in df.columns
