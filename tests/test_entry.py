"""Every registered query agrees with its DuckDB statement."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of

LLM = set(entry.llm_registry.queries()) if entry.llm_registry else set()
NAMES = sorted(set(entry.queries()) - LLM)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_every_query_has_a_statement():
    assert sorted(set(entry.oracle_sql()) - LLM) == NAMES


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SMALL)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine == rows_of(columns, result.fetchall())
    assert mine


def test_entry(spark):
    assert entry.entry(spark).count() > 0
