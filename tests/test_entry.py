"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def own_queries():
    """Those of the marts; the training-data operators have tests of their own."""
    return sorted(set(entry_module.queries()) - set(entry_module._LLM_QUERIES))


def test_every_query_has_sql():
    assert set(own_queries()) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_gives_rows(spark):
    found = entry_module.entry(spark)
    assert found.count() > 0
    assert found.columns == entry_module.entry(spark).columns


@pytest.mark.parametrize("name", own_queries())
def test_query_equals_sql(spark, duck, name):
    found = entry_module.queries()[name](spark, TABLES)
    names = sorted(found.columns)
    expected = duck.execute(f"SELECT {', '.join(names)} FROM ({entry_module.oracle_sql()[name]})")
    assert sorted(d[0] for d in expected.description) == names
    as_text = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert as_text(found.select(*names).collect()) == as_text(expected.fetchall())
