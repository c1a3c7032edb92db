"""Queries that SQL can express, against it."""

import duckdb
import plain
import pytest

import __spark_entry__ as entry_module
from waymark.llm import registry

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = list(entry_module.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(registry.ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = registry.QUERIES[name](spark, SF)
    names = sorted(found.columns)
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({registry.ORACLES[name]})").fetchall()
    assert plain.as_text(found, *names) == sorted(str(tuple(r)) for r in expected)
