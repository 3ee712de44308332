"""Every query of the engine against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

from waymark.plans import network_queries, relational_queries, resolution_queries, scalar_queries, supply_queries  # noqa: F401
from waymark.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return f"{float(value):.9g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    theirs = duck.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = sorted("|".join(plain(v) for v in r) for r in theirs.fetchall())
    assert sorted("|".join(plain(r[c]) for c in columns) for r in ours.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()
