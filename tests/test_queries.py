"""Every registered query of the tables against DuckDB on the source files."""

import duckdb
import pytest

from tablelog import queries
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))
    told = duck.sql(queries.SQL[name])
    assert sorted(told.columns) == columns
    assert got == sorted(tuple(map(str, r)) for r in told.select(*(f'"{c}"' for c in columns)).fetchall())
    assert got
