"""The operators that SQL can express, against their SQL."""

import duckdb
import pytest

from sediment.llm.queries import ORACLE, QUERIES
from tests.test_oracle import TABLES, canonical


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    wanted = duck.execute(ORACLE[name])
    names = [column[0] for column in wanted.description]
    assert sorted(frame.columns) == sorted(names)
    got = canonical(frame.columns, frame.collect())
    expected = canonical(names, wanted.fetchall())
    assert len(got) == len(expected)
    assert got == expected
