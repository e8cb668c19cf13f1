"""Every query against its SQL in another engine, over whole tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from sediment.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def comparable(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(comparable(row[i])) for i in order) for row in rows)


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


# Queries that treat hot keys apart on large tables.
SKEW_AWARE = sorted(
    name
    for name in QUERIES
    if name.startswith(("snapshot", "silver_re", "gold", "history", "change", "latest", "fact", "fk", "dim"))
)


@pytest.fixture
def everything_is_large(spark):
    """Treat each table as far beyond one task and each frequent key as hot; broadcast nothing."""
    spark.conf.set("spark.sediment.splitBytes", "8b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sediment.splitBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    check(spark, duck, sf_dir, name)


@pytest.mark.parametrize("name", SKEW_AWARE)
def test_query_matches_sql_with_hot_keys(spark, duck, sf_dir, name, everything_is_large):
    check(spark, duck, sf_dir, name)


def check(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    wanted = duck.execute(ORACLE[name])
    names = [column[0] for column in wanted.description]
    assert sorted(frame.columns) == sorted(names)
    got = canonical(frame.columns, frame.collect())
    expected = canonical(names, wanted.fetchall())
    assert len(got) == len(expected)
    assert got == expected
