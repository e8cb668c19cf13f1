"""Catalog and database readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def qualified(table: str, schema: str | None = None) -> str:
    return f"{schema}.{table}" if schema else table


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """A whole catalog table as it stands; Spark prunes columns and partitions by the query.

    The refresh forgets an older file list: another session may have loaded the table
    since, as the handler of a stream does.
    """
    try:
        spark.catalog.refreshTable(qualified(table, schema))
        return spark.table(qualified(table, schema))
    except PySparkException as error:
        raise ValueError(f"Failed to read '{qualified(table, schema)}' from the catalog: {error}") from error


def table_exists(spark: SparkSession, table: str, schema: str | None = None) -> bool:
    return spark.catalog.tableExists(qualified(table, schema))


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    return [table.name for table in spark.catalog.listTables(schema) if not table.isTemporary]


def read_query(spark: SparkSession, query: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """SQL over catalog tables and views. ``:name`` markers take bound values, never text."""
    return spark.sql(query, args=dict(params or {}))


def jdbc_options(url: str, properties: Mapping[str, object] | None = None) -> dict[str, str]:
    """Connection options; user, password, driver and fetchsize go into ``properties``."""
    if not url.startswith("jdbc:"):
        raise ValueError("a database URL starts with jdbc:")
    return {"url": url, **{key: str(value) for key, value in (properties or {}).items()}}


def read_database_table(
    spark: SparkSession,
    table: str,
    url: str,
    schema: str | None = None,
    properties: Mapping[str, object] | None = None,
    partition_column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table, read by ``partitions`` parallel range queries.

    The range ends come from one min/max query that the database answers. Filters and
    column lists reach the database.
    """
    name = qualified(table, schema)
    try:
        reader = spark.read.format("jdbc").options(**jdbc_options(url, properties)).option("dbtable", name)
        if partition_column and partitions > 1:
            ends = reader.load().agg(F.min(partition_column).alias("lo"), F.max(partition_column).alias("hi")).first()
            if ends.lo is not None:
                reader = reader.options(
                    partitionColumn=partition_column,
                    lowerBound=str(ends.lo),
                    upperBound=str(ends.hi),
                    numPartitions=partitions,
                )
        return reader.load()
    except PySparkException as error:
        raise ValueError(f"Failed to read '{name}' from the database: {error}") from error


def read_database_query(
    spark: SparkSession,
    query: str,
    url: str,
    tables: Mapping[str, str],
    params: Mapping[str, object] | None = None,
    properties: Mapping[str, object] | None = None,
) -> DataFrame:
    """SQL with bound values over database tables.

    ``tables`` maps the names used in the query to database tables. Each becomes a view,
    so values are bound by Spark and filters still travel to the database.
    """
    for view, table in tables.items():
        read_database_table(spark, table, url, properties=properties).createOrReplaceTempView(view)
    return read_query(spark, query, params)
