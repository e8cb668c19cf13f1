"""Row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.columns import require_columns
from sediment.functions.types import json_text

HASH_COLUMN = "hash_column"
# Columns a row hash leaves out unless told otherwise.
NOT_HASHED = ("ingestion_timestamp", "source", "version", HASH_COLUMN)
# What stands in for null, and what separates the columns.
NULL_TEXT = "NULL"
SEPARATOR = "|"


def hashed_columns(df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = NOT_HASHED) -> list[str]:
    """The ordered columns a hash covers: those named, which must exist, or all but ``exclude``."""
    if columns is not None:
        require_columns({"hashed frame": df}, columns, "columns to hash")
    return list(columns) if columns is not None else [c for c in df.columns if c not in exclude]


def _text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    return json_text(value) if nested else value.cast("string")


def hash_expression(df: DataFrame, columns: Sequence[str], strict: bool = False) -> Column:
    """SHA-256 over the columns in the given order.

    The default form joins the texts with a bar, so a null equals the text NULL and a
    bar inside a value can shift a column border. ``strict`` hashes the row as JSON,
    which keeps all of these apart.
    """
    if strict:
        body = json_text(F.struct(*[F.col(f"`{name}`") for name in columns]))
    else:
        body = F.concat_ws(SEPARATOR, *[F.coalesce(_text(df.schema[name]), F.lit(NULL_TEXT)) for name in columns])
    # Never null; saying so spares joins on the hash a null filter that hashes again.
    return F.coalesce(F.sha2(body, 256), F.lit(""))


def add_row_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    name: str = HASH_COLUMN,
    exclude: Sequence[str] = NOT_HASHED,
    strict: bool = False,
) -> DataFrame:
    """Add the row hash; stays inside generated code, no Python per row."""
    return df.withColumn(name, hash_expression(df, hashed_columns(df, columns, exclude), strict))
