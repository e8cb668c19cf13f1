"""File writers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.types import json_text
from sediment.sources.files import CSV_OPTIONS, ERRORED, STAGED, check_file_type, staged_path


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that hold only plain values."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(
        [
            json_text(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, field_names: Sequence[str], mode: str = "errorifexists") -> None:
    """CSV with a header and the columns in the given order.

    A field the frame lacks is written empty; a column that is not a field is an error.
    """
    unexpected = [name for name in df.columns if name not in field_names]
    if unexpected:
        raise ValueError(f"columns not in field names: {unexpected}")
    columns = [
        F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string").alias(name) for name in field_names
    ]
    flat_columns(df.select(*columns)).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in a declared schema: absent fields null, others dropped, values cast or refused."""
    columns = []
    for field in schema.fields:
        target = T.StringType() if isinstance(field.dataType, T.NullType) else field.dataType
        value = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        columns.append(value.cast(target).alias(field.name))
    return df.select(*columns)


def write_parquet(df: DataFrame, path: str, schema: T.StructType | None = None, mode: str = "errorifexists") -> None:
    (fit(df, schema) if schema else df).write.mode(mode).parquet(path)


def land(
    df: DataFrame,
    root: str,
    source: str,
    at: datetime,
    file_type: str = "json",
    state: str = STAGED,
    max_records: int = 0,
) -> str:
    """Write a load into the staged tree and return its path.

    The path is a folder of part files, written in parallel; JSON is written as lines.
    """
    path = staged_path(root, source, at, check_file_type(file_type), state)
    writer = (flat_columns(df) if file_type == "csv" else df).write.option("maxRecordsPerFile", max_records)
    if file_type == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(file_type).save(path)
    return path


def land_errored(errored: DataFrame, root: str, source: str, at: datetime) -> str:
    """Set unusable input aside in the staged tree, raw text included."""
    return land(errored, root, source, at, "json", ERRORED)
