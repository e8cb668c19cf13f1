"""Declared schemas: record types at ingest, column types at load."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a record schema may declare, with the Spark type each
# becomes. Unsigned integers widen to the next type that holds their whole range;
# half floats become single ones, since Spark cannot read Parquet FLOAT16.
INGEST_TYPES: dict[str, T.DataType] = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "integer8": T.ByteType(),
    "integer16": T.ShortType(),
    "integer32": T.IntegerType(),
    "integer64": T.LongType(),
    "unsigned_integer8": T.ShortType(),
    "unsigned_integer16": T.IntegerType(),
    "unsigned_integer32": T.LongType(),
    "unsigned_integer64": T.DecimalType(20, 0),
    "float16": T.FloatType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "date32": T.DateType(),
    "date64": T.DateType(),
    "string": T.StringType(),
    "large_string": T.StringType(),
    "string_view": T.StringType(),
    "binary": T.BinaryType(),
    "large_binary": T.BinaryType(),
    "binary_view": T.BinaryType(),
}

# The type names a table schema may declare. String and Numeric take
# parameters and are handled in column_type().
TABLE_TYPES: dict[str, T.DataType] = {
    "Integer": T.IntegerType(),
    "BigInteger": T.LongType(),
    "SmallInteger": T.ShortType(),
    "String": T.StringType(),
    "Text": T.StringType(),
    "Float": T.DoubleType(),
    "Numeric": T.DecimalType(10, 2),
    "Boolean": T.BooleanType(),
    "DateTime": T.TimestampNTZType(),
    "JSON": T.StringType(),
}


def record_schema(fields: Mapping[str, object]) -> T.StructType:
    """Record schema from ``{name: type name}``; a nested mapping is a struct."""
    return T.StructType([T.StructField(name, _record_type(token)) for name, token in fields.items()])


def _record_type(token: object) -> T.DataType:
    if isinstance(token, Mapping):
        return record_schema(token)
    if not isinstance(token, str) or token not in INGEST_TYPES:
        raise ValueError(f"Unsupported type: {token}")
    return INGEST_TYPES[token]


def record_fields(fields: Mapping[str, object]) -> list[tuple[str, T.DataType]]:
    """The record schema as ordered (name, type) pairs."""
    return [(field.name, field.dataType) for field in record_schema(fields).fields]


def load_table_schema(spark: SparkSession, path: str) -> dict:
    """Read a YAML (or JSON) table schema from any file system Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()[0]
    try:
        import yaml
    except ImportError:  # JSON is a subset of YAML
        return json.loads(text)
    return yaml.safe_load(text)


def column_type(definition: Mapping[str, object]) -> T.DataType:
    """Spark type of one declared table column."""
    name = definition.get("type")
    if name not in TABLE_TYPES:
        raise ValueError(f"Unsupported type '{name}' of a table column")
    if name == "String" and definition.get("length") is not None:
        return T.VarcharType(int(definition["length"]))
    if name == "Numeric":
        return T.DecimalType(int(definition.get("precision", 10)), int(definition.get("scale", 2)))
    return TABLE_TYPES[name]


def table_types(schema: Mapping[str, object], variant: bool = False) -> dict[str, T.DataType]:
    """``{column: type}`` of a table schema; empty when it declares no columns.

    With ``variant`` a JSON column holds parsed values instead of text.
    """
    found = {name: column_type(definition) for name, definition in (schema.get("columns") or {}).items()}
    parsed = [name for name in found if variant and schema["columns"][name]["type"] == "JSON"]
    return found | dict.fromkeys(parsed, T.VariantType())


def apply_types(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast the mapped columns and leave the others as they are.

    Nested values bound for a text column are written as JSON. A cast never shortens
    text: a length limit is enforced by the table on write.
    """
    return df.select([_typed(field, types.get(field.name)) for field in df.schema.fields])


def _typed(field: T.StructField, target: T.DataType | None):
    value = F.col(f"`{field.name}`")
    if target is None:
        return value
    if isinstance(target, (T.VarcharType, T.CharType)):
        target = T.StringType()
    if isinstance(target, T.VariantType) and not isinstance(field.dataType, T.VariantType):
        text = value if isinstance(field.dataType, T.StringType) else json_text(value)
        return F.parse_json(text).alias(field.name)
    if isinstance(target, T.StringType) and isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return json_text(value).alias(field.name)
    return value.cast(target).alias(field.name)


def json_text(value):
    """A nested value as JSON text, nulls kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def table_ddl(df: DataFrame, types: Mapping[str, T.DataType]) -> str:
    """Column list of a CREATE TABLE for this frame, declared lengths included."""
    return ", ".join(
        f"`{field.name}` {(types.get(field.name) or field.dataType).simpleString()}" for field in df.schema.fields
    )
