"""Cleaning rules between the raw and the cleaned layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.columns import as_list, require_columns
from sediment.functions.types import apply_types


def trimmed(value: Column) -> Column:
    """Text without white space, line ends included, at either end."""
    return F.btrim(value, F.lit(" \t\r\n"))


def is_blank(value: Column) -> Column:
    return trimmed(value) == ""


_RULES = {
    "trim": trimmed,
    "blank_to_null": lambda value: F.when(~is_blank(value), value),
    "lower": F.lower,
    "upper": F.upper,
}


def one_per_key(df: DataFrame, keys: str | Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first by ``prefer``; rows equal in all of it tie by their hash.

    Spark turns the rank filter into a limit per task ahead of the shuffle.
    """
    keys = as_list(keys)
    require_columns({"cleaned frame": df}, keys, "business key columns")
    window = Window.partitionBy(*[F.col(f"`{key}`") for key in keys]).orderBy(*prefer, F.xxhash64(*df.columns))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def clean(
    df: DataFrame,
    rules: Mapping[str, Sequence[str]] | None = None,
    types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Apply text rules, then declared types.

    Without rules every text column is trimmed and blank text becomes null.
    """
    if rules is None:
        rules = {f.name: ("trim", "blank_to_null") for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    require_columns({"cleaned frame": df}, list(rules), "columns with cleaning rules")
    changed = {}
    for name, steps in rules.items():
        value = F.col(f"`{name}`")
        for step in steps:
            if step not in _RULES:
                raise ValueError(f"Unknown cleaning rule '{step}'")
            value = _RULES[step](value)
        changed[name] = value
    cleaned = df.withColumns(changed) if changed else df
    return apply_types(cleaned, types) if types else cleaned
