"""Gold tables, dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.columns import as_list, require_columns
from sediment.operators.history import live_rows
from sediment.operators.keys import UNKNOWN_MEMBER
from sediment.operators.skew import Timeline, fits_broadcast, lookup_join

_MEASURES = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
}


def measure_columns(measures: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Aggregates from ``{alias: (function, column)}``; count also takes ``*``."""
    columns = []
    for alias, (function, column) in measures.items():
        if function not in _MEASURES:
            raise ValueError(f"Unknown measure '{function}'")
        value = F.lit(1) if column == "*" else F.col(column)
        columns.append(_MEASURES[function](value).alias(alias))
    return columns


def aggregate(df: DataFrame, grain: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per grain. Each task aggregates its own rows before the shuffle."""
    return df.groupBy(*grain).agg(*measure_columns(measures))


def gold(
    silver: DataFrame,
    keys: str | Sequence[str],
    newest_first: Sequence[Column],
    rules: Mapping[str, object] | None = None,
) -> DataFrame:
    """Latest live row of each key, or its aggregate under ``{group_by, measures}``."""
    newest = live_rows(silver, keys, newest_first)
    return aggregate(newest, rules["group_by"], rules["measures"]) if rules else newest


def dimension(
    history: DataFrame, key_map: DataFrame, keys: str | Sequence[str], name: str = "surrogate_key"
) -> DataFrame:
    """History rows with their surrogate key in front."""
    keys = as_list(keys)
    joined = lookup_join(history, key_map.select(*keys, name), keys, "inner")
    return joined.select(name, *history.columns)


def fact(
    source: DataFrame,
    dimensions: Mapping[str, tuple[DataFrame, Mapping[str, str]]],
    columns: Sequence[str],
    name: str = "surrogate_key",
) -> DataFrame:
    """Replace business keys by surrogate keys.

    ``dimensions`` maps the name of the resulting key column to a dimension, which holds
    each business key once, and ``{source column: dimension column}``. A row without a
    member gets the unknown member. Spark broadcasts dimensions within its size limit;
    for larger ones, rows of hot keys are salted.
    """
    result = source
    for key_column, (members, references) in dimensions.items():
        known = members.select(
            *[F.col(f"`{target}`").alias(column) for column, target in references.items()],
            F.col(name).alias(key_column),
        )
        result = lookup_join(result, known, list(references), "left", probe=source).withColumn(
            key_column, F.coalesce(key_column, F.lit(UNKNOWN_MEMBER).cast("bigint"))
        )
    return result.select(*dimensions, *columns)


def point_in_time(
    rows: DataFrame,
    history: DataFrame,
    keys: str | Sequence[str],
    at: str,
    attributes: Sequence[str],
) -> DataFrame:
    """Each row with the attributes of the version valid at its time, null if none is.

    Versions of a key must not overlap; one without a start, or that ends where it
    starts, holds at no time. A history within the broadcast limit is joined by
    key and interval without moving the rows. A larger one is merged with the rows in
    time order and the latest version carried forward: work stays linear, where a range
    join would pair each row with all versions of its key.
    """
    keys = as_list(keys)
    require_columns({"rows": rows, "history": history}, keys, "key columns")
    clash = [name for name in attributes if name in rows.columns]
    if clash:
        raise ValueError(f"attribute names already in use: {clash}")
    spans = history.where("valid_from < valid_to OR (valid_from IS NOT NULL AND valid_to IS NULL)")
    spans = spans.select(*keys, "valid_from", "valid_to", *attributes)
    if fits_broadcast(spans):
        left, right = rows.alias("r"), spans.alias("v")
        matches = [F.col(f"r.{key}") == F.col(f"v.{key}") for key in keys]
        inside = (F.col(f"r.{at}") >= F.col("v.valid_from")) & (
            F.col("v.valid_to").isNull() | (F.col(f"r.{at}") < F.col("v.valid_to"))
        )
        joined = left.join(F.broadcast(right), [*matches, inside], "left")
        return joined.select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"v.{a}") for a in attributes])

    # Versions sort before rows of the same instant, so a row sees the one just begun.
    span_type = spans.select(F.struct("valid_to", *attributes)).schema[0].dataType
    row_type = rows.select(F.struct(*rows.columns)).schema[0].dataType
    begun = spans.select(
        *keys,
        F.col("valid_from").alias("_time"),
        F.lit(0).alias("_kind"),
        F.lit(0).cast("bigint").alias("_tie"),
        F.struct("valid_to", *attributes).alias("_span"),
        F.lit(None).cast(row_type).alias("_row"),
    )
    asked = rows.select(
        *keys,
        F.col(at).alias("_time"),
        F.lit(1).alias("_kind"),
        F.xxhash64(*rows.columns).alias("_tie"),
        F.lit(None).cast(span_type).alias("_span"),
        F.struct(*rows.columns).alias("_row"),
    )
    timeline = Timeline(begun.unionByName(asked), keys, ["_time", "_kind", "_tie"])
    carried = timeline.with_latest("_span", "_valid").where("_kind = 1").df
    ended = F.col("_valid.valid_to").isNull() | (F.col("_time") < F.col("_valid.valid_to"))
    for key in keys:
        ended = ended & F.col(f"`{key}`").isNotNull()
    return carried.select("_row.*", *[F.when(ended, F.col("_valid")[a]).alias(a) for a in attributes])
