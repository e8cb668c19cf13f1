"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.functions.columns import as_list
from sediment.operators.compare import NullSafeKeys
from sediment.session import materialise

UNKNOWN_MEMBER = -1
# Fixed value: monotonically_increasing_id() counts rows in the lower 33 bits and
# holds the partition number above them.
_ROW_BITS = 33


def unseen_keys(history: DataFrame, known: DataFrame | None, keys: str | Sequence[str]) -> DataFrame:
    """Distinct business keys that have no surrogate key yet; null counts as a value."""
    keys = as_list(keys)
    wanted = history.select(*keys).distinct()
    if known is None:
        return wanted
    pairs = NullSafeKeys(known, wanted, keys)
    return (
        pairs.add(wanted)
        .join(pairs.add(known.select(*keys)).select(*pairs.columns), pairs.columns, "left_anti")
        .select(*keys)
    )


def assign_keys(df: DataFrame, keys: str | Sequence[str], start: int, name: str = "surrogate_key") -> DataFrame:
    """Number distinct keys from ``start + 1`` without gaps, in key order.

    The keys are range-partitioned and sorted in parallel, and written with their place
    in the partition; the only global step adds up one row count per partition.
    """
    keys = as_list(keys)
    placed = materialise(
        df.select(*keys)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id()),
        "keys",
    )
    part = F.shiftright("_id", _ROW_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per written partition
        .select(*keys, (F.lit(start) + F.col("_offset") + place + 1).cast("bigint").alias(name))
    )


def surrogate_keys(
    history: DataFrame,
    keys: str | Sequence[str],
    known: DataFrame | None = None,
    name: str = "surrogate_key",
) -> DataFrame:
    """The new rows of a surrogate key table; rows it already holds never change."""
    start = 0
    if known is not None:
        start = known.agg(F.max(name)).first()[0] or 0
    return assign_keys(unseen_keys(history, known, keys), keys, start, name)
