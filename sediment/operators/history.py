"""Versions, validity intervals and the two ways of keeping history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.functions.hashing import HASH_COLUMN, add_row_hash
from sediment.functions.lineage import LINEAGE_COLUMNS
from sediment.functions.columns import as_list
from sediment.operators.compare import CHANGED, DELETED, NEW, NullSafeKeys, match_snapshots
from sediment.operators.skew import Timeline

# Columns a history table adds to the data; with lineage, hash and batch they are reserved.
VALIDITY_COLUMNS = ("valid_from", "valid_to", "is_current")
RESERVED = (*VALIDITY_COLUMNS, HASH_COLUMN, "batch_id")


def comparable_columns(df: DataFrame, keys: str | Sequence[str]) -> list[str]:
    """The columns a change is looked for in: neither key nor bookkeeping."""
    technical = {*LINEAGE_COLUMNS, *RESERVED, *as_list(keys)}
    return [name for name in df.columns if name not in technical]


def _refuse_drift(current: DataFrame, incoming: DataFrame) -> None:
    """A history keeps its columns; a new one is an error, not dropped."""
    unknown = [c for c in incoming.columns if c not in (*current.columns, *VALIDITY_COLUMNS, HASH_COLUMN)]
    if unknown:
        raise ValueError(f"columns not in the history: {unknown}")


def latest_version(df: DataFrame, keys: str | Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of each key.

    Spark turns the rank filter into a per-task limit ahead of the shuffle, so a key
    with very many versions sends one row per task.
    """
    window = Window.partitionBy(*as_list(keys)).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def live_rows(history: DataFrame, keys: str | Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of each key, without keys whose newest row is a deletion."""
    newest = latest_version(history, keys, newest_first)
    return newest.where(~F.col("status").eqNullSafe(DELETED)) if "status" in history.columns else newest


def preserve_history(history: DataFrame, delta: DataFrame) -> DataFrame:
    """All known rows plus the new ones; missing columns become null."""
    return history.unionByName(delta, allowMissingColumns=True)


def _change_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], compare: Sequence[str]) -> Timeline:
    value = F.struct(*[F.col(f"`{name}`") for name in compare])
    timeline = Timeline(df.withColumn("_value", value), keys, order).with_previous("_value", "_before", "_first")
    differs = F.col("_first") | ~F.col("_value").eqNullSafe(F.col("_before"))
    return timeline.where(differs).drop("_value", "_before", "_first")


def change_points(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Drop rows that repeat the row before them in the compared columns."""
    return _change_points(df, as_list(keys), order, compare).df


def _validity(timeline: Timeline, start: str) -> DataFrame:
    df = timeline.with_next(start, "_until").df
    return df.select(
        *[c for c in df.columns if c not in (*VALIDITY_COLUMNS, "_until")],
        F.col(start).alias("valid_from"),
        F.col("_until").alias("valid_to"),
        F.col("_until").isNull().alias("is_current"),
    )


def validity(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Give each version the half-open interval it holds for.

    The first ordering column is the start; the next version's start is the end.
    """
    return _validity(Timeline(df, as_list(keys), order), order[0])


def versions(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Type 2 history from a log of observations: change points with validity."""
    return _validity(_change_points(df, as_list(keys), order, compare), order[0])


def _hashed(df: DataFrame, compare: Sequence[str], strict: bool) -> DataFrame:
    return add_row_hash(df, compare, HASH_COLUMN, strict=strict)


def without_versions(
    opened: DataFrame, closed: DataFrame, keys: str | Sequence[str], batch: str | None = None
) -> DataFrame:
    """The versions of ``opened`` that ``closed`` does not end, told by key and start.

    With ``batch`` only a later batch ends a version.
    """
    pairs = NullSafeKeys(opened, closed, as_list(keys))
    left, right = pairs.add(opened).alias("o"), pairs.add(closed).alias("c")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"c.{k}") for k in [*pairs.columns, "valid_from"]])
    if batch:
        same = same & (F.col(f"o.{batch}") < F.col(f"c.{batch}"))
    return left.join(right, same, "left_anti").select(*[F.col(f"o.`{c}`") for c in opened.columns])


def merge_type1(
    current: DataFrame,
    incoming: DataFrame,
    keys: str | Sequence[str],
    compare: Sequence[str] | None = None,
    delta: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Type 1: a changed key is replaced, an unchanged one keeps its old row and stamps.

    A key absent from a full load is removed; absent from a delta load, it stays.
    """
    keys = as_list(keys)
    _refuse_drift(current, incoming)
    compare = list(compare or comparable_columns(incoming, keys))
    columns = [c for c in current.columns if c != HASH_COLUMN]
    matched, key_columns = match_snapshots(
        _hashed(current, compare, strict), _hashed(incoming, compare, strict), keys, HASH_COLUMN, columns
    )
    if not delta:
        matched = matched.where(F.col("status") != DELETED)
    take_new = F.col("status").isin(NEW, CHANGED)

    def pick(name: str) -> Column:
        old = F.col(f"`_old_{name}`")
        fresh = F.col(f"`_new_{name}`") if name in incoming.columns else F.lit(None).cast(current.schema[name].dataType)
        return F.when(take_new, fresh).otherwise(old).alias(name)

    restored = dict(zip(keys, key_columns))
    return matched.select(*[restored[c] if c in restored else pick(c) for c in columns])


def _open_end(valid_from: Column) -> Column:
    """Null of the same type as the start."""
    return F.when(F.lit(False), valid_from)


def open_history(incoming: DataFrame, valid_from: Column) -> DataFrame:
    """First load of a type 2 table: every row is a current version."""
    return incoming.withColumns(
        {
            "valid_from": valid_from,
            "valid_to": _open_end(valid_from),
            "is_current": F.lit(True),
        }
    )


def merge_type2(
    current: DataFrame,
    incoming: DataFrame,
    keys: str | Sequence[str],
    valid_from: Column,
    compare: Sequence[str] | None = None,
    delta: bool = False,
    strict: bool = False,
    changes_only: bool = False,
) -> DataFrame:
    """Type 2: what the current versions become when a snapshot arrives.

    ``current`` holds only current versions; closed ones never change again and need not
    be read. The result holds the current versions after the load, and those it closed
    (``is_current`` false). A changed key yields both, from one join: each matched pair
    emits at most two rows. With ``changes_only`` the result leaves out what stays open.
    """
    keys = as_list(keys)
    _refuse_drift(current, incoming)
    compare = list(compare or comparable_columns(incoming, keys))
    columns = [c for c in current.columns if c not in (*VALIDITY_COLUMNS, HASH_COLUMN)]
    matched, key_columns = match_snapshots(
        _hashed(current, compare, strict),
        _hashed(incoming, compare, strict),
        keys,
        HASH_COLUMN,
        [*columns, "valid_from"],
    )
    restored = dict(zip(keys, key_columns))
    no_end = _open_end(valid_from)

    def row(prefix: str, start: Column, end: Column) -> Column:
        have = incoming.columns if prefix == "_new_" else columns
        body = [
            restored[name]
            if name in restored
            else (
                F.col(f"`{prefix}{name}`") if name in have else F.lit(None).cast(current.schema[name].dataType)
            ).alias(name)
            for name in columns
        ]
        return F.struct(
            *body, start.alias("valid_from"), end.alias("valid_to"), end.isNull().alias("is_current")
        )

    status = F.col("status")
    ended = F.lit(False) if delta else status == DELETED
    still_open = row("_old_", F.col("_old_valid_from"), no_end)
    closed = row("_old_", F.col("_old_valid_from"), valid_from)
    opened = row("_new_", valid_from, no_end)
    rows = (
        F.when(status == CHANGED, F.array(closed, opened))
        .when(status == NEW, F.array(opened))
        .when(ended, F.array(closed))
    )
    if not changes_only:
        rows = rows.otherwise(F.array(still_open))
    return matched.select(F.inline(rows))
