"""Snapshot comparison by row hash."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.columns import as_list, refuse_columns, require_columns
from sediment.functions.hashing import HASH_COLUMN
from sediment.operators.skew import hot_keys, is_small, lookup_join

# The outcome words of a comparison.
NEW = "new"
CHANGED = "changed"
DELETED = "deleted"
UNCHANGED = "unchanged"
REMOVED_OR_CHANGED = "removed_or_changed"

# The one-letter flags for the same outcomes.
FLAGS = {UNCHANGED: "I", CHANGED: "C", NEW: "N"}


def _stand_in(dtype: T.DataType) -> Column:
    """Any fixed value of a type, to stand in for null inside a join key."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BinaryType):
        return F.lit("").cast(dtype)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    raise TypeError(f"a {dtype.simpleString()} column cannot be a business key")


class NullSafeKeys:
    """Business keys as plain join columns in which null equals null.

    Each key becomes its value with null replaced, and one more column has a bit set for
    each key that was null. The uniqueness check and the join both run on these columns
    and so share one shuffle.
    """

    def __init__(self, current: DataFrame, new: DataFrame, keys: Sequence[str]):
        self.keys = list(keys)
        self.types = []
        for key in self.keys:
            left, right = current.schema[key].dataType, new.schema[key].dataType
            if left != right:
                if not (isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType)):
                    raise TypeError(f"business key '{key}' is {left.simpleString()} and {right.simpleString()}")
                left = T.LongType()
            self.types.append(left)
        self.columns = [*[f"_key{i}" for i in range(len(self.keys))], "_nulls"]

    def add(self, df: DataFrame) -> DataFrame:
        values = [F.col(f"`{key}`").cast(dtype) for key, dtype in zip(self.keys, self.types)]
        added = {f"_key{i}": F.coalesce(v, _stand_in(t)) for i, (v, t) in enumerate(zip(values, self.types))}
        bits = [F.when(v.isNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0)) for i, v in enumerate(values)]
        return df.withColumns({**added, "_nulls": reduce(lambda a, b: a + b, bits)})

    def restored(self) -> list[Column]:
        was_null = [F.col("_nulls").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0 for i in range(len(self.keys))]
        return [F.when(~gone, F.col(f"_key{i}")).alias(self.keys[i]) for i, gone in enumerate(was_null)]


def require_unique(df: DataFrame, columns: Sequence[str], message: str) -> DataFrame:
    """The same rows; running the plan fails when ``columns`` repeat.

    The check sits in a filter, where it cannot be pruned away. On a large frame each
    task first drops all but two copies of a key, so a heavily repeated key never
    reaches one task whole; a small frame skips that extra sort.
    """
    window = Window.partitionBy(*columns)
    if is_small(df):
        numbered = df.withColumn("_copies", F.count(F.lit(1)).over(window))
    else:
        numbered = df.withColumn("_copies", F.row_number().over(window.orderBy(F.lit(0)))).where("_copies <= 2")
    failed = F.raise_error(F.lit(message)).cast("boolean")
    return numbered.where(F.when(F.col("_copies") > 1, failed).otherwise(F.lit(True))).drop("_copies")


def unique_by(df: DataFrame, keys: str | Sequence[str], label: str) -> DataFrame:
    """The same rows; running the plan fails when a business key repeats, nulls being equal."""
    keys = as_list(keys)
    require_columns({label: df}, keys, "business key columns")
    pairs = NullSafeKeys(df, df, keys)
    return require_unique(pairs.add(df), pairs.columns, _repeated(keys, label)).drop(*pairs.columns)


def _repeated(keys: Sequence[str], label: str) -> str:
    # Fixed value: the first words tell this error from others.
    return f"Duplicate keys found in {label}: rows share {', '.join(keys)}"


def match_snapshots(
    current: DataFrame,
    new: DataFrame,
    keys: str | Sequence[str],
    hash_column: str,
    carry: Sequence[str],
    ranked: NullSafeKeys | None = None,
    new_hash: Column | None = None,
) -> tuple[DataFrame, list[Column]]:
    """Full outer match of two snapshots with a status per key.

    Returns a frame with the columns of both sides, prefixed ``_old_`` and ``_new_``, and
    ``status``, plus the expressions that give the keys back. ``carry`` names the columns
    the old side brings along besides its hash. With ``ranked`` the old side already has
    the key columns of that object, holds each key once and is partitioned by them, as
    after a rank over them; it is neither checked nor shuffled again. With ``new_hash``, an
    expression, the new side has no hash yet; it is made after the shuffle and doesn't travel.
    """
    keys = as_list(keys)
    frames = {"current": current, "new": new}
    require_columns(frames if new_hash is None else {"current": current}, [hash_column], "hash column")
    require_columns(frames, keys, "business key columns")
    pairs = ranked or NullSafeKeys(current, new, keys)

    def side(label: str, columns: Sequence[str], prefix: str) -> DataFrame:
        if ranked and label == "current":
            checked = frames[label]
        else:
            checked = require_unique(pairs.add(frames[label]), pairs.columns, _repeated(keys, label))
        body = [F.col(f"`{c}`").alias(f"{prefix}{c}") for c in columns]
        if new_hash is not None and label == "new":
            body.append(new_hash.alias(f"{prefix}{hash_column}"))
        return checked.select(*pairs.columns, *body, F.lit(True).alias(f"{prefix}"))

    old = side("current", [*[c for c in carry if c != hash_column], hash_column], "_old_")
    fresh = side("new", new.columns, "_new_")
    matched = old.join(fresh, pairs.columns, "full_outer")
    status = (
        F.when(F.col("_old_").isNull(), NEW)
        .when(F.col("_new_").isNull(), DELETED)
        .when(F.col(f"`_old_{hash_column}`").eqNullSafe(F.col(f"`_new_{hash_column}`")), UNCHANGED)
        .otherwise(CHANGED)
    )
    return matched.withColumn("status", status), pairs.restored()


def compare_by_key(
    current: DataFrame,
    new: DataFrame,
    keys: str | Sequence[str],
    hash_column: str = HASH_COLUMN,
    ranked: NullSafeKeys | None = None,
    new_hash: Column | None = None,
) -> DataFrame:
    """Keys, old hash, new-side columns with the new hash, and the status of each key.

    A deleted key has null attributes. A key that repeats on a side is an error, as are
    data columns named like those the comparison adds.
    """
    keys = as_list(keys)
    refuse_columns(new, ["status", f"{hash_column}_current", f"{hash_column}_new"], "a comparison")
    matched, key_columns = match_snapshots(current, new, keys, hash_column, [], ranked, new_hash)
    attributes = [
        F.col(f"`_new_{name}`").alias(f"{hash_column}_new" if name == hash_column else name)
        for name in [*new.columns, *([] if new_hash is None else [hash_column])]
        if name not in keys
    ]
    old_hash = F.col(f"`_old_{hash_column}`").alias(f"{hash_column}_current")
    return matched.select(*key_columns, old_hash, *attributes, "status")


def compare_by_hash(current: DataFrame, new: DataFrame, hash_column: str = HASH_COLUMN) -> DataFrame:
    """Comparison without a key: every new row, plus the current hashes that are gone.

    One full outer join against the distinct current hashes, each side shuffled once. It
    could not split a hash that a large share of the new rows has, so with such a hash the
    two halves are joined apart.
    """
    require_columns({"current": current, "new": new}, [hash_column], "hash column")
    refuse_columns(new, ["status"], "a comparison")
    others = [name for name in new.columns if name != hash_column]
    known = current.select(hash_column).distinct()
    if not hot_keys(new, [hash_column]):
        both = new.withColumn("_new_", F.lit(True)).join(known.withColumn("_old_", F.lit(True)), hash_column, "full_outer")
        status = F.when(F.col("_old_").isNull(), NEW).when(F.col("_new_").isNull(), REMOVED_OR_CHANGED).otherwise(UNCHANGED)
        return both.select(hash_column, *[F.col(f"`{name}`") for name in others], status.alias("status"))
    present = lookup_join(new, known.withColumn("_known", F.lit(True)), [hash_column], "left").select(
        hash_column,
        *others,
        F.when(F.col("_known"), UNCHANGED).otherwise(NEW).alias("status"),
    )
    gone = known.join(new.select(hash_column).distinct(), hash_column, "left_anti").select(
        hash_column,
        *[F.lit(None).cast(new.schema[name].dataType).alias(name) for name in others],
        F.lit(REMOVED_OR_CHANGED).alias("status"),
    )
    return present.unionByName(gone)


def compare(
    current: DataFrame,
    new: DataFrame,
    keys: str | Sequence[str] | None = None,
    hash_column: str = HASH_COLUMN,
) -> DataFrame:
    """Compare two hashed snapshots, by business key when there is one."""
    if keys is None:
        return compare_by_hash(current, new, hash_column)
    return compare_by_key(current, new, keys, hash_column)


def altered(comparison: DataFrame, delta: bool = False) -> DataFrame:
    """Rows that are not unchanged; in a delta load an absent key is not a deletion."""
    rows = comparison.where(F.col("status") != UNCHANGED)
    return rows.where(F.col("status") != DELETED) if delta else rows


def drop_hashes(df: DataFrame, hash_column: str = HASH_COLUMN) -> DataFrame:
    return df.drop(hash_column, f"{hash_column}_current", f"{hash_column}_new")


def with_flag(comparison: DataFrame) -> DataFrame:
    """Add the one-letter flag; deletions have none."""
    flag = F.lit(None).cast("string")
    for word, letter in FLAGS.items():
        flag = F.when(F.col("status") == word, letter).otherwise(flag)
    return comparison.withColumn("flag", flag)


def count_by_key(
    current: DataFrame, new: DataFrame, keys: str | Sequence[str], hash_column: str = HASH_COLUMN
) -> DataFrame:
    """``status_counts`` of a keyed comparison, from one aggregate per key.

    Only key and hash of each row travel, combined per task before the shuffle; neither
    side is sorted or joined. A key that repeats on a side is an error.
    """
    keys = as_list(keys)
    frames = {"current": current, "new": new}
    require_columns(frames, [hash_column], "hash column")
    require_columns(frames, keys, "business key columns")
    pairs = NullSafeKeys(current, new, keys)
    sides = [
        pairs.add(df.select(*keys, F.col(f"`{hash_column}`").alias("_hash"))).select(
            *pairs.columns, F.lit(label == "new").alias("_new"), "_hash"
        )
        for label, df in frames.items()
    ]
    old, fresh = ~F.col("_new"), F.col("_new")
    per_key = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*pairs.columns)
        .agg(
            F.count(F.when(old, 1)).alias("_n_old"),
            F.count(F.when(fresh, 1)).alias("_n_new"),
            F.max(F.when(old, F.col("_hash"))).alias("_old"),
            F.max(F.when(fresh, F.col("_hash"))).alias("_fresh"),
        )
    )
    status = F.when(F.col("_n_old") > 1, F.raise_error(F.lit(_repeated(keys, "current"))).cast("string"))
    status = status.when(F.col("_n_new") > 1, F.raise_error(F.lit(_repeated(keys, "new"))).cast("string"))
    status = status.when(F.col("_n_old") == 0, NEW).when(F.col("_n_new") == 0, DELETED)
    status = status.when(F.col("_old").eqNullSafe(F.col("_fresh")), UNCHANGED).otherwise(CHANGED)
    return per_key.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def status_counts(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
