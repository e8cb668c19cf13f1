"""Keeping one hot key from filling one task.

Three tools, all exact:

* ``hot_keys`` names the keys that hold a large share of the rows;
* ``lookup_join`` salts those, copying their one partner to each part;
* ``Timeline`` cuts the ordered rows of those keys into ranges, so that "previous",
  "next" and "latest so far" run in many tasks, and hands the value at each cut on to
  the next range.

Tables of a few input splits are left alone: no group in them can be more than one
task handles. Sizes choose between plans, never between results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.session import materialise

# A key is hot when its rows exceed this many input splits (half a GiB on disk by default).
# Only as many keys as the table has such parts can each be so large.
HOT_SPLITS = 4
# Input per task that groups rows by key, as a share of a split, and from how many tasks on it grows.
# Keys alone shuffle to few bytes, by which Spark would leave tens of millions to one task.
KEY_SHARE, MANY_TASKS = 8, 2000
# Keys a sketch tells apart: Spark tracks a million items at most, a sketch four per key.
# Tables of more parts have their keys counted exactly.
MOST_SKETCHED = 200_000

_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30, "t": 2**40, "tb": 2**40}


def _conf_bytes(spark: SparkSession, name: str, default: str) -> int:
    text = str(spark.conf.get(name, default)).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


def split_bytes(spark: SparkSession) -> int:
    return _conf_bytes(
        spark, "spark.sediment.splitBytes", str(_conf_bytes(spark, "spark.sql.files.maxPartitionBytes", "128m"))
    )


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Size of the tables a plan reads; one whose size Spark does not know counts nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 2**60)


def is_small(df: DataFrame) -> bool:
    """True when the whole frame is too small to contain a hot key."""
    return estimated_bytes(df) <= HOT_SPLITS * split_bytes(df.sparkSession)


def fits_broadcast(df: DataFrame) -> bool:
    """True when the size estimate is within the session's broadcast limit."""
    limit = _conf_bytes(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold", "10m")
    return 0 < limit and estimated_bytes(df) <= limit


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{key}`") for key in keys])


def _row_bytes(dtype: T.DataType) -> int:
    """Rough width of a value, by type alone."""
    if isinstance(dtype, T.StructType):
        return sum(_row_bytes(field.dataType) for field in dtype.fields)
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return 8
    return 32


def hot_keys(df: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """Hash of each key with a large share of the rows, and how many parts its size fills.

    One pass over the key columns with a frequent-items sketch per task; no rows are
    shuffled. Tables too large for a sketch get exact counts, added up before a shuffle
    of keys. Null keys count as a key. The sketch may name a key that is not quite hot;
    that only changes how its rows are processed. The plan's estimate is an upper bound
    that joins inflate, so the rows counted and the tables read limit it.
    """
    if is_small(df):
        return {}
    part = HOT_SPLITS * split_bytes(df.sparkSession)
    most = int(estimated_bytes(df) / part) + 1
    if most > MOST_SKETCHED:
        return _counted_hot_keys(df, keys, part)
    names = ", ".join(f"`{key}`" for key in keys)
    probe = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(xxhash64({names}), {most}, {4 * most + 1000})").alias("top"),
    ).first()
    parts = _parts(df, probe["n"], part)
    found = {row["item"]: row["count"] / probe["n"] for row in probe["top"] or []}
    return {item: max(2, math.ceil(held * parts)) for item, held in found.items() if held * parts >= 1 and parts > 1}


def _parts(df: DataFrame, rows: int, part: int) -> float:
    return min(estimated_bytes(df), max(input_bytes(df), rows * _row_bytes(df.schema))) / part


def _counted_hot_keys(df: DataFrame, keys: Sequence[str], part: int) -> dict[int, int]:
    rows = df.count()
    parts = _parts(df, rows, part)
    if parts <= 1:
        return {}
    counted = df.groupBy(key_hash(keys).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    found = counted.where(F.col("n") * F.lit(parts) >= rows).collect()  # at most ``parts`` keys
    return {row["item"]: max(2, math.ceil(row["n"] * parts / rows)) for row in found}


def aggregate_by_key(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """``groupBy(keys).agg(measures)`` in tasks that each hold a bounded number of keys.

    Rows are dealt by key to as many tasks as the size of the tables read calls for. Those
    of a hot key are added up per task first, so it cannot fill one task. A small input is
    left to Spark.
    """
    split = split_bytes(df.sparkSession)
    read = input_bytes(df)
    tasks = min(math.ceil(read * KEY_SHARE / split), max(MANY_TASKS, math.ceil(read / split)))
    if tasks <= 1:
        return df.groupBy(*keys).agg(*measures)
    hot = hot_keys(df, keys)
    if not hot:
        return df.repartition(tasks, *keys).groupBy(*keys).agg(*measures)
    listed = F.broadcast(df.sparkSession.createDataFrame([(item,) for item in hot], "_hot bigint"))
    in_hot = key_hash(keys) == F.col("_hot")
    others = df.join(listed, in_hot, "left_anti").repartition(tasks, *keys)
    return others.groupBy(*keys).agg(*measures).unionByName(df.join(listed, in_hot, "left_semi").groupBy(*keys).agg(*measures))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    probe: DataFrame | None = None,
) -> DataFrame:
    """Equi join of many rows with a table that holds each key once.

    ``how`` is inner, left, left_semi or left_anti. A right side within Spark's broadcast
    limit is left to Spark. Otherwise the rows of a hot key are salted into as many parts
    as its size calls for, and its single partner is copied to each part. The salt depends
    on the row and its input partition only, so a retried task repeats it, and equal rows
    still spread. ``probe`` is a cheaper frame with the same key distribution as ``left``.
    """
    keys = list(keys)
    for key in keys:
        types = left.schema[key].dataType, right.schema[key].dataType
        if types[0] == types[1]:
            continue
        if not all(isinstance(t, T.IntegralType) for t in types):
            raise TypeError(f"key '{key}' is {types[0].simpleString()} and {types[1].simpleString()}")
        # The hash that salts a key must not depend on the width of its type.
        left, right = (df.withColumn(key, F.col(f"`{key}`").cast("bigint")) for df in (left, right))
        probe = None if probe is None else probe.withColumn(key, F.col(f"`{key}`").cast("bigint"))
    hot = {} if fits_broadcast(right) else hot_keys(left if probe is None else probe, keys)
    if not hot:
        return left.join(right, keys, how)
    parts = F.broadcast(left.sparkSession.createDataFrame(list(hot.items()), "_hash bigint, _parts int"))
    row = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in left.columns])
    salted = (
        left.withColumns({"_hash": key_hash(keys), "_row": row})
        .join(parts, "_hash", "left")
        .withColumn("_salt", F.coalesce(F.pmod("_row", "_parts").cast("int"), F.lit(0)))
        .drop("_hash", "_parts", "_row")
    )
    copied = (
        right.withColumn("_hash", key_hash(keys))
        .join(parts, "_hash", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_hash", "_parts")
    )
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")


class Timeline:
    """The rows of a frame in time order within each key.

    ``order`` lists the ordering columns, the last ones breaking ties. Rows of a hot key
    are cut into ranges of that order; the others stay whole. The methods that add a
    column return a timeline over the same ranges, so steps can follow each other.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]):
        self.keys = list(keys)
        self.order = list(order)
        hot = hot_keys(df, keys)
        self.cut = bool(hot)
        self._df = df
        if self.cut:
            listed = F.broadcast(df.sparkSession.createDataFrame([(item,) for item in hot], "_hot bigint"))
            in_hot = key_hash(keys) == F.col("_hot")
            # Written once: another evaluation could sample other range bounds.
            ranges = materialise(
                df.join(listed, in_hot, "left_semi")
                .repartitionByRange(sum(hot.values()), *self.keys, *self.order)
                .withColumn("_range", F.spark_partition_id()),
                "ranges",
            )
            self._df = df.join(listed, in_hot, "left_anti").withColumn("_range", F.lit(-1)).unionByName(ranges)

    @property
    def df(self) -> DataFrame:
        return self._df.drop("_range")

    def _next(self, df: DataFrame) -> Timeline:
        copy = object.__new__(Timeline)
        copy.keys, copy.order, copy.cut, copy._df = self.keys, self.order, self.cut, df
        return copy

    def where(self, condition) -> Timeline:
        return self._next(self._df.where(condition))

    def drop(self, *names: str) -> Timeline:
        return self._next(self._df.drop(*names))

    def _window(self):
        parts = [*self.keys, "_range"] if self.cut else self.keys
        return Window.partitionBy(*[F.col(f"`{p}`") for p in parts]).orderBy(*self.order)

    def _add(self, inside: Column, summary: Column, pick: Callable, columns: Callable) -> Timeline:
        """Add columns made from a window value and, past a cut, from what was handed on.

        ``summary`` is what a range leaves to others, ``pick`` chooses among those of the
        key. A range holds a contiguous run of sorted keys, so there are at most as many
        (key, range) pairs as ranges plus hot keys. They are written; where the files show
        them to be wide, they are not broadcast but joined by key and range, and no range
        is larger than one task handles.
        """
        df = self._df.withColumn("_value_here", inside)
        if not self.cut:
            return self._next(df.withColumns(columns(F.col("_value_here"))).drop("_value_here"))
        names = [*self.keys, "_range"]
        handed = (
            self._df.where(F.col("_range") >= 0)
            .groupBy(*names)
            .agg(summary.alias("_end"))
            .withColumn("_handed", pick(Window.partitionBy(*self.keys).orderBy("_range")))
            .select(*[F.col(f"`{name}`").alias(f"_at{i}") for i, name in enumerate(names)], "_handed")
        )
        handed = materialise(handed, "handed")
        if estimated_bytes(handed) <= split_bytes(df.sparkSession):
            handed = F.broadcast(handed)
        same = [F.col(f"`{name}`").eqNullSafe(F.col(f"_at{i}")) for i, name in enumerate(names)]
        joined = df.join(handed, same, "left")
        added = joined.withColumns(columns(F.coalesce("_value_here", "_handed")))
        return self._next(added.drop("_value_here", "_handed", *[f"_at{i}" for i in range(len(names))]))

    def with_previous(self, value: str, name: str, first: str) -> Timeline:
        """Add the value of the row before, and whether there is no row before."""
        boxed = F.struct(F.col(value).alias("v"))
        return self._add(
            F.lag(boxed).over(self._window()),
            F.max_by(boxed, F.struct(*self.order)),
            lambda ranges: F.lag("_end").over(ranges),
            lambda found: {name: found["v"], first: found.isNull()},
        )

    def with_next(self, value: str, name: str) -> Timeline:
        """Add the value of the row after; null at the end."""
        boxed = F.struct(F.col(value).alias("v"))
        return self._add(
            F.lead(boxed).over(self._window()),
            F.min_by(boxed, F.struct(*self.order)),
            lambda ranges: F.lead("_end").over(ranges),
            lambda found: {name: found["v"]},
        )

    def with_latest(self, value: str, name: str) -> Timeline:
        """Add the newest non-null value at or before each row."""
        so_far = (Window.unboundedPreceding, Window.currentRow)
        earlier = (Window.unboundedPreceding, -1)
        return self._add(
            F.last(value, ignorenulls=True).over(self._window().rowsBetween(*so_far)),
            F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*self.order))),
            lambda ranges: F.last("_end", ignorenulls=True).over(ranges.rowsBetween(*earlier)),
            lambda found: {name: found},
        )
