"""Tables kept up to date in steps beside a log: newest rows, and totals over them.

A step writes partitions of its own and touches no file that readers have open. Which
steps count, and up to which load of the log, is noted in one table property, so a step
counts in one operation, and one that is cut off never does. The current state and the one
before it can be read; what neither needs is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.columns import as_list
from sediment.functions.hashing import HASH_COLUMN, hash_expression
from sediment.functions.types import table_ddl
from sediment.operators.compare import DELETED, NullSafeKeys
from sediment.operators.history import latest_version
from sediment.operators.model import aggregate, measure_columns
from sediment.session import materialise
from sediment.sinks.tables import BATCH, align, batches, ensure_schema, own_partitions_only
from sediment.sources.tables import read_table, table_exists

STEP, BUCKET = "_step", "_bucket"
# The table property that notes the steps.
STEPS = "sediment.steps"
#: Newest rows per bucket, about, how far buckets may outgrow it, and the most buckets, which then grow.
BUCKET_ROWS, OUTGROWN, MOST_BUCKETS = 1 << 15, 4, 1 << 15
#: The inverse share of all totals that the changes of steps may reach before they are added up.
ADDED_UP = 4
#: Partitions dropped by one statement.
DROPPED = 500


@dataclass(frozen=True)
class Step:
    """A step, the load it leads to, and, where it holds the whole state, its number of buckets or 1.

    ``made_from`` is the step of another table that it follows, ``rows`` what it wrote.
    """

    step: int
    load: int
    whole: int = 0
    rows: int = 0
    made_from: int = 0
    note: str = ""


@dataclass(frozen=True)
class Steps:
    """The steps of a table, stored with it."""

    spark: SparkSession
    table: str

    def noted(self) -> list[Step]:
        if not table_exists(self.spark, self.table):
            return []
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == STEPS).collect()
        return [Step(*entry) for entry in json.loads(found[0]["value"])] if found else []

    def note(self, steps: Sequence[Step]) -> None:
        text = json.dumps([astuple(step) for step in steps]).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{STEPS}' = '{text}')")

    def parts(self) -> list[tuple[int, int]]:
        """Step and bucket of each partition."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        return sorted(tuple(int(part.partition("=")[2]) for part in row[0].split("/")) for row in rows)

    def drop(self, parts: Sequence[tuple[int, int]]) -> None:
        for k in range(0, len(parts), DROPPED):
            named = ", ".join(f"PARTITION ({STEP}={step}, {BUCKET}={bucket})" for step, bucket in parts[k : k + DROPPED])
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {named}")

    def write(self, rows: DataFrame, step: int) -> int:
        """Write a step's rows, dealt by their ``_bucket``, in place of what an attempt that was cut off wrote."""
        laid_out = rows.select(*[c for c in rows.columns if c != BUCKET], F.lit(step).alias(STEP), F.col(BUCKET))
        if not table_exists(self.spark, self.table):
            ensure_schema(self.spark, self.table.split(".")[0])
            ddl = table_ddl(laid_out, {})
            self.spark.sql(f"CREATE TABLE {self.table} ({ddl}) USING parquet PARTITIONED BY ({STEP}, {BUCKET})")
        self.drop([part for part in self.parts() if part[0] >= step])
        # Sorted by bucket alone, as the step is the same in all rows.
        into = f"INSERT OVERWRITE TABLE {self.table} PARTITION ({STEP}={step}, {BUCKET})"
        with own_partitions_only(self.spark):
            self.spark.sql(f"{into} SELECT * FROM {{rows}}", rows=align(laid_out, self.table).drop(STEP))
        return read_table(self.spark, self.table).where(F.col(STEP) == step).count()


def _next(steps: Sequence[Step], parts: Sequence[tuple[int, int]]) -> int:
    """A number for a step that no step, noted or cut off, has had and left files of."""
    return max([0, *(step.step for step in steps), *(step for step, _ in parts)]) + 1


@dataclass(frozen=True)
class NewestRows:
    """The newest row of each key of a log, deletions included, in buckets by a hash of the key.

    A load writes the buckets anew that hold one of its changes and reads no others, so a
    small load costs what a few buckets hold, however long the log. Rows carry the hash of
    the compared columns, so a comparison reads keys and hashes only. Hashes are kept as
    bytes, and made where rows are written, so that they don't travel.
    """

    spark: SparkSession
    log: str
    keys: Sequence[str]
    compare: Sequence[str] | None = None
    strict: bool = False
    bucket_rows: int = BUCKET_ROWS

    @property
    def steps(self) -> Steps:
        return Steps(self.spark, f"{self.log}_newest")

    @property
    def _as_bytes(self) -> bool:
        """Tables made before hashes were kept as bytes hold texts, and go on so."""
        table = self.steps.table
        kind = self.spark.table(table).schema[HASH_COLUMN].dataType if table_exists(self.spark, table) else None
        return not isinstance(kind, T.StringType)

    def hash_of(self, rows: DataFrame, compare: Sequence[str]) -> Column:
        """The hash of some columns, in the form in which it is kept."""
        text = hash_expression(rows, list(compare), self.strict)
        return F.unhex(text) if self._as_bytes else text

    def _hashed(self, rows: DataFrame) -> DataFrame:
        """Rows with a hash, made for those that have none."""
        if self.compare is None:
            return rows.withColumn(HASH_COLUMN, self._no_hash)
        made = self.hash_of(rows, self.compare)
        return rows.withColumn(HASH_COLUMN, F.coalesce(HASH_COLUMN, made) if HASH_COLUMN in rows.columns else made)

    @property
    def _no_hash(self) -> Column:
        return F.lit(None).cast("binary" if self._as_bytes else "string")

    @property
    def _covers(self) -> str:
        return json.dumps([self.strict, list(self.compare) if self.compare is not None else None])

    def _chosen(self, steps: Sequence[Step]) -> dict[int, list[int]]:
        """The buckets that each step holds the newest state of."""
        begin = max((k for k, step in enumerate(steps) if step.whole), default=0)
        counted = {step.step for step in steps[begin:]}
        newest = {bucket: step for step, bucket in self.steps.parts() if step in counted}
        chosen: dict[int, list[int]] = {}
        for bucket, step in newest.items():
            chosen.setdefault(step, []).append(bucket)
        return chosen

    def _n(self, steps: Sequence[Step]) -> int:
        return [step.whole for step in steps if step.whole][-1]

    def where(self, steps: Sequence[Step], buckets: Sequence[int] | None = None) -> str:
        """The condition, on partitions only, that picks a state's rows."""
        wanted = None if buckets is None else set(buckets)
        terms = []
        for step, held in self._chosen(steps).items():
            some = held if wanted is None else [bucket for bucket in held if bucket in wanted]
            if some:
                terms.append(f"({STEP} = {step} AND {BUCKET} IN ({', '.join(map(str, sorted(some)))}))")
        return f"({' OR '.join(terms)})" if terms else "false"

    def rows(self, steps: Sequence[Step], buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest rows of a state, deletions included."""
        return read_table(self.spark, self.steps.table).where(self.where(steps, buckets)).drop(STEP, BUCKET)

    def live(self, steps: Sequence[Step], buckets: Sequence[int] | None = None) -> DataFrame:
        return self.rows(steps, buckets).where(~F.col("status").eqNullSafe(DELETED))

    def current(
        self, steps: Sequence[Step], compare: Sequence[str], buckets: Sequence[int] | None = None, as_kept: bool = False
    ) -> DataFrame:
        """The live rows of a state with the hash of ``compare``, as stored where it covers the same columns.

        It is given as text, or with ``as_kept`` in the form of ``hash_of``.
        """
        rows = self.live(steps, buckets)
        covered = steps[-1].note == json.dumps([self.strict, list(compare)])
        known = F.col(HASH_COLUMN) if covered else self.hash_of(rows, compare)
        return rows.withColumn(HASH_COLUMN, F.lower(F.hex(known)) if self._as_bytes and not as_kept else known)

    def _bucket(self, rows: DataFrame, n: int) -> Column:
        types = self.spark.table(self.log).schema
        keys = [F.col(f"`{key}`").cast(types[key].dataType) for key in as_list(self.keys)]
        return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")

    def buckets_of(self, rows: DataFrame, steps: Sequence[Step]) -> list[int]:
        """The buckets that hold the keys of some rows; at most as many as there are."""
        bucket = self._bucket(rows, self._n(steps)).alias(BUCKET)
        return sorted(row[0] for row in rows.select(bucket).distinct().collect())

    def _newest_first(self) -> list[Column]:
        return [F.col("ingestion_timestamp").desc(), F.col(BATCH).desc()]

    def at(self, load: int) -> list[Step]:
        """The steps that give the state after a load of the log, made now if there are none.

        The state before the last step is still whole; an older one is drawn from the log.
        Steps that lead past the load count no more.
        """
        steps = self.steps.noted()
        kept = [step for step in steps if step.load <= load]
        if not kept or len(kept) < len(steps) - 1 or not any(step.whole for step in kept):
            return self._start(load, steps)
        if kept[-1].note != self._covers:
            return self._start(load, steps)
        if len(kept) < len(steps):
            self.steps.note(kept)
        if kept[-1].load < load:
            return self._follow(kept, load)
        return kept

    def _log(self, after: int, upto: int) -> DataFrame:
        return read_table(self.spark, self.log).where((F.col(BATCH) > after) & (F.col(BATCH) <= upto))

    def _start(self, load: int, steps: Sequence[Step]) -> list[Step]:
        """Draw the newest rows from the whole log."""
        log = read_table(self.spark, self.log).where(F.col(BATCH) <= load)
        one_load = sum(known <= load for known in batches(self.spark, self.log)) == 1  # with each key once
        return self._whole(log, log.count(), load, steps, ranked=not one_load)

    def _newest_of(self, rows: DataFrame, n: int) -> DataFrame:
        """The newest row of each key, dealt by buckets once, for the rank and the files."""
        dealt = rows.withColumn(BUCKET, self._bucket(rows, n)).repartition(BUCKET)
        return latest_version(dealt, [BUCKET, *as_list(self.keys)], self._newest_first())

    def _whole(self, rows: DataFrame, about: int, load: int, steps: Sequence[Step], ranked: bool) -> list[Step]:
        n = min(MOST_BUCKETS, max(1, -(-about // self.bucket_rows)))
        number = _next(steps, self.steps.parts() if steps else [])
        newest = self._newest_of(rows, n) if ranked else rows.withColumn(BUCKET, self._bucket(rows, n)).repartition(BUCKET)
        written = self.steps.write(self._hashed(newest), number)
        done = [*[step for step in steps if step.load <= load][-1:], Step(number, load, n, written, note=self._covers)]
        self.steps.note(done)
        return done

    def _follow(self, steps: list[Step], load: int) -> list[Step]:
        """Bring the buckets up to date that hold a change of the loads since."""
        changes = self._log(steps[-1].load, load).withColumn(HASH_COLUMN, self._no_hash)
        n = self._n(steps)
        touched = self.buckets_of(changes, steps)
        both = self.rows(steps, touched).unionByName(changes)
        number = _next(steps, self.steps.parts())
        rows = self.steps.write(self._hashed(self._newest_of(both, n)), number) if touched else 0
        done = [*steps, Step(number, load, 0, rows, note=self._covers)]
        if n < MOST_BUCKETS and rows > len(touched) * self.bucket_rows * OUTGROWN:
            whole = self.rows(done)
            return self._whole(whole, whole.count(), load, done, ranked=False)
        self.steps.note(done)
        return done

    def tidy(self) -> None:
        """Drop what neither the current state nor the one before it needs."""
        steps = self.steps.noted()
        needed = {(s, b) for state in (steps, steps[:-1]) if state for s, held in self._chosen(state).items() for b in held}
        self.steps.drop([part for part in self.steps.parts() if part not in needed])
        used = {step for step, _ in needed}
        begin = max((k for k, step in enumerate(steps[:-1]) if step.whole), default=0)
        kept = [step for step in steps[begin:-2] if step.step in used or step.whole]
        self.steps.note([*kept, *steps[max(begin, len(steps) - 2) :]])


SIGNED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Totals:
    """Measures of the live rows per group, kept by what each load changes.

    Counts, and sums of integers and decimals, change by the rows that a load takes away
    and adds. The other measures are worked out anew for the groups that a load touches.
    What a step changes is written, not the totals; readers add the steps up, and once
    changes make up a share of all totals (ADDED_UP), they are added up for good.
    """

    newest: NewestRows
    table: str
    group_by: Sequence[str]
    measures: Mapping[str, tuple[str, str]]

    @property
    def steps(self) -> Steps:
        return Steps(self.newest.spark, f"{self.table}_totals_{crc32(self._rules.encode()):08x}")

    @property
    def _rules(self) -> str:
        return json.dumps([list(self.group_by), [[name, *rule] for name, rule in self.measures.items()]])

    def _bucket(self, rows: DataFrame, state: Sequence[Step]) -> DataFrame:
        """There are no more groups than rows, so what buckets are enough for those are for these."""
        bucket = F.pmod(F.xxhash64(*self.group_by), F.lit(self.newest._n(state))).cast("int")
        return rows.withColumn(BUCKET, bucket).repartition(BUCKET)

    def _kinds(self, rows: DataFrame) -> tuple[list[tuple[str, str, str]], dict[str, tuple[str, str]]]:
        """Measures that change by differences, with function and column, and the others."""
        measure_columns(self.measures)  # unknown functions are refused
        signed, others = [], {}
        for name, (function, column) in self.measures.items():
            kind = None if column == "*" else rows.schema[column].dataType
            exact = isinstance(kind, SIGNED) and function in ("sum", "avg") or isinstance(kind, T.DecimalType) and function == "sum"
            if function == "count" or exact:
                signed.append((name, function, column))
            else:
                others[name] = (function, column)
        return signed, others

    def _changes(self, rows: DataFrame, sign: Column, *more: Column) -> DataFrame:
        """Per group the change in rows, and in sums and counts of each measure."""
        signed, _ = self._kinds(rows)
        weighted = rows.withColumn("_sign", sign)
        columns = [F.sum("_sign").alias("_n")]
        for k, (_, function, column) in enumerate(signed):
            there = F.lit(True) if column == "*" else F.col(f"`{column}`").isNotNull()
            columns.append(F.sum(F.when(there, F.col("_sign")).otherwise(0)).alias(f"_c{k}"))
            if function != "count":
                columns.append(F.sum(F.col(f"`{column}`") * F.col("_sign")).alias(f"_s{k}"))
        return weighted.groupBy(*self.group_by).agg(*columns, *more)

    def _with_others(self, changes: DataFrame, live: DataFrame, some: bool) -> DataFrame:
        """The changes with the other measures of their groups, worked out from the live rows."""
        _, others = self._kinds(live)
        if not others:
            return changes.withColumn("_again", F.lit(None).cast("struct<none:int>"))
        pairs = NullSafeKeys(live, changes, list(self.group_by))
        left = pairs.add(changes)
        mine = pairs.add(live)
        if some:
            mine = mine.join(left.select(*pairs.columns), list(pairs.columns), "left_semi")
        again = aggregate(mine, pairs.columns, others).select(*pairs.columns, F.struct(*others).alias("_again"))
        return left.join(again, list(pairs.columns), "left").drop(*pairs.columns)

    def _between(self, before: Sequence[Step], after: Sequence[Step]) -> DataFrame:
        """What changed from one state of the newest rows to the next, written to the shared folder.

        Only buckets that hold a change are read. Rows that stay are the same in both states
        and cancel out, so rows are added up where they lie and no keys are matched. A group
        is concerned if a row of the loads since is in it, or if it has lost rows.
        """
        since = before[-1].load
        touched = self.newest.buckets_of(self.newest._log(since, after[-1].load), after)
        sides = []
        for state, sign in ((before, -1), (after, 1)):
            fresh = F.col(BATCH) > since if sign > 0 else F.lit(False)
            rows = self.newest.live(state, touched)
            sides.append(rows.withColumns({"_one": F.lit(sign).cast("long"), "_fresh": fresh}))
        both = sides[0].unionByName(sides[1])
        changes = self._changes(both, F.col("_one"), F.bool_or("_fresh").alias("_fresh"))
        return materialise(changes.where(F.col("_fresh") | (F.col("_n") != 0)).drop("_fresh"), "totals")

    def follow(self, state: Sequence[Step]) -> list[Step]:
        """The steps that give the totals of a state of the newest rows, made now as far as needed."""
        steps = [step for step in self.steps.noted() if step.note == self._rules]
        known = {step.made_from: k for k, step in enumerate(steps)}
        now = state[-1].step
        if now in known:
            return steps[: known[now] + 1]
        before = state[:-1]
        live = self.newest.live(state)
        parts = self.steps.parts() if table_exists(self.newest.spark, self.steps.table) else []
        number = _next(steps, parts)
        if before and not state[-1].whole and before[-1].step in known:
            steps = steps[: known[before[-1].step] + 1]
            rows = self._with_others(self._between(before, state), live, some=True)
            step = Step(number, state[-1].load, 0, 0, now, self._rules)
        else:
            steps = []
            rows = self._with_others(self._changes(live, F.lit(1).cast("long")), live, some=False)
            step = Step(number, state[-1].load, 1, 0, now, self._rules)
        written = self.steps.write(self._bucket(rows, state), number)
        steps = [*steps, Step(step.step, step.load, step.whole, written, now, self._rules)]
        base = next(k for k in range(len(steps) - 1, -1, -1) if steps[k].whole)
        if not steps[-1].whole and sum(s.rows for s in steps[base + 1 :]) * ADDED_UP > steps[base].rows:
            written = self.steps.write(self._bucket(self._added(steps), state), number + 1)
            # The step before stays, for when the last load is done again.
            steps = [*steps[:-1], Step(number + 1, state[-1].load, 1, written, now, self._rules)]
        self.steps.note(steps)
        return steps

    def where(self, steps: Sequence[Step]) -> str:
        base = next(k for k in range(len(steps) - 1, -1, -1) if steps[k].whole)
        return f"{STEP} IN ({', '.join(str(step.step) for step in steps[base:])})"

    def _added(self, steps: Sequence[Step]) -> DataFrame:
        """All steps as one."""
        rows = read_table(self.newest.spark, self.steps.table).where(self.where(steps))
        numbers = [c for c in rows.columns if c not in (*self.group_by, "_again", STEP, BUCKET)]
        # Decimals keep their declared type when they are added up again.
        sums = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in numbers]
        return rows.groupBy(*self.group_by).agg(*sums, F.max_by("_again", STEP).alias("_again")).where("_n > 0")

    def select_text(self, steps: Sequence[Step], live: DataFrame) -> str:
        """A query for the totals, with the types that an aggregate over all rows has."""
        signed, others = self._kinds(live)
        kinds = {f.name: f.dataType.simpleString() for f in aggregate(live, self.group_by, self.measures).schema.fields}
        place = {name: k for k, (name, _, _) in enumerate(signed)}
        inner, outer = ["sum(_n) AS _n"], []
        if others:
            inner.append(f"max_by(_again, {STEP}) AS _again")
        for name, (function, _) in self.measures.items():
            k = place.get(name)
            if k is None:
                value = f"_again.`{name}`"
            elif function == "count":
                value = f"_c{k}"
            else:
                whole = f"_s{k}" if function == "sum" else f"_s{k} / CAST(_c{k} AS double)"
                value = f"CASE WHEN _c{k} > 0 THEN {whole} END"
            if k is not None:
                inner.append(f"sum(_c{k}) AS _c{k}")
                if function != "count":
                    inner.append(f"sum(_s{k}) AS _s{k}")
            outer.append(f"CAST({value} AS {kinds[name]}) AS `{name}`")
        groups = ", ".join(f"`{name}`" for name in self.group_by)
        added = f"SELECT {groups}, {', '.join(inner)} FROM {self.steps.table} WHERE {self.where(steps)} GROUP BY {groups}"
        return f"SELECT {groups}, {', '.join(outer)} FROM ({added}) WHERE _n > 0"

    def tidy(self) -> None:
        """Drop what neither the current totals nor those before them need."""
        if not (steps := self.steps.noted()):
            return
        needed = set()
        for state in (steps, steps[:-1]):
            if state:
                base = next((k for k in range(len(state) - 1, -1, -1) if state[k].whole), None)
                needed |= {step.step for step in state[base:]} if base is not None else set()
        self.steps.drop([part for part in self.steps.parts() if part[0] not in needed])
        self.steps.note([step for step in steps if step.step in needed])
        schema, _, name = self.steps.table.rpartition(".")
        for row in self.newest.spark.sql(f"SHOW TABLES IN {schema} LIKE '{name[:-8]}*'").collect():
            if row["tableName"] != name and len(row["tableName"]) == len(name):  # of other rules than now
                self.newest.spark.sql(f"DROP TABLE {schema}.{row['tableName']}")
