"""The control-driven run: staging, history, surrogate keys, dimensions, facts, checks."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import astuple, dataclass, field, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.columns import refuse_columns
from sediment.functions.lineage import add_metadata, batch_time
from sediment.operators.compare import unique_by
from sediment.operators.history import (
    RESERVED,
    comparable_columns,
    latest_version,
    merge_type1,
    merge_type2,
    open_history,
    without_versions,
)
from sediment.operators.keys import UNKNOWN_MEMBER, surrogate_keys
from sediment.operators.model import aggregate, dimension, fact, point_in_time
from sediment.operators.quality import ForeignKey, PrimaryKey, enforce_keys
from sediment.operators.skew import lookup_join
from sediment.session import materialise
from sediment.sinks.publication import (
    GONE,
    KEY,
    Entry,
    discard_version,
    identified,
    last_changes,
    may_carry_on,
    prepare_changes,
    prepare_version,
    publish_versions,
    read_entry,
    settle,
    states,
)
from sediment.sinks.tables import BATCH, batches, prepare_table, publish_table, replace_table, write_batch
from sediment.sources.control import Source, control_frame
from sediment.sources.files import FILE_TYPES, read_files
from sediment.sources.tables import read_database_table, read_table, table_exists

# The schemas of the warehouse layers.
STAGING, HISTORY, KEYS, DIMENSIONS, FACTS = "staging", "psh", "sk", "dim", "fact"

Transform = Callable[..., DataFrame]

# The table property that notes the loads of a history, and the inverse share of the
# current versions that may change before a run writes them all again.
LOADS = "sediment.loads"
REWRITE = 4
# The table property that notes which attempt at a load a fact's rows are from.
ATTEMPTS = "sediment.attempts"
#: Loads whose input stays noted, so that they can be done again after an older one is.
REDONE = 32


@dataclass(frozen=True)
class Load:
    """One run's part of a history: the run that wrote the last full set, current versions, changes since.

    ``input`` is where its staged rows lie, and ``after`` the ``attempt`` of the load that
    it was derived from; a load whose predecessor has been done again since is stale.
    """

    batch: int
    base: int
    rows: int
    changed: int = 0
    at: str = ""
    load_type: str = "Full"
    input: str = ""
    attempt: str = ""
    after: str = ""


@dataclass(frozen=True)
class Fact:
    """A fact table: where it comes from, the dimensions it points to, and its grain.

    ``dimensions`` maps a key column to (dimension, {source column: dimension column}).
    With ``grain`` the rows are added up to it; the measures are ``{alias: (function,
    column)}``. ``as_of`` maps a key column to (time column, {attribute: column}): the
    attributes that the member's version valid at that time had become columns of the row.
    """

    name: str
    source: str
    dimensions: Mapping[str, tuple[str, Mapping[str, str]]]
    columns: Sequence[str] = ()
    grain: Sequence[str] = ()
    measures: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    as_of: Mapping[str, tuple[str, Mapping[str, str]]] = field(default_factory=dict)


def transform(
    df: DataFrame, table: str, source: Source, registry: Mapping[str, Transform], **options: object
) -> DataFrame:
    """Apply the transformation registered for a table, if there is one."""
    step = registry.get(table)
    return df.transform(step, source, **options) if step else df


def create_control_table(spark: SparkSession, table: str, definitions: Iterable[Mapping[str, object]]) -> DataFrame:
    """Check the control rows, store them and return the stored table."""
    replace_table(control_frame(spark, definitions), table)
    return read_table(spark, table)


def extract_source(spark: SparkSession, source: Source, schema: T.StructType | str | None = None) -> DataFrame:
    """The data a control row points to: a file, a catalog table, or ``url;table``.

    JSON files hold a record per line; csv values may hold line breaks. Under a schema, a
    record that does not fit it is an error. A database connection may go on with options,
    ``url;table;user=...;partition_column=...;partitions=8``; a value ``env:NAME`` is taken
    from the environment, so that the control table holds no password.
    """
    if source.source_type in FILE_TYPES:
        return read_files(spark, source.connection, source.source_type, schema, lines=source.source_type == "json")
    if source.source_type == "database":
        url, table, options = database_connection(source.connection)
        column, parts = options.pop("partition_column", None), int(options.pop("partitions", 1))
        return read_database_table(
            spark, table, url, properties=options, partition_column=column, partitions=parts
        )
    return read_table(spark, source.connection)


def database_connection(text: str) -> tuple[str, str, dict[str, str]]:
    """URL, table and options of a control row's connection.

    The URL may hold semicolons itself; the options are the last parts of the form
    ``name=value``, before which the table stands.
    """
    parts = text.split(";")
    options: dict[str, str] = {}
    while len(parts) > 2 and "=" in parts[-1]:
        name, _, value = parts.pop().partition("=")
        options[name.strip()] = os.environ[value[4:]] if value.startswith("env:") else value
    return ";".join(parts[:-1]), parts[-1], options


@dataclass
class Warehouse:
    """One run of the warehouse, identified by an increasing ``batch_id``.

    A run that is repeated reads only earlier runs and replaces what it wrote itself. If
    there are later runs, they are done again in order from the rows they had staged.
    """

    spark: SparkSession
    batch_id: int
    at: datetime
    transforms: Mapping[str, Transform] = field(default_factory=dict)
    schemas: Mapping[str, T.StructType | str] = field(default_factory=dict)
    #: Give each dimension a row of the unknown member, so that keys of late members hold.
    unknown_member: bool = False
    #: Called for each table as it is published; an error undoes the publication of all.
    announce: Callable[[Entry], None] | None = None
    #: Dimensions whose transformation treats each row by itself and is the same in each run:
    #: those of changed members alone are transformed and written. One without any is such.
    row_wise: Collection[str] = ()
    #: Write dimensions and facts whole whatever has changed.
    rebuild: bool = False

    def stage(self, source: Source, data: DataFrame) -> DataFrame:
        """Recreate the staging table of a source."""
        self._stage(source, data)
        return read_table(self.spark, f"{STAGING}.{source.source_name}")

    def _stage(self, source: Source, data: DataFrame) -> str:
        """The same; the folder of the rows, which later runs leave as it is."""
        prepared = prepare_table(add_metadata(data, source.source_name, at=self.at), f"{STAGING}.{source.source_name}")
        publish_table(self.spark, prepared)
        return prepared.location

    def _earlier(self, table: str) -> int | None:
        known = [batch for batch in batches(self.spark, table) if batch < self.batch_id]
        return known[-1] if known else None

    def keep_history(self, source: Source, staged: DataFrame, location: str = "") -> DataFrame:
        """Merge staged rows into the history table and return the current versions.

        A type 2 run writes the versions it opened and those it closed, as partitions of
        its own, and nothing else: bytes written follow the load, not the table. Current
        versions are those opened since the last full set less those closed since. Once
        changes add up to a share of the current versions (REWRITE), a run writes a full
        set again, so reading stays in proportion too. The closed past is never read. Sets
        that are superseded are dropped, bar the one before. Type 1 writes full sets.

        ``location`` is where the staged rows lie, for when the load has to be done again.
        """
        table = f"{HISTORY}.{source.source_name}"
        keys = list(source.primary_key)
        compare = list(source.compare_columns) or comparable_columns(staged, keys)
        begin = batch_time(self.at)
        refuse_columns(staged, RESERVED, "a history")
        last = self._load_before(table, self.batch_id - 1)
        noted = Load(
            self.batch_id,
            self.batch_id,
            0,
            at=self.at.isoformat(),
            load_type=source.load_type,
            input=location,
            attempt=uuid.uuid4().hex[:8],
            after=last.attempt if last else "",
        )
        if last is None:
            rows = open_history(unique_by(staged, keys, "new"), begin)
            load = replace(noted, rows=write_batch(rows, table, self.batch_id, ["is_current"])["rows"])
        elif source.scd_type == 1:
            current = self._current(table, keys, last)
            kept = merge_type1(current, staged.withColumns({"valid_from": begin}), keys, compare, source.delta)
            rows = kept.withColumns({"valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)})
            load = replace(noted, rows=write_batch(rows, table, self.batch_id, ["is_current"])["rows"])
        else:
            current = self._current(table, keys, last)
            changes = materialise(
                merge_type2(current, staged, keys, begin, compare, source.delta, changes_only=True), "changes"
            )
            opened, closed = changes.agg(F.count_if("is_current"), F.count_if(~F.col("is_current"))).first()
            changed = last.changed + opened + closed
            load = replace(noted, base=last.base, rows=last.rows + opened - closed, changed=changed)
            if load.changed * REWRITE > load.rows:
                load = replace(load, base=self.batch_id, changed=0)
                kept = without_versions(current, changes.where("NOT is_current"), keys)
                changes = changes.unionByName(kept)
            write_batch(changes, table, self.batch_id, ["is_current"])
        self._note_loads(table, [load])
        if last is not None:
            for old in batches(self.spark, table):
                if old < last.base:
                    self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH}={old}, is_current=true)")
        return self._current(table, keys, load)

    def _loads(self, table: str) -> list[Load]:
        """What runs noted on the table, oldest first."""
        if not table_exists(self.spark, table):
            return []
        found = self.spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == LOADS).collect()
        return [Load(*entry) for entry in json.loads(found[0]["value"])] if found else []

    def _load_before(self, table: str, batch_id: int) -> Load | None:
        known = [load for load in self._loads(table) if load.batch <= batch_id]
        return known[-1] if known else None

    def _note_loads(self, table: str, fresh: Sequence[Load]) -> None:
        """In one step; of old loads only what reading needs stays noted."""
        replaced = {load.batch for load in fresh}
        loads = sorted([*fresh, *(load for load in self._loads(table) if load.batch not in replaced)], key=lambda load: load.batch)
        loads = [replace(load, input="") if k < len(loads) - REDONE else load for k, load in enumerate(loads)]
        noted = json.dumps([astuple(load) for load in loads]).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOADS}' = '{noted}')")

    def _prepare_redo(self, source: Source) -> None:
        """Make sure that this load can be done again beneath later ones, or refuse before anything is written.

        The later loads need their staged rows, and this one the current versions of the
        load before it. Where those were superseded and dropped, a type 2 history still
        tells them, by the times its versions held, and they are written again.
        """
        table, keys = f"{HISTORY}.{source.source_name}", list(source.primary_key)
        loads = self._loads(table)
        later = [load for load in loads if load.batch > self.batch_id]
        if not later:
            return
        before = self._load_before(table, self.batch_id - 1)
        if lost := [load.batch for load in later if not load.input]:
            raise ValueError(f"run {self.batch_id} of '{source.source_name}' can't be repeated: the rows of runs {lost} are not noted")
        times = [*([before.at] if before else []), self.at.isoformat(), *(load.at for load in later)]
        if any(not a or datetime.fromisoformat(a) >= datetime.fromisoformat(b) for a, b in zip(times, times[1:], strict=False)):
            raise ValueError(f"run {self.batch_id} of '{source.source_name}' must have a time between the runs around it")
        dropped_below = loads[-2].base
        if before is None or before.base >= dropped_below:
            return
        if source.scd_type == 1:
            raise ValueError(f"run {self.batch_id} of '{source.source_name}' can't be repeated: type 1 keeps no state that old")
        then = batch_time(datetime.fromisoformat(before.at))
        whole = self._whole(table, keys, loads[-1])
        held = whole.where((F.col("valid_from") <= then) & (F.col("valid_to").isNull() | (F.col("valid_to") > then)))
        held = held.withColumns({"valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)})
        # A repeated attempt at this may find some of these rows written already.
        current = held.dropDuplicates([*keys, "valid_from"])
        closed = read_table(self.spark, table).where((F.col(BATCH) == before.batch) & ~F.col("is_current")).drop(BATCH)
        write_batch(materialise(current.unionByName(closed), "restored"), table, before.batch, ["is_current"])
        rows = read_table(self.spark, table).where((F.col(BATCH) == before.batch) & F.col("is_current")).count()
        self._note_loads(
            table,
            [
                replace(load, base=before.batch, **({"rows": rows, "changed": 0} if load.batch == before.batch else {}))
                for load in loads
                if load.batch >= before.batch and load.base <= before.batch
            ],
        )

    def _redo(self, source: Source) -> None:
        """Do the loads again that were derived from an attempt that is no more, in order."""
        table = f"{HISTORY}.{source.source_name}"
        while True:
            loads = self._loads(table)
            pairs = zip(loads, loads[1:], strict=False)
            stale = next((load for before, load in pairs if load.after and load.after != before.attempt), None)
            if stale is None:
                return
            run = replace(self, batch_id=stale.batch, at=datetime.fromisoformat(stale.at))
            own = replace(source, load_type=stale.load_type)
            run.keep_history(own, self._staged_rows(table, stale), stale.input)

    def _staged_rows(self, table: str, load: Load) -> DataFrame:
        """The rows that a load had staged."""
        try:
            return self.spark.read.parquet(load.input)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return read_table(self.spark, table).drop(*RESERVED).limit(0)  # it staged none

    def _current(self, table: str, keys: Sequence[str], load: Load, since: int | None = None) -> DataFrame:
        """The current versions after a load; with ``since`` those alone that runs after that one opened."""
        rows = read_table(self.spark, table).where(F.col(BATCH).between(load.base, load.batch))
        if since is not None:
            rows = rows.where(F.col(BATCH) > since)
        opened = rows.where("is_current")
        if load.batch > load.base:
            closed = rows.where(~F.col("is_current") & (F.col(BATCH) > load.base))
            opened = without_versions(opened, closed, keys, BATCH)
        return opened.drop(BATCH)

    def _whole(self, table: str, keys: Sequence[str], load: Load) -> DataFrame:
        """Every version after a load."""
        closed = read_table(self.spark, table).where(~F.col("is_current") & (F.col(BATCH) <= load.batch)).drop(BATCH)
        return closed.unionByName(self._current(table, keys, load))

    def _own_load(self, source: Source) -> Load:
        """The newest load up to this run; an error if an older one was repeated and the runs after it were not."""
        loads = [load for load in self._loads(f"{HISTORY}.{source.source_name}") if load.batch <= self.batch_id]
        if any(load.after and load.after != before.attempt for before, load in zip(loads, loads[1:], strict=False)):
            raise RuntimeError(f"'{source.source_name}' has runs that must be done again; run it to do so")
        return loads[-1]

    def current_history(self, source: Source) -> DataFrame:
        return self._current(f"{HISTORY}.{source.source_name}", list(source.primary_key), self._own_load(source))

    def full_history(self, source: Source) -> DataFrame:
        """Every version up to this run."""
        return self._whole(f"{HISTORY}.{source.source_name}", list(source.primary_key), self._own_load(source))

    def assign_keys(self, source: Source, history: DataFrame, keep: bool = False) -> DataFrame:
        """Give keys not seen before a surrogate key and return the whole map.

        With ``keep`` the keys that an earlier attempt of this run gave stay given.
        """
        table = f"{KEYS}.{source.source_name}"
        keys = list(source.primary_key)
        known = None
        if self._earlier(table) is not None or (keep and table_exists(self.spark, table)):
            known = read_table(self.spark, table).where(F.col(BATCH) < self.batch_id + keep)
        rows = surrogate_keys(history, keys, None if known is None else known.drop(BATCH))
        if keep and known is not None:
            rows = materialise(rows.unionByName(known.where(F.col(BATCH) == self.batch_id).drop(BATCH)), "keys")
        write_batch(rows, table, self.batch_id)
        return read_table(self.spark, table).where(F.col(BATCH) <= self.batch_id).drop(BATCH)

    def build_dimension(self, source: Source, history: DataFrame, key_map: DataFrame) -> Entry:
        """The rows of a dimension, written and not yet published.

        Where the dimension as published stands for an earlier load of a type 2 history, only
        the members that have versions opened or closed since are written, with a mark for
        those that are no more. It is written whole when its history is: then a quarter of
        the members has changed.
        """
        name, table, keys = source.source_name, f"{DIMENSIONS}.{source.source_name}", list(source.primary_key)

        def shaped(versions: DataFrame) -> DataFrame:
            rows = transform(dimension(versions, key_map, keys), name, source, self.transforms)
            if self.unknown_member:
                unknown = self.spark.createDataFrame([(UNKNOWN_MEMBER,)], "surrogate_key bigint")
                rows = rows.unionByName(unknown, allowMissingColumns=True)
            return rows

        rows = shaped(history)
        by_row = name not in self.transforms or name in self.row_wise
        if source.scd_type == 1 or not by_row or "surrogate_key" not in rows.columns:
            return prepare_version(rows, table, self.batch_id)
        rows, load = identified(rows, ["surrogate_key"]), self._own_load(source)
        found = self._carried(source, table, rows, load)
        if found is None:
            return prepare_version(rows, table, self.batch_id, made_from=load.attempt)
        state, since = found
        fresh = identified(shaped(self._current(f"{HISTORY}.{name}", keys, load, since)), ["surrogate_key"])
        touched = dimension(self._touched(source, load, since).select(*keys).distinct(), key_map, keys)
        unknown = self.spark.createDataFrame([(UNKNOWN_MEMBER,)], "surrogate_key bigint")
        touched = touched.select("surrogate_key").unionByName(unknown)  # it may be wanted no longer
        gone = touched.select(F.struct("surrogate_key").alias(KEY)).join(fresh.select(KEY), KEY, "left_anti")
        marks = gone.withColumn(GONE, F.lit(True))
        changes = fresh.unionByName(marks, allowMissingColumns=True)
        return prepare_changes(changes, state, self.batch_id, load.attempt)

    def _carried(self, source: Source, table: str, rows: DataFrame, load: Load) -> tuple[Entry, int] | None:
        """The newest state of a dimension that changes can follow, and the load that it stands for.

        Its load must be one that this load was derived from. An attempt that was replaced
        since is none.
        """
        loads = {one.attempt: one for one in self._loads(f"{HISTORY}.{source.source_name}") if one.batch <= load.batch}
        for state in [] if self.rebuild else states(self.spark, table):
            then = loads.get(state.made_from) if state.made_from else None
            if then and load.base <= then.batch and may_carry_on(rows, state):
                return state, then.batch
        return None

    def _touched(self, source: Source, load: Load, since: int) -> DataFrame:
        """Versions that runs after a load, up to another, opened or closed."""
        rows = read_table(self.spark, f"{HISTORY}.{source.source_name}")
        return rows.where((F.col(BATCH) > since) & (F.col(BATCH) <= load.batch))

    def fact_rows(self, spec: Fact, source: Source, staged: DataFrame) -> DataFrame:
        """All rows a fact stands for after this load, and after later ones if there are any.

        Each load keeps its rows as partitions of its own. A full load counts alone; a
        delta load adds to those since the last full one, the newest row of a key counting.
        """
        return self._fact_log(spec, source, staged)[0].drop(BATCH)

    def _fact_log(self, spec: Fact, source: Source, staged: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
        """The same with the load that brought each row, the last full load, and the newest."""
        table = f"{FACTS}.{spec.name}_rows"
        keys = list(source.primary_key)
        refuse_columns(staged, [BATCH, "is_full"], "a fact's rows")
        checked = unique_by(staged, keys, "new").withColumn("is_full", F.lit(not source.delta))
        if table_exists(self.spark, table):  # before the rows: no state may be taken for one made from them
            self._note_attempt(table)
        write_batch(checked, table, self.batch_id, ["is_full"])
        if str(self.batch_id) not in self._attempts(table):
            self._note_attempt(table)
        parts = [row[0].split("/") for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect()]
        loads = {int(batch.split("=")[1]): full == "is_full=true" for batch, full in parts}
        # A load without rows leaves no partition.
        loads.setdefault(self.batch_id, not source.delta)
        newest = max(loads)
        base = max([batch for batch, full in loads.items() if full], default=0)
        rows = read_table(self.spark, table).where(F.col(BATCH).between(base, newest))
        if base < newest:
            rows = latest_version(rows, keys, [F.col(BATCH).desc()])
        return rows.drop("is_full"), (base, newest)

    def _attempts(self, table: str) -> dict[str, str]:
        """The attempt that each load's rows of a fact are from."""
        if not table_exists(self.spark, table):
            return {}
        found = self.spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == ATTEMPTS).collect()
        return json.loads(found[0]["value"]) if found else {}

    def _note_attempt(self, table: str) -> None:
        noted = json.dumps(self._attempts(table) | {str(self.batch_id): uuid.uuid4().hex[:8]})
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{ATTEMPTS}' = '{noted}')")

    def build_fact(
        self,
        spec: Fact,
        source_rows: DataFrame,
        dimensions: Mapping[str, DataFrame],
        sources: Mapping[str, Source] | None = None,
        members: Mapping[str, Entry] | None = None,
        loads: tuple[int, int] | None = None,
    ) -> Entry:
        """The rows of a fact, written and not yet published.

        Given the prepared ``members`` and the last full and the newest of ``loads``, source
        rows come with their load, and only some are written where the fact as published can
        be carried on: those of later loads, and those whose members have come, gone or,
        under ``as_of``, changed since.
        """
        table = f"{FACTS}.{spec.name}"
        if spec.grain or not loads:
            return prepare_version(self._fact(spec, source_rows.drop(BATCH), dimensions, sources), table, self.batch_id)
        keys, full, newest = list(sources[spec.source].primary_key), loads[0], max(self.batch_id, loads[1])
        used = {name: members[name] for name, _ in spec.dimensions.values()}
        made_from = self._fact_origin(spec, newest, {name: entry.state for name, entry in used.items()})
        followed = {name: entry.follows for name, entry in used.items()}
        for state in [] if self.rebuild else states(self.spark, table):
            if full > state.batch_id or state.made_from != self._fact_origin(spec, state.batch_id, followed):
                continue
            rows = source_rows.withColumn("_wanted", F.col(BATCH) > state.batch_id)
            for key in spec.dimensions:
                rows = self._mark_affected(rows, spec, key, used, sources)
            changes = self._fact(spec, rows.where("_wanted").drop("_wanted"), dimensions, sources, keys)
            if may_carry_on(changes, state):
                return prepare_changes(changes, state, newest, made_from)
        whole = self._fact(spec, source_rows, dimensions, sources, keys)
        return prepare_version(whole, table, newest, made_from=made_from)

    def _fact_origin(self, spec: Fact, batch_id: int, members: Mapping[str, str]) -> str:
        """What a fact's state is made from: its definition, attempts at loads and states of dimensions."""
        attempts = self._attempts(f"{FACTS}.{spec.name}_rows")
        noted = {batch: attempt for batch, attempt in attempts.items() if int(batch) <= batch_id}
        return hashlib.sha256(json.dumps([repr(spec), noted, members], sort_keys=True).encode()).hexdigest()

    def _mark_affected(
        self, rows: DataFrame, spec: Fact, key: str, members: Mapping[str, Entry], sources: Mapping[str, Source]
    ) -> DataFrame:
        """Mark rows of a fact as wanted that a change of a dimension since the state before may concern."""
        name, references = spec.dimensions[key]
        entry = members[name]
        before = next(state for state in states(self.spark, f"{DIMENSIONS}.{name}") if state.state == entry.follows)
        columns = [F.col(f"`{target}`").alias(column) for column, target in references.items()]
        changes = last_changes(self.spark, entry)
        numbers = changes.select(F.col(f"{KEY}.surrogate_key").alias("surrogate_key")).distinct()
        old = read_entry(self.spark, before).join(numbers, "surrogate_key", "left_semi")
        old, new = (side.select(*columns, "surrogate_key") for side in (old, changes.where(f"NOT {GONE}")))
        found = old.exceptAll(new).unionByName(new.exceptAll(old)).drop("surrogate_key")
        if key in spec.as_of:
            load = self._own_load(sources[name])
            loads = {one.attempt: one for one in self._loads(f"{HISTORY}.{name}")}
            since = loads[before.made_from].batch
            found = found.unionByName(self._touched(sources[name], load, since).select(*columns))
        found = materialise(found.distinct().withColumn("_concerned", F.lit(True)), "concerned")
        joined = lookup_join(rows, found, list(references), "left")
        return joined.withColumn("_wanted", F.col("_wanted") | F.col("_concerned").isNotNull()).select(*rows.columns)

    def _fact(
        self,
        spec: Fact,
        rows: DataFrame,
        dimensions: Mapping[str, DataFrame],
        sources: Mapping[str, Source] | None,
        keys: Sequence[str] = (),
    ) -> DataFrame:
        """The rows of a fact, with their source's keys if these are given."""
        if keys:
            rows = identified(rows.drop(BATCH), list(keys))
        for key, (at, attributes) in spec.as_of.items():
            name, references = spec.dimensions[key]
            members = self.full_history((sources or {})[name]).select(
                *[F.col(f"`{target}`").alias(column) for column, target in references.items()],
                "valid_from",
                "valid_to",
                *[F.col(f"`{attribute}`").alias(column) for attribute, column in attributes.items()],
            )
            rows = point_in_time(rows, members, list(references), at, list(attributes.values()))
        wanted = {key: (dimensions[name], references) for key, (name, references) in spec.dimensions.items()}
        rows = fact(rows, wanted, [*spec.columns, *([KEY, GONE] if keys else [])])
        return aggregate(rows, spec.grain, spec.measures) if spec.grain else rows

    def run(
        self,
        plan: Sequence[Source],
        facts: Sequence[Fact] = (),
        constraints: Sequence[PrimaryKey | ForeignKey] = (),
        data: Mapping[str, DataFrame] | None = None,
    ) -> dict[str, DataFrame]:
        """All steps for all sources; fails when a declared key does not hold.

        Sources that feed a fact stop at staging, their rows being the facts themselves.
        ``data`` may hand over frames in place of a control row's connection. Dimensions
        and facts are written aside, checked, and published in one step: after a failed
        run readers still see all those of the run before. A run older than the newest
        publishes the state of the newest.
        """
        fact_sources = {spec.source for spec in facts}
        prepared: dict[str, Entry] = {}
        tables: dict[str, DataFrame] = {}
        settle(self.spark)
        try:
            self._build(plan, facts, data or {}, fact_sources, prepared, tables)
            known = dict(tables)
            if self.unknown_member:  # it has no business key, and is no orphan
                members = [source.source_name for source in plan if source.source_name in tables]
                known |= {n: tables[n].where(F.col("surrogate_key") != UNKNOWN_MEMBER) for n in members}
            primary = [c for c in constraints if isinstance(c, PrimaryKey)]
            enforce_keys(known, primary)
            enforce_keys(tables, [c for c in constraints if c not in primary])
            retired = publish_versions(self.spark, prepared.values(), told=self.announce)
        except Exception:
            for entry in prepared.values():
                discard_version(self.spark, entry)
            raise
        for entry in retired:
            discard_version(self.spark, entry)
        return tables

    def _build(
        self,
        plan: Sequence[Source],
        facts: Sequence[Fact],
        data: Mapping[str, DataFrame],
        fact_sources: set[str],
        prepared: dict[str, Entry],
        tables: dict[str, DataFrame],
    ) -> None:
        sources = {source.source_name: source for source in plan}
        members = [source for source in plan if source.source_name not in fact_sources]
        for source in members:
            self._redo(source)  # what an interrupted run left
            self._prepare_redo(source)
        staged: dict[str, DataFrame] = {}
        newest = self.batch_id
        for source in plan:
            extracted = data.get(source.source_name)
            if extracted is None:
                extracted = extract_source(self.spark, source, self.schemas.get(source.source_name))
            location = self._stage(source, extracted)
            rows = read_table(self.spark, f"{STAGING}.{source.source_name}")
            if source.source_name in fact_sources:
                staged[source.source_name] = transform(rows, source.source_name, source, self.transforms)
                continue
            self.keep_history(source, rows, location)
            self._redo(source)
            newest = max(newest, self._loads(f"{HISTORY}.{source.source_name}")[-1].batch)
        view = replace(self, batch_id=newest)
        for source in members:
            history, name = view.current_history(source), source.source_name
            key_map = view.assign_keys(source, history, keep=newest > self.batch_id)
            prepared[name] = view.build_dimension(source, history, key_map)
            tables[name] = read_entry(self.spark, prepared[name])
        for spec in facts:
            rows, loads = self._fact_log(spec, sources[spec.source], staged[spec.source])
            prepared[spec.name] = view.build_fact(spec, rows, tables, sources, prepared, loads)
            tables[spec.name] = read_entry(self.spark, prepared[spec.name])
