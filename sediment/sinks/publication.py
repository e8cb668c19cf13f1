"""Several tables published in one step.

Rows of a table's next state are written as a partition of its own, a version, of a table
in the schema ``runs``. What readers see is told by one catalog entry, the manifest: a view
of constants that names the version of each published table. The names that users read are
views that look their version up there, so replacing the manifest's text, one catalog
operation, moves all names at once. The manifest also names the state before; versions that
it does not name are no longer of use.

A table whose rows have a key may be carried on by changes: a state is then a whole version
and the versions of changes after it, in order. Changes hold the rows a run made anew, and a
row marked as gone for each key that has none any more. Readers take the rows of a key from
the last part that holds it. States share parts, so a run writes its own changes only.

One run publishes at a time: the manifest is read and replaced by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import astuple, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.columns import refuse_columns
from sediment.functions.types import table_ddl
from sediment.session import materialise
from sediment.sinks.tables import ensure_schema, quoted
from sediment.sources.tables import table_exists

# The schema of versions and manifest, and the column that tells versions apart.
RUNS, VERSION = "runs", "_version"
MANIFEST = f"{RUNS}.manifest"
# Columns of tables that may be carried on by changes: the key, as a struct, and the mark of a key without rows.
KEY, GONE = "_key", "_gone"
# Its place among the parts of a state, which only readers add.
PLACE = "_place_of_part"
#: The inverse share of a whole version that changes after it may reach before it is written anew.
REWRITE = 4
#: Changes a state may consist of before they are folded into one.
MOST_CHANGES = 64


@dataclass(frozen=True)
class Entry:
    """A version that a table has, or had before."""

    table: str
    storage: str
    #: The whole version and the changes after it, with commas between.
    version: str
    batch_id: int
    #: 0 is what readers see, 1 the state before, and so on.
    age: int = 0
    #: Rows of the whole version, and of all changes after it; kept for tables with keys.
    rows: int = 0
    changed: int = 0
    #: What the writer derived the state from, in its own words.
    made_from: str = ""
    #: The name of the state that it carries on; empty for one written whole.
    follows: str = ""

    @property
    def parts(self) -> list[str]:
        return self.version.split(",")

    @property
    def state(self) -> str:
        """A name that no other state of any table has."""
        return self.parts[-1]


def _plain(table: str) -> str:
    return table.replace("`", "")


def manifest(spark: SparkSession) -> list[Entry]:
    """What the manifest names; one row per table and state."""
    if not table_exists(spark, MANIFEST):
        return []
    return [Entry(*row) for row in spark.table(MANIFEST).collect()]


def _replace_manifest(spark: SparkSession, entries: Sequence[Entry]) -> None:
    """The one step that readers see."""
    ensure_schema(spark, RUNS)
    columns = "table_name, storage, version, batch_id, age, rows, changed, made_from, follows"
    if entries:
        rows = [[quoted(v) if isinstance(v, str) else f"{v}L" for v in astuple(entry)] for entry in entries]
        source = "VALUES " + ", ".join(f"({', '.join(row)})" for row in rows) + f" AS m({columns})"
    else:
        source = f"VALUES ('', '', '', 0L, 0L, 0L, 0L, '', '') AS m({columns}) WHERE table_name <> ''"
    spark.sql(f"CREATE OR REPLACE VIEW {MANIFEST} AS SELECT {columns} FROM {source}")


def _columns(frame: DataFrame) -> list[tuple[str, str]]:
    """Names and types, in which nested values may be null as they may in a table."""
    return [(field.name, field.dataType.simpleString()) for field in frame.schema.fields if field.name != VERSION]


def _seen(frame: DataFrame) -> list[str]:
    """The columns that readers see."""
    return [name for name, _ in _columns(frame) if name not in (KEY, GONE)]


def _keyed(frame: DataFrame) -> bool:
    return {KEY, GONE} <= set(frame.columns)


def identified(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows that may be carried on by changes, each known by the values of some columns."""
    refuse_columns(df, [KEY, GONE, PLACE], "a published table")
    return df.withColumns({KEY: F.struct(*keys), GONE: F.lit(False)})


def _merged(storage: str, names: Sequence[str], parts: str) -> str:
    """The rows of a state, given an expression of its parts: of each key those in the last part that holds it.

    The place of a part depends on the partition column alone, so files of other versions
    are not read, and changes, which are few, are found without reading whole versions.
    """
    seen = ", ".join(f"r.`{name}`" for name in names)
    place = f"array_position({parts}, {VERSION})"
    return (
        f"SELECT {seen} FROM (SELECT *, {place} AS {PLACE} FROM {storage} WHERE {place} > 0) r "
        f"LEFT JOIN (SELECT {KEY} AS _of, max({place}) AS _last FROM {storage} WHERE {place} > 1 GROUP BY {KEY}) c "
        f"ON r.{KEY} = c._of WHERE NOT r.{GONE} AND (c._last IS NULL OR c._last = r.{PLACE})"
    )


def _version_rows(spark: SparkSession, storage: str, version: str) -> DataFrame:
    return spark.table(storage).where(F.col(VERSION) == version).drop(VERSION)


def read_entry(spark: SparkSession, entry: Entry) -> DataFrame:
    """The rows of a state, its files found while planning."""
    if len(entry.parts) == 1:
        rows = _version_rows(spark, entry.storage, entry.version)
        return rows.where(f"NOT {GONE}").drop(KEY, GONE) if _keyed(rows) else rows
    parts = f"array({', '.join(quoted(part) for part in entry.parts)})"
    return spark.sql(_merged(entry.storage, _seen(spark.table(entry.storage)), parts))


def last_changes(spark: SparkSession, entry: Entry) -> DataFrame:
    """What the last part of a state holds, with keys and marks."""
    return _version_rows(spark, entry.storage, entry.state)


def states(spark: SparkSession, table: str) -> list[Entry]:
    """The states of a table that can be read and lie where the newest does, newest first."""
    found = sorted((entry for entry in manifest(spark) if entry.table == _plain(table)), key=lambda entry: entry.age)
    return [entry for entry in found if entry.storage == found[0].storage]


def may_carry_on(df: DataFrame, state: Entry) -> bool:
    """Whether changes of these columns can follow a state, and are still few enough beside it."""
    spark = df.sparkSession
    if not _keyed(df) or state.changed * REWRITE > state.rows:
        return False
    return table_exists(spark, state.storage) and _columns(spark.table(state.storage)) == _columns(df)


def read_published(spark: SparkSession, table: str, age: int = 0) -> DataFrame:
    """A published table as it stands, or as it stood before."""
    for entry in manifest(spark):
        if entry.table == _plain(table) and entry.age == age:
            return read_entry(spark, entry)
    raise ValueError(f"'{table}' is not published")


def prepare_version(
    df: DataFrame,
    table: str,
    batch_id: int,
    types: Mapping[str, T.DataType] | None = None,
    made_from: str = "",
) -> Entry:
    """Write the next state of a table whole, which readers don't see yet.

    A table whose columns change gets a new storage; otherwise versions share one. Rows
    given by ``identified`` may be followed by changes.
    """
    spark, table = df.sparkSession, _plain(table)
    refuse_columns(df, [VERSION], "a published table")
    ensure_schema(spark, RUNS)
    known = {entry.table: entry.storage for entry in manifest(spark) if not entry.age}
    version = f"{batch_id}-{uuid.uuid4().hex}"
    storage = known.get(table)
    if storage is None or _columns(spark.table(storage)) != _columns(df):
        storage = f"{RUNS}.{table.replace('.', '__')}_{uuid.uuid4().hex[:8]}"
        columns = table_ddl(df.withColumn(VERSION, F.lit("")), types or {})
        spark.sql(f"CREATE TABLE {storage} ({columns}) USING parquet PARTITIONED BY ({VERSION})")
    entry = Entry(table, storage, version, batch_id, made_from=made_from)
    written = _write_part(df, entry)
    return replace(entry, rows=written) if _keyed(df) else entry


def prepare_changes(df: DataFrame, state: Entry, batch_id: int, made_from: str = "") -> Entry:
    """Write changes that carry a state on, which readers don't see yet; its own rows stay as they are.

    Where a state has many changes, these are written with the earlier ones as one part.
    """
    spark = df.sparkSession
    version, parts, changed = f"{batch_id}-{uuid.uuid4().hex}", state.parts, state.changed
    if len(parts) > MOST_CHANGES:
        fresh = materialise(df, "changes")
        earlier = spark.table(state.storage).where(F.col(VERSION).isin(parts[1:]))
        place = F.array_position(F.lit(parts), F.col(VERSION))
        newest = Window.partitionBy(KEY).orderBy(F.desc("_place"))
        last = earlier.withColumn("_place", place).withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
        kept = last.drop("_place", "_rank", VERSION).join(fresh.select(KEY).distinct(), KEY, "left_anti")
        df, parts, changed = fresh.unionByName(kept), parts[:1], 0
    own = replace(state, version=version, batch_id=batch_id, age=0, made_from=made_from, follows=state.state)
    written = _write_part(df, own)
    return replace(own, version=",".join([*parts, version]), changed=changed + written)


def _write_part(df: DataFrame, entry: Entry) -> int:
    """Write one version, and count it where its rows have keys."""
    spark = df.sparkSession
    try:
        spark.sql(f"INSERT INTO {entry.storage} PARTITION ({VERSION}={quoted(entry.version)}) SELECT * FROM {{rows}}", rows=df)
    except Exception:
        discard_version(spark, entry)
        raise
    return _version_rows(spark, entry.storage, entry.version).count() if _keyed(df) else 0


def discard_version(spark: SparkSession, entry: Entry) -> None:
    """Remove the parts of a state, and its storage, that the manifest does not name."""
    named = [known for known in manifest(spark) if known.storage == entry.storage]
    kept = {part for known in named for part in known.parts}
    for part in entry.parts:
        if part not in kept:
            spark.sql(f"ALTER TABLE {entry.storage} DROP IF EXISTS PARTITION ({VERSION}={quoted(part)})")
    if not named:
        spark.sql(f"DROP TABLE IF EXISTS {entry.storage}")


def _lookup(spark: SparkSession, entry: Entry) -> str:
    """The text of the view that a name stands for."""
    stored = spark.table(entry.storage)
    where = f"table_name = {quoted(entry.table)} AND storage = {quoted(entry.storage)}"
    if len(entry.parts) > 1:
        return _merged(entry.storage, _seen(stored), f"(SELECT min_by(split(version, ','), age) FROM {MANIFEST} WHERE {where})")
    names = ", ".join(f"`{name}`" for name in _seen(stored))
    newest = f"SELECT min_by(version, age) FROM {MANIFEST} WHERE {where}"
    return f"SELECT {names} FROM {entry.storage} WHERE {VERSION} = ({newest})" + (f" AND NOT {GONE}" if _keyed(stored) else "")


def _read_by(spark: SparkSession, table: str) -> tuple[str | None, bool]:
    """The storage that a name's view reads, and whether it merges parts; none where there is no such view."""
    if not table_exists(spark, table):
        return None, False
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").collect()
    text = rows[0]["data_type"] if rows else ""
    found = [word for word in text.split() if word.startswith(f"{RUNS}.") and word != MANIFEST]
    return (found[0] if found else None), PLACE in text


def _define(spark: SparkSession, entry: Entry) -> None:
    """Let a name's view read the storage of an entry, in the way its state needs."""
    if _read_by(spark, entry.table) == (entry.storage, len(entry.parts) > 1):
        return
    schema, _, name = entry.table.rpartition(".")
    if schema:
        ensure_schema(spark, schema)
    if table_exists(spark, entry.table) and spark.catalog.getTable(entry.table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {entry.table}")
    spark.sql(f"CREATE OR REPLACE VIEW {entry.table} AS {_lookup(spark, entry)}")


def _prepare_names(spark: SparkSession, entries: Iterable[Entry]) -> None:
    """Let views that are to read merged states merge; they read whole ones as well."""
    for entry in entries:
        if len(entry.parts) > 1 and _read_by(spark, entry.table) == (entry.storage, False):
            _define(spark, entry)


def settle(spark: SparkSession) -> None:
    """Define names that an interrupted publication left undefined."""
    for entry in manifest(spark):
        if not entry.age:
            _define(spark, entry)


def publish_versions(
    spark: SparkSession,
    prepared: Iterable[Entry],
    keep: int = 1,
    told: Callable[[Entry], None] | None = None,
) -> list[Entry]:
    """Let all names stand for their prepared versions, in one step; the entries no longer named.

    ``keep`` states before stay named, for readers that are still at them. A name that is
    new, or whose columns change, is defined right after; until then it is as before. Then
    ``told`` is called for each table, to announce it. If any of this fails, the manifest
    goes back, and with it all names.
    """
    fresh = {entry.table: entry for entry in prepared}
    before = manifest(spark)
    aged = [
        replace(entry, age=entry.age + 1) if entry.table in fresh else entry
        for entry in before
        if entry.table not in fresh or entry.age < keep
    ]
    _prepare_names(spark, fresh.values())
    _replace_manifest(spark, [*fresh.values(), *aged])
    try:
        for entry in fresh.values():
            _define(spark, entry)
            if told:
                told(entry)
    except Exception:
        current = {entry.table: entry for entry in before if not entry.age}
        _prepare_names(spark, current.values())
        _replace_manifest(spark, before)
        for table in fresh:
            if table in current:
                _define(spark, current[table])
            elif _read_by(spark, table)[0]:
                spark.sql(f"DROP VIEW {table}")
        raise
    return [entry for entry in before if entry.table in fresh and entry.age >= keep]


def expire_versions(spark: SparkSession, tables: Iterable[str]) -> int:
    """Remove the versions of some tables that the manifest does not name; how many went.

    What a run prepares and has not published is not named either: expire between runs.
    """
    named = manifest(spark)
    kept = {(entry.storage, part) for entry in named for part in entry.parts}
    starts = tuple(f"{_plain(table).replace('.', '__')}_" for table in tables)
    gone = 0
    for table in spark.catalog.listTables(RUNS) if spark.catalog.databaseExists(RUNS) else []:
        storage = f"{RUNS}.{table.name}"
        # The rest of the name is eight digits, so no other table's name can match.
        if table.tableType == "VIEW" or table.name[:-8] not in starts:
            continue
        for row in spark.sql(f"SHOW PARTITIONS {storage}").collect():
            version = row[0].partition("=")[2]
            if (storage, version) not in kept:
                spark.sql(f"ALTER TABLE {storage} DROP IF EXISTS PARTITION ({VERSION}={quoted(version)})")
                gone += 1
        if all(entry.storage != storage for entry in named):
            spark.sql(f"DROP TABLE IF EXISTS {storage}")
    return gone
