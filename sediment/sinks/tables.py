"""Table writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import product
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.types import apply_types, table_ddl
from sediment.sources.tables import jdbc_options, qualified, table_exists

# What to do about a table that exists, with Spark's name for it.
IF_EXISTS = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
BATCH = "batch_id"


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")


def align(df: DataFrame, table: str) -> DataFrame:
    """Columns in the table's order and type: absent ones null, unknown ones an error."""
    target = df.sparkSession.table(table).schema
    unknown = [name for name in df.columns if name not in target.names]
    if unknown:
        raise ValueError(f"columns not in table {table}: {unknown}")
    return df.select(
        [
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


@dataclass(frozen=True)
class Prepared:
    """Rows written under a name of their own, to become ``table``."""

    table: str
    loading: str
    location: str


def prepare_table(df: DataFrame, table: str, types: Mapping[str, T.DataType] | None = None) -> Prepared:
    """Write the rows of a full refresh to a new location; ``table`` stays as it is."""
    spark = df.sparkSession
    schema, name = table.split(".") if "." in table else (spark.catalog.currentDatabase(), table)
    ensure_schema(spark, schema)
    version = uuid.uuid4().hex
    location = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}-{version}"
    loading = f"`{schema}`.`{name}_{version}`"
    spark.sql(f"CREATE TABLE {loading} ({table_ddl(df, types or {})}) USING parquet LOCATION '{location}'")
    try:
        df.write.insertInto(loading)
    except Exception:
        spark.sql(f"DROP TABLE {loading}")
        raise
    return Prepared(f"`{schema}`.`{name}`", loading, location)


def publish_table(spark: SparkSession, prepared: Prepared) -> None:
    """Let the table's name stand for the prepared rows.

    A table of the same columns is pointed to the new location, in one step that readers
    see before or after. One whose columns change is dropped and its name given on.
    """
    name = prepared.table.replace("`", "")
    if table_exists(spark, name) and spark.table(name).schema == spark.table(prepared.loading).schema:
        spark.sql(f"ALTER TABLE {prepared.table} SET LOCATION '{prepared.location}'")
        spark.catalog.refreshTable(name)
        spark.sql(f"DROP TABLE {prepared.loading}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {prepared.table}")
        spark.sql(f"ALTER TABLE {prepared.loading} RENAME TO {prepared.table}")


def discard_table(spark: SparkSession, prepared: Prepared) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {prepared.loading}")


def replace_table(df: DataFrame, table: str, types: Mapping[str, T.DataType] | None = None) -> None:
    """Full refresh. The rows go to a new location first and the name moves to it after.

    So a table may be rebuilt from itself, readers keep the files they started on, and a
    failed load leaves the old table. The replaced files stay until storage expires them.
    """
    publish_table(df.sparkSession, prepare_table(df, table, types))


def load_table(
    df: DataFrame,
    table: str,
    if_exists: str = "replace",
    schema: str | None = None,
    types: Mapping[str, T.DataType] | None = None,
) -> None:
    """Write a frame to a catalog table under declared column types."""
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {', '.join(IF_EXISTS)}")
    name = qualified(table, schema)
    exists = table_exists(df.sparkSession, name)
    if exists and if_exists == "fail":
        raise ValueError(f"Table '{name}' already exists")
    typed = apply_types(df, types) if types else df
    if exists and if_exists == "append":
        align(typed, name).write.insertInto(name)
    else:
        replace_table(typed, name, types)


@contextmanager
def own_partitions_only(spark: SparkSession) -> Iterator[None]:
    """Overwriting inserts replace only the partitions they write.

    An insert into a table takes this from the session, not from the writer. The handlers
    of a stream have a session of their own; batch jobs that load tables side by side in
    one session should take one each.
    """
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def write_batch(
    df: DataFrame,
    table: str,
    batch_id: int,
    partitions: Sequence[str] = (),
    types: Mapping[str, T.DataType] | None = None,
    status: str | None = None,
) -> dict[str, int]:
    """Write the rows of one load as partitions of their own, counting them on the way.

    A load that runs again overwrites its own partitions and no others, so a retry never
    doubles rows; partitions of its first attempt that it does not fill again go, down to
    all of them if it brings no row. With ``status`` the counts are per value of that
    column.
    """
    spark = df.sparkSession
    typed = apply_types(df, types) if types else df
    typed = typed.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    layout = [BATCH, *partitions]
    if not table_exists(spark, table):
        if "." in table:
            ensure_schema(spark, table.split(".")[0])
        ordered = typed.select(*[c for c in typed.columns if c not in layout], *layout)
        spark.sql(
            f"CREATE TABLE {table} ({table_ddl(ordered, types or {})}) USING parquet PARTITIONED BY ({', '.join(layout)})"
        )
    aligned = align(typed, table)
    counter = Observation()
    if status is None:
        measures = [F.count(F.lit(1)).alias("rows")]
    else:
        words = ("new", "changed", "deleted", "unchanged")
        measures = [F.count(F.when(F.col(status) == word, 1)).alias(word) for word in words]
    # Where there are few possible partitions each is counted; a set costs more per row.
    few = all(isinstance(aligned.schema[c].dataType, T.BooleanType) for c in partitions) and len(partitions) <= 2
    places = list(product((True, False, None), repeat=len(partitions))) if few else []
    if few:
        for i, values in enumerate(places):
            here = [F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in zip(partitions, values, strict=True)]
            measures.append(F.count(F.when(reduce(lambda a, b: a & b, here, F.lit(True)), 1)).alias(f"_place{i}"))
    else:
        # One entry per partition written; an empty text is stored as null.
        place = F.struct(*[F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"p{i}") for i, c in enumerate(layout)])
        measures.append(F.to_json(F.collect_set(place), {"ignoreNullFields": "false"}).alias("_written"))
    counted = aligned.observe(counter, *measures)
    before = _partitions(spark, table, batch_id)
    with own_partitions_only(spark):
        counted.write.mode("overwrite").insertInto(table)
    found = dict(counter.get)
    if few:
        filled = [values for i, values in enumerate(places) if found.pop(f"_place{i}")]
        written = {(str(batch_id), *[None if v is None else str(v).lower() for v in values]) for values in filled}
    else:
        written = {tuple(entry.values()) for entry in json.loads(found.pop("_written") or "[]")}
    for values in before - written:
        names = [f"`{c}`='{_quoted(NO_VALUE if v is None else v)}'" for c, v in zip(layout, values, strict=True)]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({', '.join(names)})")
    return found


# Fixed value: the folder name that stands for null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def quoted(text: str) -> str:
    """A text as a literal."""
    return f"'{_quoted(text)}'"


def _partitions(spark: SparkSession, table: str, batch_id: int) -> set[tuple[str | None, ...]]:
    """The values of a batch's partitions, which their folder names hold escaped."""
    rows = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({BATCH}={batch_id})").collect()
    texts = [[unquote(part.partition("=")[2]) for part in row[0].split("/")] for row in rows]
    return {tuple(None if v == NO_VALUE else v for v in values) for values in texts}


def batches(spark: SparkSession, table: str) -> list[int]:
    """Loads a table holds, oldest first; reads the partition list, not the data."""
    if not table_exists(spark, table):
        return []
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted({int(part.split("=")[1]) for row in rows for part in row[0].split("/") if part.startswith(f"{BATCH}=")})


def write_database(
    df: DataFrame,
    table: str,
    url: str,
    if_exists: str = "replace",
    schema: str | None = None,
    types: Mapping[str, T.DataType] | None = None,
    properties: Mapping[str, object] | None = None,
    connections: int = 8,
) -> None:
    """Write a frame to a database table over at most ``connections`` connections."""
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {', '.join(IF_EXISTS)}")
    typed = apply_types(df, types) if types else df
    lengths = [f"{name} VARCHAR({t.length})" for name, t in (types or {}).items() if isinstance(t, T.VarcharType)]
    writer = (
        typed.write.format("jdbc")
        .options(**jdbc_options(url, properties))
        .option("dbtable", qualified(table, schema))
        .option("numPartitions", connections)
        .mode(IF_EXISTS[if_exists])
    )
    if lengths and if_exists != "append":
        writer = writer.option("createTableColumnTypes", ", ".join(lengths))
    writer.save()
