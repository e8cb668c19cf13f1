"""Micro-batches over files as they arrive in the staged tree."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sediment.session import materialise
from sediment.sources.files import (
    CORRUPT,
    LOADED,
    STAGED,
    as_schema,
    by_lines,
    format_options,
    misplaced_files,
    read_files,
    staged_loads,
    with_staged_path,
)
from sediment.sources.payload import errored_records, good_records, parse_payload


def _staged_reader(
    spark: SparkSession, root: str, source: str, archive: bool, max_files: int | None
):
    base = f"{root.rstrip('/')}/{source}"
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        # A file moves once a later batch has finished, so the newest ones stay a while.
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", f"{base}/{LOADED}")
    return reader, f"{base}/{STAGED}"


def read_arrivals(
    spark: SparkSession,
    root: str,
    source: str,
    file_type: str,
    schema: T.StructType | str,
    archive: bool = False,
    max_files: int | None = None,
    lines: bool | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A stream of the records in staged files, each file once per checkpoint.

    A record that does not fit the schema stops the stream, as does a csv header with other
    names or another order. With ``keep_corrupt`` its text comes in a column for
    ``split_records`` to set aside.
    """
    reader, path = _staged_reader(spark, root, source, archive, max_files)
    wanted = as_schema(schema)
    options = format_options(file_type, by_lines(file_type, lines))
    if file_type != "parquet":
        options |= {"enforceSchema": False}
        if keep_corrupt:
            wanted = T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())])
            options |= {"columnNameOfCorruptRecord": CORRUPT}
        else:
            options |= {"mode": "FAILFAST"}
    return with_staged_path(reader.schema(wanted).options(**options).format(file_type).load(path))


def read_payload_arrivals(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType,
    archive: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of parsed payload files: one row per element, bad ones marked."""
    reader, path = _staged_reader(spark, root, source, archive, max_files)
    text = reader.option("wholetext", True).text(path)
    return parse_payload(text.select("value", F.col("_metadata.file_path").alias("file_path")), schema)


def on_arrival(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    catch_up: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Run ``handle(rows, batch_id)`` for each batch of arrivals.

    With ``catch_up`` the query takes what is there and stops, for scheduled runs; without
    it, it keeps watching. An error in ``handle`` stops the query before the batch counts
    as done, so the same files come again with the same batch id: ``handle`` must
    overwrite what an earlier attempt of that batch wrote.
    """
    writer: DataStreamWriter = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if catch_up else writer.trigger(processingTime=interval)).start()


def replace_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that stores each batch as its own partition, replacing earlier attempts."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return handle


def split_records(
    good: Callable[[DataFrame, int], None], errored: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A handler for ``read_arrivals`` with ``keep_corrupt``: records to one handler, the rest to another.

    The batch is parsed once, into the shared folder.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        parsed = materialise(rows, "arrivals")
        bad = F.col(CORRUPT).isNotNull()
        kept = [c for c in parsed.columns if c.startswith("staged_")]
        errored(parsed.where(bad).select(*kept, F.col(CORRUPT).alias("record")), batch_id)
        good(parsed.where(~bad).drop(CORRUPT), batch_id)

    return handle


def load_id(at: datetime) -> int:
    """A landed load's time as an increasing number."""
    return int(at.strftime("%Y%m%d%H%M%S"))


def per_load(
    root: str,
    source: str,
    file_type: str,
    schema: T.StructType | str,
    handle: Callable[[DataFrame, int, datetime], None],
    lines: bool | None = None,
) -> Callable[[DataFrame, int], None]:
    """A handler that runs ``handle(rows, load, time)`` once per landed load, oldest first.

    A micro-batch only tells which loads arrived; each is then read whole from its folder,
    however many of its files the batch holds. A load whose later files come in another
    batch runs again, and so do the loads after it, which were compared with less. So
    ``handle`` must replace what an earlier run of that load wrote. Files must stay in the
    staged tree, and one that belongs to no load is an error: ``Ledger`` sets such files
    aside, and moves the others once they are handled.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if strays := misplaced_files(spark, root, source, file_type).take(3):
            raise ValueError(f"files that belong to no load of '{source}': {[row.file for row in strays]}")
        first = rows.agg(F.min("staged_at")).first()[0]
        if first is None:
            return
        known = staged_loads(spark, root, source, file_type).where(F.col("staged_at") >= F.lit(first))
        for load in known.orderBy("staged_at").collect():  # one row per load from there on
            records = read_files(spark, load.path, file_type, schema, by_lines(file_type, lines))
            handle(records, load_id(load.staged_at), load.staged_at)

    return run


def split_payload(
    good: Callable[[DataFrame, int], None], errored: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A handler for parsed payloads: records to one handler, unusable input to another."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        parsed = materialise(rows, "payloads")  # parsed once for both
        errored(errored_records(parsed), batch_id)
        good(good_records(parsed), batch_id)

    return handle
