"""From landed payload files to typed files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from sediment.functions.types import record_schema
from sediment.session import materialise
from sediment.sinks.files import write_csv, write_parquet
from sediment.sources.payload import field_names, parse_payload, good_records, errored_records, read_text_files


@dataclass(frozen=True)
class Extract:
    csv: str
    parquet: str
    errored: str
    field_names: tuple[str, ...]


def extract(spark: SparkSession, payload: str | list[str], fields: Mapping[str, object], target: str) -> Extract:
    """Write a collection payload as parquet, csv and a dataset of unusable input.

    The payload is parsed once, into the shared folder; all three are written from that. Columns of the
    csv follow the first record, then any declared field it lacks.
    """
    schema = record_schema(fields)
    files = read_text_files(spark, payload)
    found = field_names(files)
    names = [name for name in found if name in schema.names] + [name for name in schema.names if name not in found]
    paths = Extract(f"{target}/csv", f"{target}/parquet", f"{target}/errored", tuple(found))
    parsed = materialise(parse_payload(files, schema, "collection"), "payload")
    write_parquet(good_records(parsed), paths.parquet, schema)
    errored_records(parsed).write.json(paths.errored)
    write_csv(spark.read.parquet(paths.parquet), paths.csv, names)
    return paths
