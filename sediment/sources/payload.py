"""API payloads landed as files: one JSON array of records, or one record, per file."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.cleaning import is_blank, trimmed
from sediment.session import materialise

logger = logging.getLogger(__name__)

RECORD = "record"
CORRUPT_RECORD = "corrupt_record"
CORRUPT_FILE = "corrupt_file"
EMPTY = "empty"
_CORRUPT = "_corrupt_record"


def read_text_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole files as ``value`` with their ``file_path``."""
    text = spark.read.text(path, wholetext=True)
    return text.select("value", F.col("_metadata.file_path").alias("file_path"))


def parse_payload(files: DataFrame, schema: T.StructType, shape: str = "any") -> DataFrame:
    """One row per array element or single record: file_path, outcome, element, parsed.

    Elements are parsed one by one, so a bad one is set aside alone. Files that do not
    parse, are empty, or do not have the wanted ``shape`` (collection, item or any) give
    one row without an element. Works on batch and streaming frames alike. A file is read
    by one task: land large collections as JSON lines instead.
    """
    if shape not in ("any", "collection", "item"):
        raise ValueError(f"Unknown payload shape '{shape}'")
    text = trimmed(F.col("value"))
    is_item = text.startswith("{")
    elements = F.when(is_item, F.array(text)).otherwise(F.from_json(text, "array<string>"))
    wrong = {"any": F.lit(False), "collection": is_item, "item": text.startswith("[")}[shape]
    file_outcome = (
        F.when(is_blank(F.col("value")), EMPTY)
        .when(wrong | F.col("elements").isNull(), CORRUPT_FILE)
        .when(F.size("elements") == 0, EMPTY)
    )
    target = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json("element", target, {"columnNameOfCorruptRecord": _CORRUPT})
    bad = F.col("element").isNull() | F.col("parsed")[_CORRUPT].isNotNull()
    return (
        files.withColumn("elements", elements)
        .withColumn("outcome", file_outcome)
        .withColumn("elements", F.when(F.col("outcome").isNull(), F.col("elements")))
        .select("file_path", "outcome", "value", F.explode_outer("elements").alias("element"))
        .withColumn("parsed", parsed)
        .select(
            "file_path",
            F.coalesce("outcome", F.when(bad, CORRUPT_RECORD).otherwise(RECORD)).alias("outcome"),
            F.when(F.col("outcome") == CORRUPT_FILE, F.col("value")).otherwise(F.col("element")).alias("element"),
            "parsed",
        )
    )


def good_records(parsed: DataFrame) -> DataFrame:
    columns = [c for c in parsed.schema["parsed"].dataType.names if c != _CORRUPT]
    return parsed.where(F.col("outcome") == RECORD).select(*[F.col("parsed")[c].alias(c) for c in columns])


def errored_records(parsed: DataFrame) -> DataFrame:
    """What could not be used, with the raw text."""
    return parsed.where(F.col("outcome").isin(CORRUPT_RECORD, CORRUPT_FILE)).select("file_path", "outcome", "element")


def read_payload(
    spark: SparkSession, path: str | list[str], schema: T.StructType, shape: str = "any"
) -> tuple[DataFrame, DataFrame]:
    """The usable records and the errored rest."""
    parsed = parse_payload(read_text_files(spark, path), schema, shape)
    return good_records(parsed), errored_records(parsed)


def read_collection(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Records of a collection payload.

    A payload that is not a list is a TypeError, one without records a warning. The files
    are parsed once, into the shared folder; the checks and the records are read from there.
    """
    parsed = materialise(parse_payload(read_text_files(spark, path), schema, "collection"), "payload")
    wrong = parsed.where(F.col("outcome") == CORRUPT_FILE).select("file_path").first()
    if wrong:
        raise TypeError(f"payload should be a list of records: {wrong.file_path}")
    records = good_records(parsed)
    if records.isEmpty():
        logger.warning("payload holds no records: %s", path)
    return records


def item(df: DataFrame, item_id: object, id_column: str = "id", warn: bool = False) -> DataFrame:
    """The record with this id; the filter reaches the file scan.

    No match is no rows, and with ``warn``, which looks ahead, a warning. A frame without
    the id column is no table of records: a TypeError.
    """
    if id_column not in df.columns:
        raise TypeError(f"records have no field '{id_column}'")
    try:
        wanted = int(item_id)
    except (TypeError, ValueError):
        raise TypeError(f"{id_column} must be an integer, got {type(item_id).__name__}") from None
    found = df.where(F.col(id_column) == F.lit(wanted))
    if warn and found.isEmpty():
        logger.warning("no record with %s %s", id_column, wanted)
    return found


def field_names(files: DataFrame) -> list[str]:
    """Ordered field names of the first record of a list payload; only names reach the driver."""
    elements = F.from_json("value", "array<string>")
    row = files.select(
        elements.isNotNull().alias("is_list"),
        F.json_object_keys(F.try_element_at(elements, F.lit(1))).alias("names"),
    ).first()
    if row is None:
        return []
    if not row.is_list:
        raise TypeError("payload should be a list of records")
    return list(row.names or [])


def field_drift(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields that records have and the schema lacks, or the other way, with counts.

    Looks at every record, not only the first.
    """
    text = trimmed(F.col("value"))
    elements = F.when(text.startswith("{"), F.array(text)).otherwise(F.from_json(text, "array<string>"))
    names = files.select(F.explode(elements).alias("element")).select(
        F.explode(F.json_object_keys("element")).alias("field")
    )
    seen = names.groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    declared = files.sparkSession.createDataFrame([(name,) for name in schema.names], "field string")
    side = F.when(F.col("n").isNull(), "missing").when(F.col("declared").isNull(), "undeclared")
    return (
        declared.withColumn("declared", F.lit(True))
        .join(seen, "field", "full_outer")
        .withColumn("drift", side)
        .where(F.col("drift").isNotNull())
        .select("field", "drift", F.coalesce("n", F.lit(0)).alias("n"))
    )
