"""The control table: one row per source, saying how to load it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

# The column names of the control table and their allowed values.
CONTROL_COLUMNS = {
    "Source_Type": "source_type",
    "Source_Name": "source_name",
    "Connection": "connection",
    "Primary Key": "primary_key",
    "Compare Columns": "compare_columns",
    "Load Type": "load_type",
    "SCD Type": "scd_type",
}
LOAD_TYPES = ("Full", "Delta")
SCD_TYPES = (1, 2)
SOURCE_TYPES = ("csv", "json", "parquet", "table", "database")

CONTROL_SCHEMA = (
    "source_type string, source_name string, connection string, primary_key array<string>, "
    "compare_columns array<string>, load_type string, scd_type int"
)


@dataclass(frozen=True)
class Source:
    source_type: str
    source_name: str
    connection: str
    primary_key: tuple[str, ...]
    compare_columns: tuple[str, ...] = ()
    load_type: str = "Full"
    scd_type: int = 2

    @property
    def delta(self) -> bool:
        return self.load_type == "Delta"


def _names(value: object) -> tuple[str, ...]:
    if not value:
        return ()
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(part.strip() for part in parts)


def source(definition: Mapping[str, object]) -> Source:
    """A checked control row; keys may be written either way the table names them."""
    row = {CONTROL_COLUMNS.get(key, key): value for key, value in definition.items()}
    unknown = set(row) - set(CONTROL_COLUMNS.values())
    if unknown:
        raise ValueError(f"Unknown control columns: {sorted(unknown)}")
    result = Source(
        source_type=str(row.get("source_type", "")).lower(),
        source_name=str(row.get("source_name", "")),
        connection=str(row.get("connection", "")),
        primary_key=_names(row.get("primary_key")),
        compare_columns=_names(row.get("compare_columns")),
        load_type=str(row.get("load_type", "Full")).capitalize(),
        scd_type=int(str(row.get("scd_type", 2)).lower().removeprefix("type").strip()),
    )
    for name, value, allowed in (
        ("Source_Type", result.source_type, SOURCE_TYPES),
        ("Load Type", result.load_type, LOAD_TYPES),
        ("SCD Type", result.scd_type, SCD_TYPES),
    ):
        if value not in allowed:
            raise ValueError(f"{name} '{value}' of source '{result.source_name}' is not one of {allowed}")
    if not result.source_name or not result.primary_key:
        raise ValueError("a source needs a name and a primary key")
    return result


def control_frame(spark: SparkSession, definitions: Iterable[Mapping[str, object]]) -> DataFrame:
    """The control table as a frame, every row checked."""
    rows = [source(definition) for definition in definitions]
    names = [row.source_name for row in rows]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"source named twice: {repeated}")
    values = [{k: list(v) if isinstance(v, tuple) else v for k, v in asdict(row).items()} for row in rows]
    return spark.createDataFrame(values, CONTROL_SCHEMA)


def load_plan(control: DataFrame) -> list[Source]:
    """The control rows on the driver. Control data only: one row per source."""
    return [source(row.asDict()) for row in control.orderBy("source_name").collect()]
