"""Batch lineage columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns that describe a load, not the data.
LINEAGE_COLUMNS = ("source", "version", "ingestion_timestamp")


def batch_time(at: datetime | None = None) -> Column:
    """One zone-free timestamp for a whole batch.

    A literal, because current_timestamp() would differ between the actions of a run.
    """
    moment = (at or datetime.now()).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def add_metadata(
    df: DataFrame, source: str = "unknown", version: str = "1.0", at: datetime | None = None
) -> DataFrame:
    """Stamp a batch with its source, version and load time, replacing older stamps."""
    return df.withColumns(
        {"source": F.lit(source), "version": F.lit(version), "ingestion_timestamp": batch_time(at)}
    )
