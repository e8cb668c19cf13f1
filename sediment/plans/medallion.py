"""Bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.cleaning import clean
from sediment.functions.columns import as_list, refuse_columns
from sediment.functions.hashing import HASH_COLUMN, add_row_hash
from sediment.functions.lineage import LINEAGE_COLUMNS, add_metadata
from sediment.functions.types import apply_types
from sediment.operators.compare import DELETED, NEW, NullSafeKeys, altered, compare_by_key, drop_hashes, unique_by
from sediment.operators.history import comparable_columns, live_rows
from sediment.plans.stepwise import BUCKET_ROWS, NewestRows, Step, Totals
from sediment.sinks.files import flat_columns
from sediment.sinks.tables import BATCH, batches, ensure_schema, quoted, replace_table, write_batch
from sediment.sources.tables import read_table, table_exists

# The schemas of the three layers.
BRONZE, SILVER, GOLD = "bronze_layer", "silver_layer", "gold_layer"


def newest_first(df: DataFrame) -> list[Column]:
    """Order of versions in a silver table."""
    order = [F.col("ingestion_timestamp").desc()]
    return [*order, F.col(BATCH).desc()] if BATCH in df.columns else order


# Columns that silver adds or a comparison needs; data may not bring them.
RESERVED = ("status", BATCH, HASH_COLUMN, f"{HASH_COLUMN}_current", f"{HASH_COLUMN}_new")


def first_silver(
    bronze: DataFrame,
    source: str = "unknown",
    version: str = "1.0",
    at: datetime | None = None,
    keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """First silver load: every row, status new. With ``keys``, a key that repeats is an error."""
    refuse_columns(bronze, RESERVED, "silver")
    checked = unique_by(bronze, keys, "new") if keys else bronze
    return add_metadata(checked.withColumn("status", F.lit(NEW)), source, version, at)


def silver_delta(
    silver: DataFrame,
    bronze: DataFrame,
    keys: str | Sequence[str],
    compare: Sequence[str] | None = None,
    source: str = "unknown",
    version: str = "1.0",
    at: datetime | None = None,
    delta: bool = False,
    strict: bool = False,
) -> DataFrame:
    """What a bronze snapshot adds to silver: new, changed and deleted rows.

    Each key's newest silver row is compared, keys last seen deleted being absent, so a
    key that comes back is new. Both sides hash the same columns: ``compare``, by default
    the bronze columns that are neither key nor bookkeeping. The rank that finds the newest
    rows is over the columns that the join uses, so silver is shuffled once. A bronze
    column that silver does not have is an error.
    """
    refuse_columns(bronze, RESERVED, "silver")
    unknown = [c for c in bronze.columns if c not in silver.columns]
    if unknown:
        raise ValueError(f"columns not in silver: {unknown}")
    compare = list(compare or comparable_columns(bronze, keys))
    pairs = NullSafeKeys(silver, bronze, as_list(keys))
    current = live_rows(pairs.add(silver), pairs.columns, newest_first(silver))
    comparison = compare_by_key(
        add_row_hash(current, compare, strict=strict),
        add_row_hash(bronze, compare, strict=strict),
        keys,
        ranked=pairs,
    )
    return add_metadata(drop_hashes(altered(comparison, delta)), source, version, at)


@dataclass
class Medallion:
    """The three tables of one data set."""

    spark: SparkSession
    name: str
    keys: Sequence[str]
    source: str = "unknown"
    version: str = "1.0"
    types: Mapping[str, T.DataType] = field(default_factory=dict)
    compare: Sequence[str] | None = None
    strict: bool = False
    #: Newest rows per bucket, about.
    bucket_rows: int = BUCKET_ROWS

    @property
    def bronze_table(self) -> str:
        return f"{BRONZE}.bronze_{self.name}"

    @property
    def silver_table(self) -> str:
        return f"{SILVER}.silver_{self.name}"

    @property
    def gold_table(self) -> str:
        return f"{GOLD}.gold_{self.name}"

    def load_bronze(self, data: DataFrame, at: datetime | None = None) -> None:
        """Replace bronze by the raw data, nested values as JSON text."""
        refuse_columns(data, RESERVED, "silver")
        replace_table(flat_columns(add_metadata(data, self.source, self.version, at)), self.bronze_table)

    def newest(self, compare: Sequence[str] | None = None) -> NewestRows:
        """The newest rows of silver, kept beside it."""
        return NewestRows(self.spark, self.silver_table, as_list(self.keys), compare, self.strict, self.bucket_rows)

    def _compared(self, silver: DataFrame) -> list[str]:
        """The columns that the stored hashes cover."""
        return list(self.compare or comparable_columns(silver.drop("status"), self.keys))

    def load_silver(
        self,
        batch_id: int,
        at: datetime | None = None,
        delta: bool = False,
        rules: Mapping[str, Sequence[str]] | None = None,
    ) -> dict[str, int]:
        """Add one load to silver and return the number of rows per status.

        The load is compared with the newest rows that are kept beside silver, a delta only
        with the buckets that hold its keys; silver itself is not read. A load that runs
        again compares against the loads before it and replaces its own rows. ``rules`` are
        cleaning rules, applied before the comparison.
        """
        bronze = read_table(self.spark, self.bronze_table)
        bronze = clean(bronze, rules, self.types) if rules is not None else apply_types(bronze, self.types)
        known = batches(self.spark, self.silver_table)
        earlier = [load for load in known if load < batch_id]
        if earlier:
            silver = read_table(self.spark, self.silver_table)
            newest = self.newest(self._compared(silver))
            steps = newest.at(earlier[-1])
            buckets = newest.buckets_of(bronze, steps) if delta else None
            refuse_columns(bronze, RESERVED, "silver")
            unknown = [c for c in bronze.columns if c not in silver.columns]
            if unknown:
                raise ValueError(f"columns not in silver: {unknown}")
            compare = list(self.compare or comparable_columns(bronze, self.keys))
            comparison = compare_by_key(
                newest.current(steps, compare, buckets, as_kept=True),
                bronze,
                as_list(self.keys),
                new_hash=newest.hash_of(bronze, compare),
            )
            rows = add_metadata(drop_hashes(altered(comparison, delta)), self.source, self.version, at)
        else:
            rows = first_silver(bronze, self.source, self.version, at, self.keys)
        keys = as_list(self.keys)
        columns = [*keys, *[c for c in rows.columns if c not in (*keys, *LINEAGE_COLUMNS, "status")]]
        ordered = rows.select(*columns, "status", *LINEAGE_COLUMNS)
        counts = write_batch(ordered, self.silver_table, batch_id, types=self.types, status="status")
        self._state()
        return counts

    def _state(self) -> tuple[NewestRows, list[Step]]:
        """The newest rows after all loads of silver."""
        newest = self.newest(self._compared(read_table(self.spark, self.silver_table)))
        # A load that changes nothing leaves no partition.
        return newest, newest.at(max(batches(self.spark, self.silver_table), default=0))

    def load_gold(self, at: datetime | None = None, rules: Mapping[str, object] | None = None) -> None:
        """Let gold be the latest live rows, or their aggregate.

        Gold is a view: of the newest rows kept beside silver, or of totals that are kept by
        what each load changes. Its text names the files' partitions, so readers see the
        state before this call or after it.
        """
        newest, steps = self._state()
        live = newest.live(steps).drop("status", BATCH, HASH_COLUMN)
        constants = {
            "source": self.source,
            "version": self.version,
            "ingestion_timestamp": (at or datetime.now()).replace(tzinfo=None).isoformat(sep=" "),
        }
        stamps = {name: f"CAST({quoted(value)} AS string) AS {name}" for name, value in constants.items()}
        stamps["ingestion_timestamp"] = f"CAST({quoted(constants['ingestion_timestamp'])} AS timestamp_ntz) AS ingestion_timestamp"
        totals = None
        if rules:
            totals = Totals(newest, self.gold_table, as_list(rules["group_by"]), rules["measures"])
            text = totals.select_text(totals.follow(steps), live)
            names = [f"`{name}`" for name in (*totals.group_by, *totals.measures)]
            text = f"SELECT {', '.join([*names, *stamps.values()])} FROM ({text})"
        else:
            names = [stamps.get(name, f"`{name}`") for name in live.columns]
            picked = f"{newest.where(steps)} AND NOT (status <=> {quoted(DELETED)})"
            text = f"SELECT {', '.join(names)} FROM {newest.steps.table} WHERE {picked}"
        ensure_schema(self.spark, GOLD)
        if table_exists(self.spark, self.gold_table) and self.spark.catalog.getTable(self.gold_table).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {self.gold_table}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.gold_table} AS {text}")
        newest.tidy()
        if totals:
            totals.tidy()

    def run(
        self, data: DataFrame, batch_id: int, at: datetime | None = None, delta: bool = False
    ) -> dict[str, int]:
        """Bronze, then silver, then gold."""
        self.load_bronze(data, at)
        counts = self.load_silver(batch_id, at, delta)
        self.load_gold(at)
        return counts
