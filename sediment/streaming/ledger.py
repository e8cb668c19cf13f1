"""A ledger of the files that arrived, which decides what is run, and where files go.

The ledger is a table of files: the load each belongs to, its size, what became of it and
why. A micro-batch only tells that something arrived. What to do follows from the listing
of the staged tree and the ledger: a load that is new, or has more files than when it was
handled, runs, and so do the loads after it, which were compared with less. Files that
belong to no load are set aside and counted, as are loads whose records do not fit, if
wanted. Handled files may move to the folder of loaded files; a load is then read from
wherever its files are. An empty file brings no record and is not listed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.lineage import batch_time
from sediment.session import materialise
from sediment.sinks.tables import BATCH, batches, write_batch
from sediment.sources.files import ERRORED, LOADED, STAGED, by_lines, read_files, read_records, staged_files
from sediment.sources.storage import move_files
from sediment.sources.tables import read_table, table_exists
from sediment.streaming.arrivals import load_id

# The schema of ledgers, and what may become of a file.
ARRIVALS = "arrivals"
HANDLED, ASIDE = "loaded", "errored"
#: Files that belong to no load are noted under this number.
NO_LOAD = 0

#: What tells a file, and the columns of a ledger.
FILE = ["file", "length", "modified"]
NOTED = (
    "file string, length long, modified timestamp, staged_at timestamp_ntz, place string, "
    "outcome string, reason string, noted_at timestamp_ntz"
)

Handle = Callable[[DataFrame, int, datetime], None]
Errored = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Ledger:
    """The arrivals of one source, and what is done with them."""

    root: str
    source: str
    file_type: str
    schema: T.StructType | str
    #: Name of the ledger's table; the source's if empty.
    name: str = ""
    lines: bool | None = None
    #: Move files once handled or set aside, out of the staged tree.
    move: bool = False
    #: Set loads aside whose records do not fit the schema, and go on; otherwise that is an error.
    keep_going: bool = False

    @property
    def table(self) -> str:
        return f"{ARRIVALS}.{self.name or self.source}"

    def files(self, spark: SparkSession) -> DataFrame:
        """The ledger: where a ``file`` was found and the ``place`` where it is, the load's time, ``outcome`` and ``reason``."""
        return read_table(spark, self.table)

    def _noted(self, spark: SparkSession) -> DataFrame:
        """The ledger, without rows where nothing was noted yet."""
        if table_exists(spark, self.table):
            return self.files(spark)
        return spark.createDataFrame([], f"{NOTED}, {BATCH} long")

    def _listed(self, spark: SparkSession) -> DataFrame:
        """The files of the staged tree that are not in the ledger. One written anew under its name is another file."""
        found = staged_files(spark, self.root, self.source, self.file_type)
        known = self._noted(spark).select(*FILE)
        return found.join(known, FILE, "left_anti").select(*FILE, "staged_at", F.col("file").alias("place"))

    def due(self, spark: SparkSession) -> DataFrame:
        """The loads to run, ``staged_at``: those with files that are not in the ledger, and all after the first of them."""
        fresh = self._listed(spark).where(F.col("staged_at").isNotNull()).select("staged_at").distinct()
        known = self._noted(spark).where((F.col("outcome") == HANDLED) & F.col("staged_at").isNotNull())
        first = fresh.agg(F.min("staged_at").alias("first"))  # one row
        loads = fresh.union(known.select("staged_at")).distinct()
        return loads.join(F.broadcast(first), F.col("staged_at") >= F.col("first")).select("staged_at")

    def _note(self, spark: SparkSession, load: int, files: DataFrame, outcome: str, reason: str | None = None) -> None:
        """Note what became of a load's files, in place of what was noted of the load before, and move them."""
        state = {HANDLED: LOADED, ASIDE: ERRORED}[outcome]
        staged = f"/{STAGED}/"
        target = F.concat(F.substring_index("file", staged, 1), F.lit(f"/{state}/"), F.substring_index("file", staged, -1))
        noted = files.select(
            *FILE,
            "staged_at",
            (F.when(F.col("place") == F.col("file"), target).otherwise(F.col("place")) if self.move else F.col("place")).alias("place"),
            F.lit(outcome).alias("outcome"),
            F.lit(reason).cast("string").alias("reason"),
            batch_time(datetime.now()).alias("noted_at"),
        )
        write_batch(materialise(noted, "ledger"), self.table, load)
        if self.move:
            self._move(spark)

    def _move(self, spark: SparkSession) -> None:
        """Move the files that the ledger has elsewhere and that are still in the staged tree."""
        listed = staged_files(spark, self.root, self.source, self.file_type).select(*FILE)
        left = self._noted(spark).where("file <> place").join(listed, FILE, "left_semi").select("file", "place")
        move_files(spark, [(row.file, row.place) for row in left.toLocalIterator()])

    def _set_strays_aside(self, spark: SparkSession, errored: Errored | None) -> None:
        fresh = materialise(self._listed(spark).where(F.col("staged_at").isNull()), "strays")
        if fresh.isEmpty():
            return
        known = self._noted(spark).where(F.col(BATCH) == NO_LOAD).select(*fresh.columns)
        # All strays so far, but those that came anew; what an attempt brings replaces what one before it brought.
        strays = materialise(fresh.unionByName(known.join(fresh.select("file"), "file", "left_anti")), "strays")
        if errored:
            errored(self._text(spark, [row.place for row in strays.toLocalIterator()]), NO_LOAD)
        self._note(spark, NO_LOAD, strays, ASIDE, "the file's place or name tells no load")

    def _text(self, spark: SparkSession, places: list[str]) -> DataFrame:
        """``file`` and ``record``: lines of text, or whole files where records span lines; Parquet files have no text."""
        if self.file_type == "parquet":
            return spark.createDataFrame([(place, None) for place in places], "file string, record string")
        whole = not by_lines(self.file_type, self.lines)
        rows = spark.read.option("wholetext", whole).text(places)
        return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))

    def _run_load(self, spark: SparkSession, staged_at: datetime, handle: Handle, errored: Errored | None) -> None:
        number = load_id(staged_at)
        fresh = self._listed(spark).where(F.col("staged_at") == F.lit(staged_at))
        known = self._noted(spark).where((F.col(BATCH) == number) & (F.col("outcome") == HANDLED)).select(*fresh.columns)
        files = materialise(fresh.unionByName(known.join(fresh.select("file"), "file", "left_anti")), "load-files")
        places = [row.place for row in files.select("place").toLocalIterator()]
        lines = by_lines(self.file_type, self.lines)
        reason = None
        if self.keep_going:
            try:
                records, others = read_records(spark, places, self.file_type, self.schema, lines)
                if n := others.count():
                    reason = f"{n} records do not fit the schema"
            except ValueError as error:
                reason = str(error)
        else:
            records = read_files(spark, places, self.file_type, self.schema, lines)
        if reason:
            if errored:
                errored(self._text(spark, places), number)
            self._note(spark, number, files, ASIDE, reason)
            return
        handle(records, number, staged_at)
        self._note(spark, number, files, HANDLED)

    def run(self, spark: SparkSession, handle: Handle, errored: Errored | None = None) -> None:
        """Set strays aside, then run ``handle(rows, load, time)`` for the loads that are due, oldest first.

        ``errored(rows, load)`` gets ``file`` and ``record`` of what is set aside, under the
        load's number or NO_LOAD; each call replaces what an earlier one brought under that
        number, as ``handle`` must for a load. A load is noted once it is handled, so one
        that was under way when the run stopped runs again.
        """
        if self.move:
            self._move(spark)  # what an interrupted run noted and did not move
        self._set_strays_aside(spark, errored)
        for load in self.due(spark).orderBy("staged_at").collect():  # one row per load from there on
            self._run_load(spark, load.staged_at, handle, errored)

    def handler(self, handle: Handle, errored: Errored | None = None) -> Callable[[DataFrame, int], None]:
        """The same as a handler for ``on_arrival``, whose batches only tell that something arrived."""

        def on_batch(rows: DataFrame, batch_id: int) -> None:
            self.run(rows.sparkSession, handle, errored)

        return on_batch

    def loads(self, spark: SparkSession) -> list[int]:
        """Numbers of the loads noted, oldest first."""
        return [number for number in batches(spark, self.table) if number != NO_LOAD]
