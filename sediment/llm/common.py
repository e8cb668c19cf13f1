"""What several operators share: row keys, text as bytes, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.session import materialise

#: White space that ends a word: blank and the five ASCII controls from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of text that a task turns into Python objects at a time.
PART_BYTES = 4 << 20
#: Bytes of rows that Spark hands to Python at a time, where the session has Spark's default.
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"

_shipped: set[str] = set()


def tidy() -> None:
    """Give memory that a task no longer needs back to the system.

    Spark keeps a task's Python process for later tasks; what it holds idle counts against
    the executor.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library may not offer it
        ctypes.CDLL(None).malloc_trim(0)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, and rows in small batches.

    A batch size that the session sets itself is left alone. Nothing to send where the
    package itself came in an archive.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context, package = spark.sparkContext, Path(__file__).parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="sediment-")) / "sediment.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def slim(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names, whatever else the frame has."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def text_hash(text: Column) -> Column:
    """64 bits that tell texts of one id apart; null and empty differ."""
    return F.xxhash64(text.isNull(), text)


def packed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc``, a whole row, with its ``doc_id`` and ``doc_hash``: no column name of the row can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(
        whole.alias("doc"),
        F.col(f"`{id_column}`").alias("doc_id"),
        text_hash(F.col(f"`{text_column}`")).alias("doc_hash"),
    )


def attach(docs: DataFrame, decisions: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc``, the documents that ``decisions`` names, with its further columns.

    ``decisions`` has one row per ``_id``, ``_hash`` and the count ``_n`` of documents that
    share both; such repeated rows come out once.
    """
    rows = packed(docs, id_column, text_column)
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_hash") == F.col("_hash"))

    def join(part: DataFrame) -> DataFrame:
        return rows.join(part.drop("_n"), on).drop("doc_id", "doc_hash")

    if decisions.where("_n > 1").isEmpty():
        return join(decisions).drop("_id", "_hash")
    repeated = join(decisions.where("_n > 1"))
    rest = [c for c in repeated.columns if c not in ("_id", "_hash")]
    once = repeated.groupBy("_id", "_hash").agg(*[F.first(c).alias(c) for c in rest])
    return join(decisions.where("_n = 1")).unionByName(once).drop("_id", "_hash")


def parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose text or bytes are at most ``limit`` together, or one row."""
    if len(column):
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit, prepend=-1))
        yield from zip(starts.tolist(), [*starts[1:].tolist(), len(column)], strict=True)


def small_batches(
    batches: Iterator[pa.RecordBatch], column: int, limit: int = PART_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """The same rows in small batches, with the values of a binary column.

    Spark bounds the bytes of a batch; Python's objects take a multiple of that, so only a
    part of a batch is turned into them at a time.
    """
    for batch in batches:
        for start, stop in parts(batch.column(column), limit):
            part = batch.slice(start, stop - start)
            yield part, part.column(column).to_pylist()
    tidy()


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node reachable, for every node of a link.

    ``links`` has long columns ``a`` and ``b``. Large-star and small-star steps alternate
    until nothing changes: a logarithmic number of rounds whatever the shape. The smallest
    neighbour of a node is found by an aggregate that combines before the shuffle, so that
    a hub costs one row per task; each round is written to the shared folder. Joins are merge
    joins at every size, since links take far less room in a file than in memory.
    """

    def stars(edges: DataFrame, keep: Column) -> DataFrame:
        low = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return edges.join(low.hint("merge"), "a").where(keep)

    now = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        before = state
        both = now.union(now.select("b", "a"))
        large = stars(both, F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = stars(large, F.lit(True))
        small = down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "links")
