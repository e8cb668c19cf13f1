"""Large JSON arrays read by many tasks.

A file that holds one array of records cannot be cut at line ends. Its blocks are read as
text that ends at closing braces, which Spark splits, and scanned twice. The first scan
tells of each block whether it leaves a string open and how deep it nests, for either
state it may begin in: inside a string or not. A prefix over these, one row per block,
gives the state in which each block really begins. With it the second scan finds the
borders of records. A record that crosses blocks is stitched from their pieces. No text
is shuffled but that of such records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.operators.skew import input_bytes, split_bytes
from sediment.session import materialise, scratch_path
from sediment.sources.payload import CORRUPT_FILE, CORRUPT_RECORD, EMPTY, RECORD

CORRUPT = "_corrupt_record"
#: Tasks per core that small blocks are dealt to.
TASKS_PER_CORE = 4
#: White space of JSON.
BLANKS = " \t\r\n"


def _session(spark: SparkSession, block_bytes: int | None) -> SparkSession:
    """A session whose blocks have that size; the caller's stays as it is."""
    if block_bytes is None:
        return spark
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    return own


def _blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text up to each closing brace, in order within a block, with the block's place in its file."""
    text = spark.read.option("lineSep", "}").text(path)
    meta = [F.col(f"_metadata.{name}") for name in ("file_path", "file_block_start", "file_size")]
    return text.select(*meta, F.col("value").cast("binary"))


def _tasks(spark: SparkSession, blocks: DataFrame) -> int:
    """Tasks that read the blocks: some per core, or more where each would read more than the session's split."""
    rounds = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return max(rounds, -(-input_bytes(blocks) // split_bytes(spark)))


def _scans():
    """What both scans share; plain closures, so that executors need no package but numpy and pyarrow."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """File, block, file size, the further values, and bytes of runs of rows of one block."""
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns) if batch.schema.names[k] != "value"]
            keys = list(zip(*columns, strict=True))
            values = batch.column("value").to_pylist()
            start = 0
            for stop in range(1, len(keys) + 1):
                if stop == len(keys) or keys[stop][:2] != keys[start][:2]:
                    yield keys[start], b"}".join(values[start:stop]) + b"}"
                    start = stop

    def scan(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """How many quotes that are not escaped stand before each byte, and what each byte adds to the depth."""
        raw = np.frombuffer(data, np.uint8)
        place = np.arange(len(raw))
        slash = raw == ord("\\")
        # The last byte before each that is no backslash: an odd number of them since then escapes.
        other = np.maximum.accumulate(np.where(slash, -1, place))
        before = np.concatenate(([-1], other[:-1]))
        quote = (raw == ord('"')) & ((place - 1 - before) % 2 == 0)
        depth = ((raw == ord("{")) | (raw == ord("["))).astype(np.int64)
        depth -= (raw == ord("}")) | (raw == ord("]"))
        return np.cumsum(quote) - quote, depth

    return pieces, scan


def _summaries(blocks: DataFrame) -> DataFrame:
    """One row per block: bytes read, quotes, and the change in depth for a block that begins outside or inside a string."""
    pieces, scan = _scans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[int]] = {}
        for key, data in pieces(batches):
            total = found.setdefault(key, [0, 0, 0, 0])
            quotes, depth = scan(data)
            odd = (quotes + total[1]) % 2 == 1
            total[0] += len(data)
            # The last byte is a brace, not a quote.
            total[1] += int(quotes[-1])
            total[2] += int(depth[~odd].sum())
            total[3] += int(depth[odd].sum())
        rows = [(*key, *total) for key, total in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        types = [pa.string(), *[pa.int64()] * 6]
        names = ["file_path", "file_block_start", "file_size", "bytes", "quotes", "outside", "inside"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    schema = "file_path string, file_block_start long, file_size long, bytes long, quotes long, outside long, inside long"
    return blocks.mapInArrow(run, schema)


def _states(summaries: DataFrame) -> DataFrame:
    """The state in which each block begins, and how many bytes the last one has too many: its text may not end in a brace."""
    file = Window.partitionBy("file_path").orderBy("file_block_start")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    odd = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("odd")
    whole = Window.partitionBy("file_path")
    last = F.lead("file_block_start").over(file).isNull()
    extra = F.when(last, F.sum("bytes").over(whole) - F.col("file_size")).otherwise(0).alias("extra")
    told = summaries.select("file_path", "file_block_start", odd, extra, "outside", "inside")
    change = F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside"))
    depth = F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth")
    return told.select("file_path", "file_block_start", "odd", depth, "extra")


# What a row of the second scan is: a whole record, or the text of a block up to its first
# border, after its last one, or all of it if there is none.
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3


def _records(blocks: DataFrame, states: DataFrame) -> DataFrame:
    """``kind`` and ``text`` of what lies between the borders of records."""
    # One small row per block, which has as many bytes as a task reads.
    stated = blocks.join(F.broadcast(states), ["file_path", "file_block_start"])
    stated = stated.select("file_path", "file_block_start", "odd", "depth", "extra", "value")
    pieces, scan = _scans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(key: tuple, kinds: list[int], texts: list[bytes]) -> pa.RecordBatch:
            n = len(kinds)
            columns = [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64())]
            columns += [pa.array(kinds, pa.int64()), pa.array(texts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["file_path", "file_block_start", "kind", "text"])

        def closed() -> pa.RecordBatch:
            text = b"".join(held)
            return rows(key, [TAIL if bordered else MIDDLE], [text[: len(text) - key[4]]])

        key, held, bordered, odd, depth = None, [], False, 0, 0
        for now, data in pieces(batches):
            if key is None or now[:2] != key[:2]:
                if key is not None:
                    yield closed()
                key, held, bordered, odd, depth = now, [], False, now[2], now[3]
            quotes, change = scan(data)
            outside = (quotes + odd) % 2 == 0
            level = depth + np.cumsum(np.where(outside, change, 0))
            # A record ends with the brace that leads back into the array.
            ends = np.flatnonzero(outside & (change < 0) & (level == 1) & (np.frombuffer(data, np.uint8) == ord("}")))
            odd, depth = (odd + int(quotes[-1])) % 2, int(level[-1])
            start, kinds, texts = 0, [], []
            for end in ends.tolist():
                kinds.append(WHOLE if bordered else HEAD)
                texts.append(b"".join([*held, data[start : end + 1]]))
                start, held, bordered = end + 1, [], True
            held.append(data[start:])
            if kinds:
                yield rows(key, kinds, texts)
        if key is not None:
            yield closed()

    found = stated.mapInArrow(run, "file_path string, file_block_start long, kind long, text binary")
    return found.withColumn("text", F.col("text").cast("string"))


def parse_arrays(
    spark: SparkSession, path: str | list[str], schema: T.StructType, block_bytes: int | None = None
) -> DataFrame:
    """One row per record of files that each hold one JSON array of records, as ``parse_payload`` gives them.

    The blocks are read twice, each time by as many tasks as there are blocks, or by fewer
    that read several in a row if there are very many. What the scan finds is written to the
    shared folder. A record that does not fit is set aside alone. A file that is no
    array, or does not end as one, gives one row without an element and no record; an empty
    array or a blank file one that says so. What stands between two records and is none is
    set aside with the record after it. ``block_bytes`` is the size of blocks, by default
    what the session reads per task.
    """
    blocks = _blocks(_session(spark, block_bytes), path)
    blocks = blocks.coalesce(_tasks(spark, blocks)) if block_bytes else blocks
    states = materialise(_states(_summaries(blocks)), "block-states")
    records, place = _records(blocks, states), scratch_path(spark, "array-records")
    records.write.parquet(place)
    found = spark.read.schema(records.schema).parquet(place)  # in the caller's session again
    pieces = found.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file_path").orderBy("file_block_start", "kind")
    group = F.count(F.when(F.col("kind") == TAIL, 1)).over(order).alias("nth")
    stitched = (
        pieces.select("file_path", "file_block_start", "kind", "text", group)
        .groupBy("file_path", "nth")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("file_block_start", "kind", "text"))), lambda piece: piece["text"]
                ),
                "",
            ).alias("text"),
            F.bool_or(F.col("kind") == HEAD).alias("is_record"),
        )
    )
    stitched = materialise(stitched, "array-pieces")
    rest = F.trim(F.col("text"), F.lit(BLANKS))
    first = F.col("nth") == 0
    hollow = F.regexp_like(rest, F.lit(r"^\[[ \t\r\n]*\]$"))
    # The last piece of a file, after its last record.
    ending = stitched.where(~F.col("is_record")).select(
        "file_path",
        F.when(first & ((rest == "") | hollow), EMPTY).when(first | (rest != "]"), CORRUPT_FILE).alias("outcome"),
    )
    opening = stitched.where(first & F.col("is_record") & ~rest.startswith("[")).select(
        "file_path", F.lit(CORRUPT_FILE).alias("outcome")
    )
    files = ending.where(F.col("outcome").isNotNull()).unionByName(opening).groupBy("file_path").agg(F.max("outcome").alias("outcome"))
    whole = found.where(F.col("kind") == WHOLE).select("file_path", F.lit(False).alias("first"), "text")
    crossing = stitched.where("is_record").select("file_path", first.alias("first"), "text")
    texts = whole.unionByName(crossing).join(files, "file_path", "left_anti")
    mark = F.when(F.col("first"), F.lit(r"\[")).otherwise(F.lit(","))
    border = F.concat(F.lit(r"^[ \t\r\n]*"), mark, F.lit(r"[ \t\r\n]*\{"))
    # Beyond its mark a record begins at its first brace.
    element = F.when(F.regexp_like("text", border), F.substr("text", F.instr("text", "{"))).otherwise(F.col("text"))
    target = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    records = texts.select("file_path", element.alias("element"))
    parsed = F.from_json("element", target, {"columnNameOfCorruptRecord": CORRUPT})
    records = records.withColumn("parsed", parsed)
    bad = F.col("parsed").isNull() | F.col("parsed")[CORRUPT].isNotNull()
    told = records.select("file_path", F.when(bad, CORRUPT_RECORD).otherwise(RECORD).alias("outcome"), "element", "parsed")
    return told.unionByName(files, allowMissingColumns=True)
