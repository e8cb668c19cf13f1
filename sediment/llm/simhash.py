"""Near duplicates by SimHash.

Every document gets a 64-bit fingerprint of its word shingles. Fingerprints that differ in
few bits are found without comparing all of them: a fingerprint becomes the vector of bit
counts of its segments. One changed bit moves one count by one, so the Manhattan distance
of two vectors never exceeds the number of differing bits. Vectors within that distance
have a common grid cell half way between them; each fingerprint is entered in the cells
around it, cells are joined, and the pairs found are verified on the fingerprints.

Cells that hold many fingerprints are not paired. Their members are entered anew in the
finest grid, with segments of one bit. There two members of a cell differ in few enough
bits by construction, and linking each to the smallest of its cell is exact and linear.

Cells are merge joined at every size: Spark takes an exploded frame for no larger than what it
was made from, and would broadcast tens of cells for each fingerprint of a small table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import attach, components, ship, slim, small_batches, text_hash
from sediment.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42  # of XXH64; fixed
#: Bits per segment of the first grid: 16 counts from 0 to 4.
SEGMENT_BITS = 4
#: Cells with more fingerprints than this go to the finest grid.
CROWDED = 32

_digest = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; no words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - words_per_shingle + 1)
    shingles = map(b" ".join, zip(*(words[i : i + count] for i in range(min(words_per_shingle, len(words)))), strict=False))
    hashes = np.fromiter(map(_digest, shingles), dtype=">u8", count=count).view(np.uint8).reshape(count, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """Columns ``_id``, ``_hash`` (of the text, see ``text_hash``) and ``fp``, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 2):
            fps = [fingerprint(t, words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["_id", "_hash", "fp"]
            )

    ship(docs.sparkSession)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _hash long, fp long")


def counts(fp: Column, segment_bits: int) -> list[Column]:
    """Set bits of each segment."""
    mask = F.lit((1 << segment_bits) - 1).cast("long")
    return [F.bit_count(F.shiftrightunsigned(fp, at).bitwiseAND(mask)) for at in range(0, 64, segment_bits)]


def grid(fps: DataFrame, steps: int, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """Columns ``fp`` and ``cell``: all cells that are at most ``steps`` from a fingerprint.

    A cell is a vector of segment counts packed into a long. With segments of one bit the
    vector is the fingerprint itself.
    """
    if segment_bits == 1:
        cells = fps.select("fp", F.col("fp").alias("cell"))
    else:
        packed = None
        for at, n in enumerate(counts(F.col("fp"), segment_bits)):
            part = F.shiftleft(n.cast("long"), at * segment_bits)
            packed = part if packed is None else packed.bitwiseOR(part)
        cells = fps.select("fp", packed.alias("cell"))
    for step in range(steps):
        around = [F.col("cell")]
        if segment_bits == 1:
            around += [F.col("cell").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), at)) for at in range(64)]
        else:
            for at in range(0, 64, segment_bits):
                one = F.lit(1 << at).cast("long")
                n = F.shiftrightunsigned("cell", at).bitwiseAND(F.lit((1 << segment_bits) - 1).cast("long"))
                around += [F.when(n < segment_bits, F.col("cell") + one), F.when(n > 0, F.col("cell") - one)]
        cells = cells.select("fp", F.explode(F.array_compact(F.array(*around))).alias("cell"))
        if step:
            cells = cells.distinct()
    return cells


def near_pairs(
    fps: DataFrame, max_bits: int = MAX_BITS, segment_bits: int = SEGMENT_BITS, crowded: int = CROWDED
) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly what pairs of at most ``max_bits`` differing bits connect.

    ``fps`` has distinct ``fp``. Every link is such a pair or, between members of a crowded
    cell, one of a star of such pairs.
    """
    if max_bits < 0 or max_bits % 2 or segment_bits not in (2, 4, 8):
        raise ValueError("max_bits must be even and segment_bits 2, 4 or 8")
    steps = max_bits // 2
    cells = grid(fps, steps, segment_bits)
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(cells.join(shared.hint("merge"), "cell"), "simhash-cells")
    left = members.where(F.col("n") <= crowded).select("cell", F.col("fp").alias("a"))
    right = left.select("cell", F.col("a").alias("b"))
    pairs = left.join(right.hint("merge"), "cell").where("a < b").select("a", "b")
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    fine = grid(members.where(F.col("n") > crowded).select("fp").distinct(), steps, 1)
    low = fine.groupBy("cell").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = fine.join(low.select("cell", "a").hint("merge"), "cell").where("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars)


def groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``fp`` and ``component_id``.

    ``component_id`` is the smallest id that links reach. Null ids count as larger than any:
    a component without other ids has a null ``component_id``. A null text is an empty one;
    documents without words share fingerprint zero. Further columns are left out, and no
    document is an empty result.
    """
    marked = materialise(fingerprints(docs, id_column, text_column, words_per_shingle), "simhash")
    classes = materialise(marked.groupBy("fp").agg(F.min("_id").alias("first")), "simhash-fps")
    roots = components(near_pairs(classes.select("fp"), max_bits))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(rooted.join(smallest, "root").select("fp", "root", "component_id"), "simhash-classes")
    return marked.join(named, "fp").select("_id", "_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings: int) -> DataFrame:
    """The document of smallest id of each group, with the columns of ``docs``.

    Null ids come last; equal ids are told apart by their texts' hashes, and rows equal in
    both count as one.
    """
    grouped = groups(docs, id_column, text_column, **settings)
    order = F.struct(F.col("_id").isNull(), "_id", "_hash")
    chosen = grouped.groupBy("root", "_id", "_hash").agg(F.count("*").alias("_n"))
    best = grouped.groupBy("root").agg(F.min(order).alias("best")).select("root", "best._id", "best._hash")
    on = (
        (F.col("c.root") == F.col("w.root")) & (F.col("c._hash") == F.col("w._hash")) & F.col("c._id").eqNullSafe(F.col("w._id"))
    )
    kept = chosen.alias("c").join(best.alias("w"), on).select("c._id", "c._hash", "c._n")
    return attach(docs, materialise(kept, "simhash-kept"), id_column, text_column).select("doc.*")
