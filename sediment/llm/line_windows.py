"""Repeated passages, by overlapping windows of three lines.

Each run of three consecutive lines that are not blank is hashed. Windows found more than
once in the whole corpus are repeated; all their occurrences but the first lose their
lines, overlapping occurrences merged. "First" is by smallest id, text hash and place. A
removed line therefore always has an equal line that stays, further to the front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import packed, ship, slim, text_hash, tidy
from sediment.session import materialise

WINDOW_LINES = 3
BLANK = " \t\n\x0b\x0c\r"


def windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """One row per window: ``_id``, ``_hash``, its lines ``start`` to ``stop`` and 128 bits of hash ``h1``, ``h2``.

    Lines end at a line feed; white space around a line does not count, and blank lines are
    skipped over.
    """

    def facts(line: Column, at: Column) -> Column:
        bare = F.btrim(line, F.lit(BLANK))
        return F.struct(at.alias("at"), F.xxhash64(bare).alias("x"), F.xxhash64(F.lit(1), bare).alias("y"), (bare == "").alias("blank"))

    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.split("_text", "\n").alias("lines"))
    rows = rows.where(F.size("lines") >= size)
    rows = rows.select("_id", "_hash", F.filter(F.transform("lines", facts), lambda x: ~x["blank"]).alias("lines"))
    rows = rows.where(F.size("lines") >= size)
    shifted = [F.slice("lines", F.lit(i + 1), F.size("lines") - (size - 1)) for i in range(size)]
    rows = rows.select("_id", "_hash", F.explode(F.arrays_zip(*[s.alias(f"l{i}") for i, s in enumerate(shifted)])).alias("w"))
    part = [F.col("w").getField(f"l{i}") for i in range(size)]
    return rows.select(
        "_id",
        "_hash",
        part[0]["at"].alias("start"),
        part[-1]["at"].alias("stop"),
        F.xxhash64(*[p["x"] for p in part]).alias("h1"),
        F.xxhash64(*[p["y"] for p in part]).alias("h2"),
    )


def covered(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """``_id``, ``_hash`` and ``spans``, the lines [start, stop] that later occurrences cover."""
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash", "start")
    found = windows(docs, id_column, text_column, size)
    repeated = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    # Spark takes windows for no larger than the texts in their file, and may broadcast them.
    later = found.join(repeated.hint("merge"), ["h1", "h2"]).where(place != F.col("first")).select("_id", "_hash", "start", "stop")
    return later.groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without(lines: list[str], spans: list[tuple[int, int]]) -> tuple[list[str], int]:
    """The lines outside of the spans, and how many lines that are not blank went."""
    kept, at, gone = [], 0, 0
    for start, stop in sorted(spans):
        kept += lines[at : max(at, start)]
        gone += sum(1 for x in lines[max(at, start) : stop + 1] if x.strip(BLANK))
        at = max(at, stop + 1)
    return kept + lines[at:], gone


def deduplicate(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW_LINES
) -> DataFrame:
    """``doc``, the documents with repeated passages cut out, and ``removed``, the lines that went.

    ``doc`` has all columns, the text replaced. Blank lines inside a cut go with it and are not
    counted. A null text stays null, and texts of fewer than three lines stay as they are.
    Rows equal in id and text are treated alike, as one document. No rows give no rows.
    """

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            touched = pc.is_valid(spans)
            kept, removed = [], np.zeros(len(texts), dtype=np.int64)
            for i in np.flatnonzero(touched.to_numpy(zero_copy_only=False)):
                places = [(c["start"], c["stop"]) for c in spans[i].as_py()]
                lines, removed[i] = without(texts[i].as_py().split("\n"), places)
                kept.append("\n".join(lines))
            left = pc.replace_with_mask(texts, touched, pa.array(kept, texts.type)) if kept else texts
            yield pa.StructArray.from_arrays([left, pa.array(removed)], names=["text", "removed"])
        tidy()

    ship(docs.sparkSession)
    spans = materialise(covered(docs, id_column, text_column, size), "line-spans")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_hash") == F.col("_hash"))
    # The same join at every size: cuts grow with the corpus.
    joined = packed(docs, id_column, text_column).join(spans.hint("merge"), on, "left")
    text = F.col("doc").getField(text_column)
    joined = joined.select("doc", F.arrow_udf(cut, "text string, removed long")(text, F.col("spans")).alias("cut"))
    new = [F.col("cut.text") if c == text_column else F.col("doc").getField(c) for c in docs.columns]
    return joined.select(F.struct(*[v.alias(c) for v, c in zip(new, docs.columns, strict=True)]).alias("doc"), "cut.removed")


def drop_emptied(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents after ``deduplicate``, less those that lost every line; columns as before."""
    left = F.regexp_like(F.col("doc").getField(text_column), F.lit(r"[^\x20\x09-\x0D]"))
    return deduplicate(docs, id_column, text_column).where((F.col("removed") == 0) | left).select("doc.*")
