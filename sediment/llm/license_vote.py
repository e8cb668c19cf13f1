"""Licenses in texts, by diagonal voting.

Every text becomes the rolling hashes of its word pairs and triples, which Spark joins to
the places of the same hashes in a fixed set of templates. A hit votes for its template on
a diagonal: place in the text less place in the template. Words standing together as in
the template vote on one diagonal, and an inserted or missing word moves the rest to a
neighbouring one. So votes are counted per diagonal, neighbouring diagonals are merged,
and a span is verified by the share of the template's word groups that it holds, each
counted once.

Votes are kept as a bit per template place. They combine before the shuffle, and a row
repeated in the table changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.llm.common import ship, slim, small_batches, text_hash
from sediment.session import materialise

#: Diagonals that are merged with one before them, and the share of a notice that must be found.
BAND, COVERAGE = 4, 0.6
#: Votes a diagonal needs before it is merged with others, at most; fewer where BAND + 1
#: diagonals with less could still hold the share together.
VOTES = 3
#: Words of one row sent to the join.
ROW_WORDS = 1 << 15
#: Bytes of text hashed together.
PIECE = 1 << 20

# Phrases with the labels they give, found word by word.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Opening words of public license notices, and their labels.
NOTICES = {
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0",
    "this is free and unencumbered software released into the public domain": "public-domain",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
    "as published by the free software foundation either version 3 of the license or at your option any later version": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
    "license as published by the free software foundation": "lgpl",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
    "files the software to deal in the software without restriction": "mit",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "no part of this publication may be reproduced stored in a retrieval system or transmitted in any form or by any means": "reserved",
}
# One line that names a license, and its label. Less than the share of a line's
# triples is without the license's name, or another license of the list has it.
LINES = {
    "the apache license version 2 0": "apache-2.0",
    "the apache license 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "released under the bsd license": "bsd",
    "under the bsd 2 clause license": "bsd",
    "under the bsd 3 clause license": "bsd",
    "under the gnu general public license": "gpl",
    "under the gnu lesser general public license": "lgpl",
    "under the mozilla public license version 2 0": "mpl-2.0",
    "into the public domain": "public-domain",
    "under cc0 1 0": "cc0",
    "cc0 1 0 universal": "cc0",
    "under cc by 4 0": "cc-by",
    "under cc by sa 4 0": "cc-by-sa",
    "under cc by nc 4 0": "cc-by-nc",
    "under cc by nd 4 0": "cc-by-nd",
    "under cc by nc sa 4 0": "cc-by-nc-sa",
    "under cc by nc nd 4 0": "cc-by-nc-nd",
}

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ORDER = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: Stands for the text itself in the join; no group of words hashes to it or to 0.
TEXT = 1
_CODE = np.zeros(256, dtype=np.uint64)  # 0: not part of a word
_CODE[0x30:0x3A] = np.arange(0x30, 0x3A) + 1
_CODE[0x61:0x7B] = np.arange(0x61, 0x7B) + 1
_CODE[0x41:0x5B] = np.arange(0x61, 0x7B) + 1
_CODE[0x80:] = np.arange(0x80, 0x100) + 1


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_tables: list[np.ndarray] = []


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 16)
        _tables[:] = [_powers(int(_BASE), size), _powers(pow(int(_BASE), -1, 1 << 64), size)]
    return _tables[0], _tables[1]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: letters a-z without regard to case, digits, and what isn't ASCII."""
    parts, at = [], 0
    while at < len(text):
        stop = min(len(text), at + PIECE)
        while stop < len(text) and _CODE[text[stop]]:  # never inside a word
            stop += 1
        parts.append(_piece(np.frombuffer(text, dtype=np.uint8, count=stop - at, offset=at)))
        at = stop
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _piece(data: np.ndarray) -> np.ndarray:
    code = _CODE[data]
    inside = code > 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edge[::2], edge[1::2]
    powers, inverse = _table(len(code))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code * powers[: len(code)], dtype=np.uint64)))
    own = (sums[stops] - sums[starts]) * inverse[starts]
    own ^= own >> np.uint64(32)
    return own * _ORDER[2]


def groups_of(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, by first word."""
    count = max(0, len(words) - size + 1)
    total = np.full(count, size, dtype=np.uint64)
    for i in range(size):
        total = (total ^ words[i : i + count]) * _ORDER[i % 2]
        total ^= total >> np.uint64(29)
    total[total <= TEXT] += np.uint64(2)
    return total


@dataclass(frozen=True)
class Template:
    label: str
    words: int
    size: int  # words per group
    phrase: bool


def templates() -> tuple[list[Template], list[tuple[int, int, int]]]:
    """The templates, and hash, template and place of each of their groups (at most 63 per template)."""
    found, rows = [], []
    for texts, size, phrase in ((PHRASES, 2, True), (NOTICES, 3, False), (LINES, 3, False)):
        for text, label in texts.items():
            words = word_hashes(text.encode())
            hashes = groups_of(words, size)
            if not 0 < len(hashes) <= 63:
                raise ValueError(f"a template needs {size} to {62 + size} words: {text}")
            rows += [(h, len(found), place) for place, h in enumerate(hashes.astype(np.int64).tolist())]
            found.append(Template(label, len(words), size, phrase))
    return found, rows


def votes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``_hash``, ``template``, ``diagonal``, ``mask`` of the places found, ``copies``.

    A document itself is a row of template -1, its words the diagonal; ``copies`` tells
    how many equal rows it has.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))
    kind = rows.schema["_id"].dataType.simpleString()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 2):
            at, offsets, lists, held = [], [], [], 0
            for i, text in enumerate(texts):
                words = word_hashes(text or b"")
                both = np.zeros((len(words), 2), dtype=np.uint64)
                for k, size in enumerate((2, 3)):
                    own = groups_of(words, size)
                    both[: len(own), k] = own
                flat = both.reshape(-1).view(np.int64)
                # The text itself comes first: its row has no group, but the number of words.
                at.append(i)
                offsets.append(len(words))
                lists.append(np.array([TEXT], dtype=np.int64))
                for start in range(0, len(words), ROW_WORDS):
                    at.append(i)
                    offsets.append(start)
                    lists.append(flat[2 * start : 2 * (start + ROW_WORDS)])
                held += len(flat)
                if held > 1 << 20:
                    yield out(batch, at, offsets, lists)
                    at, offsets, lists, held = [], [], [], 0
            if at:
                yield out(batch, at, offsets, lists)

    def out(batch: pa.RecordBatch, at: list, offsets: list, lists: list) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        take = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(take),
                batch.column(1).take(take),
                pa.array(offsets, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists))),
            ],
            names=["_id", "_hash", "base", "groups"],
        )

    grams = rows.mapInArrow(hashes, f"_id {kind}, _hash long, base long, groups array<long>")
    grams = grams.select("_id", "_hash", "base", F.posexplode("groups").alias("at", "group"))
    _, places = templates()
    known = spark.createDataFrame([(TEXT, -1, 0), *places], "group long, template int, place int")
    # A few hundred rows, whatever the input.
    hits = grams.join(F.broadcast(known), "group")
    word = F.col("base") + F.floor(F.col("at") / 2)
    hits = hits.select("_id", "_hash", "template", "place", (word - F.col("place")).alias("diagonal"))
    bit = F.expr("shiftleft(1L, place)")
    return hits.groupBy("_id", "_hash", "template", "diagonal").agg(F.bit_or(bit).alias("mask"), F.count("*").alias("n"))


def _labels(spark: SparkSession) -> DataFrame:
    found, places = templates()
    total = [sum(1 for _, t, _ in places if t == i) for i in range(len(found))]
    rows = [(i, t.label, t.words, total[i], t.phrase) for i, t in enumerate(found)]
    return spark.createDataFrame(rows, "template int, label string, words int, groups int, phrase boolean")


def spans(voted: DataFrame) -> DataFrame:
    """Verified spans of ``votes``: ``_id``, ``_hash``, ``label``, ``phrase``, ``start``, ``stop`` (words), ``coverage``.

    A phrase's span is a diagonal on which all its groups vote. A notice's or line's is the
    best of the diagonals near it, each taken with those up to BAND after it.
    """
    known = voted.join(F.broadcast(_labels(voted.sparkSession)), "template")
    exact = known.where(F.col("phrase") & (F.bit_count("mask") == F.col("groups"))).select(
        "_id", "_hash", "label", "phrase", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("words")).alias("stop"), F.lit(1.0).alias("coverage")
    )
    needed = F.least(F.lit(VOTES), F.ceil(F.col("groups") * COVERAGE / (BAND + 1)))
    strong = known.where(~F.col("phrase") & (F.bit_count("mask") >= needed))
    per = Window.partitionBy("_id", "_hash", "template").orderBy("diagonal")
    merged = strong.withColumn("all", F.bit_or("mask").over(per.rangeBetween(0, BAND)))
    merged = merged.withColumn("coverage", F.bit_count("all") / F.col("groups")).where(F.col("coverage") >= COVERAGE)
    around = per.rangeBetween(-BAND, BAND)
    rank = F.struct("coverage", (-F.col("diagonal")).alias("first"))
    best = merged.withColumn("best", F.max(rank).over(around)).where(rank == F.col("best"))
    near = best.select(
        "_id", "_hash", "label", "phrase", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("words") + BAND).alias("stop"), "coverage"
    )
    return exact.union(near)


def licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    The base columns tell of PHRASES, the others also of NOTICES and LINES; the score is the
    best coverage. Without any, the counts are 0, the places null, the labels empty and the
    score 0. A null text is an empty one; repeated rows have a row each.
    """
    voted = materialise(votes(docs, id_column, text_column), "license-votes")
    texts = voted.where("template = -1").select("_id", "_hash", F.col("diagonal").alias("n_words"), F.col("n").alias("copies"))
    found = spans(voted.where("template >= 0"))
    base = F.when(F.col("phrase"), F.col("start"))
    per = found.groupBy("_id", "_hash").agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max("coverage").alias("score"),
    )
    per = per.withColumnsRenamed({"_id": "_id2", "_hash": "_hash2"})
    joined = texts.join(per, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_hash") == F.col("_hash2")), "left")
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    text = {c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit("")).alias(c) for c in ("base_labels", "labels")}
    return joined.select(
        "_id",
        "_hash",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        text["base_labels"],
        text["labels"],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
