"""Runs of words that repeat with a short period, and texts without the repetition.

Suffixes of a text are put in order by prefix doubling, all texts of a batch at once, so
that those that begin alike stand together, each with its common prefix to the one before.
Neighbours are then united by decreasing common prefix, as Kruskal's algorithm takes
edges. A class keeps its positions in order. Two positions that become neighbours within
a class while prefixes of length ``l`` are united have exactly ``l`` words in common; at a
distance ``d`` of at most ``l`` they seed a run of period ``d`` and length ``l + d``, and
no shorter period can hold, since a position a shorter period on would have a longer
common prefix and lie between the two. A seed whose preceding words differ is where its
run starts.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import ship, slim, small_batches, text_hash

#: A run has so many words at least, and so many times its period.
LEAST, EXPONENT = 6, 4
#: Bytes of text whose suffixes are ordered together.
ORDERED_BYTES = 2 << 20

Run = tuple[int, int, int]


def starts_of_groups(keys: np.ndarray) -> np.ndarray:
    """Index of the first member of each value's group, for sorted keys."""
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    return np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))


def in_groups(starts: np.ndarray) -> np.ndarray:
    """Which members are not alone in their group."""
    return (starts != np.arange(len(starts))) | np.append(starts[1:] == starts[:-1], False)


def ordered_suffixes(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in the order of their suffixes, and each position's class per prefix length 1, 2, 4, ...

    Positions are of one class when as many keys as the prefix is long agree. Every text
    must end with a key of its own, and no two texts share keys. A position alone in its
    class is not looked at again.
    """
    order = np.argsort(keys, kind="stable")
    starts = starts_of_groups(keys[order])
    rank = np.empty(len(keys), np.int64)
    rank[order] = starts
    levels, slots, length = [rank.astype(np.int32)], np.flatnonzero(in_groups(starts)), 1
    while len(slots):
        positions = order[slots]
        pairs = rank[positions] * len(keys) + rank[positions + length]
        by = np.argsort(pairs, kind="stable")
        starts = starts_of_groups(pairs[by])
        order[slots] = positions[by]
        rank[order[slots]] = slots[starts]
        levels.append(rank.astype(np.int32))
        slots, length = slots[in_groups(starts)], 2 * length
    return order, levels


def common_prefixes(left: np.ndarray, right: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each pair of positions."""
    found = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][left + found] == levels[k][right + found]
        found += same.astype(np.int64) << k
    return found


def seeds(positions: np.ndarray, edges: np.ndarray, prefixes: np.ndarray, most: np.ndarray) -> list[Run]:
    """Pairs of positions that become neighbours in a class, at most ``most`` apart, with their common prefix.

    Edge ``e`` unites the classes of ``positions[e]`` and ``positions[e + 1]``; edges come
    by decreasing prefix. The smaller class is put into the larger.
    """
    parent = list(range(len(positions)))
    members = [[p] for p in positions.tolist()]
    found: list[Run] = []
    for edge, prefix, reach in zip(edges.tolist(), prefixes.tolist(), most.tolist(), strict=True):
        roots = []
        for node in (edge, edge + 1):
            while parent[node] != node:
                parent[node] = node = parent[parent[node]]
            roots.append(node)
        small, large = sorted(roots, key=lambda root: len(members[root]))
        parent[small] = large
        few, many = members[small], members[large]
        members[small] = []
        last = -1
        for k, position in enumerate(few):
            at = bisect(many, position)
            if at and last < many[at - 1] and position - many[at - 1] <= reach:
                found.append((many[at - 1], position, prefix))
            if at < len(many) and many[at] - position <= reach and (k + 1 == len(few) or many[at] < few[k + 1]):
                found.append((position, many[at], prefix))
            last = position
        if len(few) * 8 > len(many):
            many += few
            many.sort()  # two ordered parts: linear
        else:
            for position in few:
                insort(many, position)
    return found


def find_runs(texts: list[list[bytes]], least: int = LEAST, exponent: int = EXPONENT) -> list[list[Run]]:
    """Start, length and period of all runs of each text's words, by start and period.

    ``exponent`` must be at least 2.
    """
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")
    runs: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(words) for words in texts], np.int64)
    if not sizes.sum():
        return runs
    words = pa.array([word for words in texts for word in words], pa.binary()).dictionary_encode()
    kinds = len(words.dictionary)
    ends = np.cumsum(sizes + 1) - 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    # A key is a word of a text; the place after a text's last word has a key of its own.
    is_word = np.ones(len(owner), bool)
    is_word[ends] = False
    keys = np.full(len(owner), kinds, np.int64)
    keys[is_word] = words.indices.to_numpy(zero_copy_only=False)
    keys += owner * (kinds + 1)
    order, levels = ordered_suffixes(keys)
    # The least common prefix that a run's seed can have; its classes are those of a level below.
    floor = min(max(least - period, (exponent - 1) * period) for period in range(1, least + 1))
    level = floor.bit_length() - 1
    if level >= len(levels):
        return runs
    alike = levels[level][order]
    at = np.flatnonzero(alike[1:] == alike[:-1])
    prefixes = common_prefixes(order[at], order[at + 1], levels)
    at, prefixes = at[prefixes >= floor], prefixes[prefixes >= floor]
    slots = np.unique(np.concatenate((at, at + 1)))
    by = np.argsort(-prefixes, kind="stable")
    found = seeds(order[slots], np.searchsorted(slots, at[by]), prefixes[by], prefixes[by] // (exponent - 1))
    if not found:
        return runs
    begin, again, prefix = np.array(found, np.int64).T
    period, length = again - begin, again - begin + prefix
    whole = (length >= least) & (keys[begin - 1] != keys[again - 1])
    begin, length, period = begin[whole], length[whole], period[whole]
    text = owner[begin]
    begin = begin - (ends - sizes)[text]
    for k in np.lexsort((period, begin, text)):
        runs[text[k]].append((int(begin[k]), int(length[k]), int(period[k])))
    return runs


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by blanks, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join(compress(words, (np.cumsum(change)[:-1] == 0).tolist()))


def runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, exponent: int = EXPONENT
) -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` holds all runs of the whole text, ``start``, ``length`` and ``period`` in
    words, by start and period; ``collapsed`` is the text with one period of each, its words
    joined by blanks. A null or empty text has no words and collapses to the empty text.
    Repeated rows and null ids are rows of their own; no rows give no rows. A text is worked
    on whole in one task, whose memory follows the longest text.
    """
    ship(docs.sparkSession)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))
    kind = rows.schema["_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 2, ORDERED_BYTES):
            split = [(text or b"").split() for text in texts]  # at white space of ASCII, as bytes do
            found = find_runs(split, least, exponent)
            named = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in own] for own in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(words) for words in split], pa.int64()),
                    pa.array(named, run_type),
                    pa.array([collapse(words, own) for words, own in zip(split, found, strict=True)], pa.binary()),
                ],
                names=["_id", "_hash", "n_words", "runs", "collapsed"],
            )

    schema = f"_id {kind}, _hash long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return rows.mapInArrow(search, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(found: str = "runs") -> Column:
    """The run with the greatest length by period, the first of equal ones; null where there is none."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.reduce(
        F.col(found),
        none,
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
