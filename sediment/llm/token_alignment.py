"""Two tokenizers' ids for the same text, aligned where both end a token.

Both cut a text's bytes into tokens. A byte at which tokens of both end is a shared cut,
and the tokens between two neighbouring shared cuts form a group. Cuts are found by divide
and conquer: from the middle of an interval, the ends of both sides are bisected in turn
for the nearest end they share; the two halves go on alone, and an interval without a
shared cut inside is a group. All intervals of one depth are bisected together.

How often two ids meet in a group is counted over the whole corpus. Blocks of documents,
bounded by their bytes of text, each send the distinct pairs they hold, not one row per
document and link; these are counted and come back to their block, which then adds up the
links of each document. The one thing broadcast is the highest count per id of the first
vocabulary, which that vocabulary bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.llm.common import ship, slim, small_batches, text_hash, tidy
from sediment.llm.separator_scan import ranked_pieces

FIRST, SECOND = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Bytes of text aligned together, and of a block; a longer text is a block of its own.
ALIGNED_BYTES, BLOCK_BYTES = 2 << 20, 8 << 20
#: Groups with more pairs of tokens than this are reduced to distinct ids before they are paired.
LARGE_GROUP = 4096
PER_TASK = 1 << 32
#: Ids of the second vocabulary lie below this; a pair of ids is one number.
SHIFT = 32


BLANK = 0x20
#: Segments tokenised as one text.
TOGETHER = 64


def piece_bytes(piece: str) -> bytes:
    """What a piece of the second vocabulary stands for."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Vocabularies:
    """Both tokenizers with the bytes of their pieces.

    Before a blank that stands between two characters that are not white space, both start
    a token, and what is on one side changes nothing on the other, as long as no piece of
    the second holds a blank after another character. Texts are cut there into segments,
    and equal segments of texts at hand are tokenised once.
    """

    def __init__(self, first: str, second: str):
        ranks = ranked_pieces(first)
        self.first = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        known = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            known[rank] = piece
        names = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.first_pieces, self.second_pieces = known, list(map(piece_bytes, names))
        self.lengths = tuple(np.array(list(map(len, side)), np.int64) for side in (self.first_pieces, self.second_pieces))
        most = max(len(self.first_pieces), len(self.second_pieces))
        #: Each id as text after a comma, a bar, a semicolon and nothing.
        self.texts = pa.array([mark + str(k) for mark in (",", "|", ";", "") for k in range(most)], pa.string())
        self.n_texts = most
        # A character after the blank that surely is not white space: of ASCII, or by its first byte.
        after = np.zeros(256, bool)
        if not any("▁" in name.lstrip("▁") for name in names):
            after[0x21:0x7F] = after[0xC3:0xE0] = after[0xE4:0xF5] = True
        self._after = after

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Places where segments of joined texts start, given those where a text starts."""
        begins = np.zeros(len(data), bool)
        begins[1:-1] = (data[1:-1] == BLANK) & self._after[data[2:]] & (data[:-2] != BLANK)
        begins[starts] = True
        return np.flatnonzero(begins)

    def ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of each side for texts that start with a blank, one after another, and whether both keep the bytes."""
        plain = [text.decode("utf-8", "replace") for text in texts]
        a = [self.first.encode_to_numpy(text, disallowed_special=()) for text in plain]
        b = self.second.encode([text[1:] for text in plain], num_threads=1)
        flat = [np.concatenate([*map(np.asarray, side), np.empty(0, np.int64)]).astype(np.int64) for side in (a, b)]
        wanted = b"".join(texts)
        pieces = (self.first_pieces, self.second_pieces)
        return *flat, all(b"".join(map(known.__getitem__, ids.tolist())) == wanted for known, ids in zip(pieces, flat, strict=True))

    def segments(self, found: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of each side one after another, how many each segment has, and whether both keep its bytes.

        Segments that may follow one another in a text are tokenised as one text.
        """
        joins = np.array([bool(len(x) > 1 and self._after[x[1]] and x[-1] != BLANK) for x in found], bool)
        at, alone = np.flatnonzero(joins), np.flatnonzero(~joins)
        joined = [b"".join(found[k] for k in at[start : start + TOGETHER]) for start in range(0, len(at), TOGETHER)]
        a, b, same = self.ids_of(joined)
        ends = np.cumsum([len(found[k]) for k in at], dtype=np.int64)
        flat, counts = [[a], [b]], [np.zeros(len(found), np.int64) for _ in range(2)]
        for side, ids in enumerate((a, b)):
            if same := same and bool(len(ids)):
                token_ends = np.cumsum(self.lengths[side][ids])
                last = np.searchsorted(token_ends, ends)
                same = bool((token_ends[last] == ends).all())
                counts[side][at] = np.diff(last + 1, prepend=0)
        if not same:
            flat, at, alone = [[], []], at[:0], np.arange(len(found))
        kept = np.ones(len(found), bool)
        for k in alone:
            a, b, kept[k] = self.ids_of([found[k]])
            flat[0].append(a)
            flat[1].append(b)
            counts[0][k], counts[1][k] = len(a), len(b)
        order = np.empty(len(found), np.int64)
        order[np.concatenate((at, alone))] = np.arange(len(found))
        inverse = np.argsort(order)
        values = [
            gathered(np.concatenate([*parts, np.empty(0, np.int64)]), n[inverse], order)
            for parts, n in zip(flat, counts, strict=True)
        ]
        return values, counts, kept


_loaded: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(first: str | None = None, second: str | None = None) -> Vocabularies:
    """One of each per process: a file of ranks, and a model of pieces."""
    places = (first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND))
    if places not in _loaded:
        _loaded[places] = Vocabularies(*places)
    return _loaded[places]


def gathered(values: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``at`` of values that lie one after another, ``lengths`` long."""
    counts = lengths[at]
    begin = (np.cumsum(lengths) - lengths)[at]
    return values[np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]


def tokenise(texts: list[bytes | None], both: Vocabularies) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids one after another, and how many each text has, of blank and text by the first and text by the second.

    The second puts the blank there itself. No ids for a text that is null or empty, or
    whose bytes one of them changes.
    """
    whole = [b" " + text if text else b"" for text in texts]
    sizes = np.array(list(map(len, whole)), np.int64)
    joined = b"".join(whole)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    cuts = both.cuts(np.frombuffer(joined, np.uint8), starts)
    places = pa.py_buffer(np.append(cuts, len(joined)).astype(np.int64))
    segments = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, places, pa.py_buffer(joined)]).dictionary_encode()
    found, lengths, same = both.segments(segments.dictionary.to_pylist())
    at = segments.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.searchsorted(np.cumsum(sizes), cuts, side="right")
    fine = np.ones(len(texts), bool)
    doubted = np.unique(text[~same[at]])
    ids, counts = [], []
    for side, pieces in enumerate((both.first_pieces, both.second_pieces)):
        ids.append(gathered(found[side], lengths[side], at))
        counts.append(np.bincount(text, lengths[side][at], len(texts)).astype(np.int64))
        ends = np.cumsum(counts[side])
        for k in doubted:
            fine[k] &= b"".join(pieces[i] for i in ids[side][ends[k] - counts[side][k] : ends[k]]) == whole[k]
    for side in (0, 1):
        ids[side] = ids[side][np.repeat(fine, counts[side])]
        counts[side] = np.where(fine, counts[side], 0)
    return ids, counts


def shared_cuts(first: np.ndarray, second: np.ndarray, at: np.ndarray, limit: np.ndarray, up: bool) -> np.ndarray:
    """For each place in ``first``, the nearest one on that side, up to the limit, whose value ``second`` has; else -1.

    Both are increasing. The two are bisected in turn, each for the value the other stopped at.
    """
    found = np.full(len(at), -1, np.int64)
    left = np.arange(len(at))
    while len(left):
        inside = at <= limit if up else at >= limit
        left, at, limit = left[inside], at[inside], limit[inside]
        ends = first[at]
        if up:
            met = second[np.searchsorted(second, ends)]  # both have the last end
        else:
            before = np.searchsorted(second, ends, side="right") - 1
            met = np.where(before >= 0, second[before], -1)
        same = met == ends
        found[left[same]] = at[same]
        left, limit, met = left[~same], limit[~same], met[~same]
        at = np.searchsorted(first, met) if up else np.searchsorted(first, met, side="right") - 1
    return found


def leaf_groups(ends_a: np.ndarray, ends_b: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either side each group has, from the ends of all tokens.

    ``roots`` are shared ends that part the texts; the last end of both sides is one.
    """
    high_a, high_b = np.searchsorted(ends_a, roots), np.searchsorted(ends_b, roots)
    low_a, low_b = np.append(0, high_a[:-1] + 1), np.append(0, high_b[:-1] + 1)
    leaves: list[tuple[np.ndarray, ...]] = []
    # An interval is its first and last token on either side, whose last ends are the same byte.
    while len(low_a):
        inner = (high_a > low_a) & (high_b > low_b)
        leaves.append((low_a[~inner], high_a[~inner], low_b[~inner], high_b[~inner]))
        low_a, high_a, low_b, high_b = low_a[inner], high_a[inner], low_b[inner], high_b[inner]
        middle = (low_a + high_a - 1) // 2
        cut = shared_cuts(ends_a, ends_b, middle, high_a - 1, up=True)
        missed = np.flatnonzero(cut < 0)
        cut[missed] = shared_cuts(ends_a, ends_b, middle[missed], low_a[missed], up=False)
        whole = cut < 0
        leaves.append((low_a[whole], high_a[whole], low_b[whole], high_b[whole]))
        cut, low_a, high_a, low_b, high_b = cut[~whole], low_a[~whole], high_a[~whole], low_b[~whole], high_b[~whole]
        cut_b = np.searchsorted(ends_b, ends_a[cut])
        # Halves side by side, so that what is bisected next is in order.
        low_a, high_a = np.column_stack((low_a, cut + 1)).ravel(), np.column_stack((cut, high_a)).ravel()
        low_b, high_b = np.column_stack((low_b, cut_b + 1)).ravel(), np.column_stack((cut_b, high_b)).ravel()
    if not leaves:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low_a, high_a, low_b, high_b = (np.concatenate(part) for part in zip(*leaves, strict=True))
    order = np.argsort(low_a)
    return (high_a - low_a + 1)[order], (high_b - low_b + 1)[order]


@dataclass
class Aligned:
    """Documents one after another: ids of both sides, tokens per group, and how many of each a document has."""

    a: np.ndarray
    b: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair of ids and multiplicity of the links; large groups give each pair once."""
        owner = np.repeat(np.arange(len(self.n_groups)), self.n_groups)
        n = self.sizes_a * self.sizes_b
        begin_a, begin_b = np.cumsum(self.sizes_a) - self.sizes_a, np.cumsum(self.sizes_b) - self.sizes_b
        small = np.flatnonzero(n <= LARGE_GROUP)
        group = np.repeat(small, n[small])
        nth = np.arange(len(group)) - np.repeat(np.cumsum(n[small]) - n[small], n[small])
        down, across = np.divmod(nth, self.sizes_b[group])
        pairs = (self.a[begin_a[group] + down] << SHIFT) | self.b[begin_b[group] + across]
        parts = [(owner[group], pairs, np.ones(len(group), np.int64))]
        for k in np.flatnonzero(n > LARGE_GROUP):
            a, n_a = np.unique(self.a[begin_a[k] : begin_a[k] + self.sizes_a[k]], return_counts=True)
            b, n_b = np.unique(self.b[begin_b[k] : begin_b[k] + self.sizes_b[k]], return_counts=True)
            weight = np.outer(n_a, n_b).ravel()
            parts.append((np.full(len(weight), owner[k]), ((a << SHIFT)[:, None] | b).ravel(), weight))
        return tuple(np.concatenate(part) for part in zip(*parts, strict=True))

    def n_links(self) -> np.ndarray:
        return sums(self.sizes_a * self.sizes_b, self.n_groups)

    def distinct_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of ids, and how many of the documents hold each."""
        owner, pairs, _ = self.links()
        order = np.lexsort((owner, pairs))
        owner, pairs = owner[order], pairs[order]
        first = np.append(True, (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1]))[: len(pairs)]
        return np.unique(pairs[first], return_counts=True)

    def written(self, both: Vocabularies) -> pa.Array:
        """Each document's groups as text, ``a1,a2|b1;a3|b2,b3``.

        Every id is taken from a table with the mark before it; what is taken lies one after
        another in memory, so a document's text is a part of it.
        """
        group_a, group_b = (np.repeat(np.arange(len(size)), size) for size in (self.sizes_a, self.sizes_b))
        begin_a, begin_b = np.cumsum(self.sizes_a) - self.sizes_a, np.cumsum(self.sizes_b) - self.sizes_b
        mark_a, mark_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        mark_a[begin_a], mark_b[begin_b] = 2, 1
        mark_a[(np.cumsum(self.n_a) - self.n_a)[self.n_a > 0]] = 3
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + begin_b[group_a]] = mark_a * both.n_texts + self.a
        codes[np.arange(len(self.b)) + (begin_a + self.sizes_a)[group_b]] = mark_b * both.n_texts + self.b
        taken = both.texts.take(pa.array(codes))
        _, ends, data = taken.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(codes) + 1] if ends and len(codes) else np.zeros(1, np.int32)
        own = ends[np.append(0, np.cumsum(self.n_a + self.n_b))]
        return pa.Array.from_buffers(pa.string(), len(self.n_a), [None, pa.py_buffer(own.copy()), data or pa.py_buffer(b"")])


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of values, ``counts`` of them each."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def align_texts(texts: list[bytes | None], both: Vocabularies) -> Aligned:
    """Ids and groups of some texts."""
    (a, b), (n_a, n_b) = tokenise(texts, both)
    ends_a, ends_b = (np.cumsum(lengths[ids]) for lengths, ids in zip(both.lengths, (a, b), strict=True))
    filled = np.flatnonzero(n_a)
    sizes_a, sizes_b = leaf_groups(ends_a, ends_b, ends_a[np.cumsum(n_a)[filled] - 1])
    n_groups = np.zeros(len(texts), np.int64)
    last = np.searchsorted(np.cumsum(sizes_a), np.cumsum(n_a)[filled])
    n_groups[filled] = np.diff(last + 1, prepend=0)
    return Aligned(a, b, sizes_a, sizes_b, n_a, n_b, n_groups)


def _tokens(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = slim(docs, _id=id_column, _text=text_column)
    return rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))


def align(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first: str | None = None,
    second: str | None = None,
) -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups``.

    ``groups`` is text: ids of the first side, a bar, ids of the second, groups parted by
    semicolons. A null or empty text, or one whose bytes a tokenizer changes, has no tokens
    and no groups. Repeated rows and null ids are rows of their own; no rows give no rows.
    """
    ship(docs.sparkSession)
    rows = _tokens(docs, id_column, text_column)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(first, second)
        for batch, texts in small_batches(batches, 2, ALIGNED_BYTES):
            found = align_texts(texts, both)
            columns = [found.n_a, found.n_b, found.n_groups, found.n_links()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns), found.written(both)],
                names=["_id", "_hash", "n_a", "n_b", "n_groups", "n_links", "groups"],
            )

    return rows.mapInArrow(
        run, f"_id {kind}, _hash long, n_a long, n_b long, n_groups long, n_links long, groups string"
    )


def _packed(batch: pa.RecordBatch, found: Aligned) -> bytes:
    """Aligned documents with their ids and hashes, compressed."""

    def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
        ends = np.append(0, np.cumsum(counts))
        width = np.min_scalar_type(int(values.max(initial=0)))
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(values.astype(width)))

    table = pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            lists(found.a, found.n_a),
            lists(found.b, found.n_b),
            lists(found.sizes_a, found.n_groups),
            lists(found.sizes_b, found.n_groups),
        ],
        names=["_id", "_hash", "a", "b", "sizes_a", "sizes_b"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> tuple[pa.RecordBatch, Aligned]:
    with pa.ipc.open_stream(data) as stream:
        table = stream.read_next_batch()
    a, b, sizes_a, sizes_b = (table.column(k) for k in range(2, 6))
    flat = [part.flatten().to_numpy().astype(np.int64) for part in (a, b, sizes_a, sizes_b)]
    counts = [np.diff(part.offsets.to_numpy()) for part in (a, b, sizes_a)]
    return table, Aligned(*flat, *counts)


def _blocks(docs: DataFrame, id_column: str, text_column: str, first: str | None, second: str | None, size: int) -> DataFrame:
    """Aligned documents in blocks of a task's: ``block``, ``parts``, packed, and the distinct ``pairs`` with ``docs``, how many hold each."""
    rows = _tokens(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number, held = vocabularies(first, second), TaskContext.get().partitionId() * PER_TASK, 0
        parts: list[bytes] = []
        held_pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            pairs, at = np.unique(np.concatenate([pairs for pairs, _ in held_pairs]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, at, np.concatenate([n for _, n in held_pairs]))
            lists = [pa.LargeListArray.from_arrays([0, len(pairs)], pa.array(values)).cast(pa.list_(pa.int64())) for values in (pairs, n)]
            row = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([parts], pa.list_(pa.binary())), *lists],
                names=["block", "parts", "pairs", "docs"],
            )
            parts.clear()
            held_pairs.clear()
            return row

        for batch, texts in small_batches(batches, 2, min(size, ALIGNED_BYTES)):
            n = sum(len(text or b"") for text in texts)
            if parts and held + n > size:
                yield block()
                number, held = number + 1, 0
            found = align_texts(texts, both)
            parts.append(_packed(batch, found))
            held_pairs.append(found.distinct_pairs())
            held += n
        if parts:
            yield block()

    return rows.mapInArrow(run, "block long, parts array<binary>, pairs array<long>, docs array<long>")


def _pairs_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair of a block. In Python, so that Spark takes the blocks as they were dealt and shuffles them once."""
    for batch in batches:
        pairs, docs = batch.column(2), batch.column(3)
        block = np.repeat(batch.column(0).to_numpy(), np.diff(pairs.offsets.to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array(block), pairs.flatten(), docs.flatten()], names=["block", "pair", "docs"])


def _added_up(schema: T.StructType, first: str | None, second: str | None):
    """Adds up what a block's pairs count, per document."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        both, done = vocabularies(first, second), []
        pairs = right.column("pair").to_numpy()
        order = np.argsort(pairs)
        pairs, counts = pairs[order], right.column("n").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        for part in left.column("parts")[0].as_py():
            table, found = _unpacked(part)
            owner, own, weight = found.links()
            at = np.searchsorted(pairs, own)
            if len(own) and (not len(pairs) or at.max() == len(pairs) or (pairs[at] != own).any()):
                raise RuntimeError("a block's documents changed between its evaluations; write them first")
            n = len(found.n_a)
            # Sums of long integers, not of doubles.
            per_doc = np.zeros((2, n), np.int64)
            if len(own):
                np.add.at(per_doc[0], owner, weight * counts[at])
                np.add.at(per_doc[1], owner, weight * best[at])
            numbers = [found.n_a, found.n_b, found.n_groups, found.n_links(), per_doc[1], per_doc[0]]
            columns = [table.column(0), table.column(1), *map(pa.array, numbers), found.written(both)]
            done.append(pa.RecordBatch.from_arrays(columns, names=schema.names))
        return pa.Table.from_batches(done)

    return run


def link_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first: str | None = None,
    second: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """What ``align`` gives, with ``n_best`` and ``count_sum`` over each document's links.

    A link is a token of the first and one of the second side in a group. A pair of ids
    counts as often as there are documents, repeated rows included, that hold it linked;
    ``count_sum`` adds this up over links, ``n_best`` counts the links whose pair counts
    most among those of its first id, ties included. Nulls, empty texts and empty tables
    as in ``align``. Blocks are cut in the order a task reads its rows, so ``docs`` must
    come in the same order when a task runs again, as files do; otherwise it is an error.
    """
    spark = docs.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt once: the pairs are drawn from the same shuffle that the blocks meet their counts in.
    blocks = _blocks(docs, id_column, text_column, first, second, block_bytes).repartition(n, "block")
    asked = blocks.mapInArrow(_pairs_of_blocks, "block long, pair long, docs long")
    counted = asked.select("block", "pair", F.sum("docs").over(Window.partitionBy("pair")).alias("n"))
    a = F.shiftrightunsigned("pair", SHIFT).alias("a")
    most = F.broadcast(counted.select(a, "n").groupBy("a").agg(F.max("n").alias("most")))
    known = counted.select("block", "pair", "n", a).join(most, "a")
    answers = known.select("block", "pair", "n", (F.col("n") == F.col("most")).alias("best"))
    kind = _tokens(docs, id_column, text_column).schema["_id"].dataType
    longs = ["_hash", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType(
        [T.StructField("_id", kind), *[T.StructField(name, T.LongType()) for name in longs], T.StructField("groups", T.StringType())]
    )
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_added_up(schema, first, second), schema)
