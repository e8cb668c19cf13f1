"""Training sequences of one length, packed online by the sum of squares.

A document becomes the ids of a public tokenizer and an end id. What fills whole windows
is cut off at once; the rest is placed, as documents come, into a partly filled window
chosen by its fill alone: the one after which the squares of the numbers of windows per
fill add up to least. An array over fills holds those numbers, so a placement is one
vectorised look at it, and many windows of one fill never pile up while others could use
them. Each task packs the documents it reads. Its windows that are still open at the end
are poured into one another, cutting documents, and the last one is cut into sequences
whose lengths are powers of two, which are not padded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import ship, slim, small_batches, text_hash
from sediment.llm.separator_scan import ranked_pieces

WINDOW, END = 2048, 1
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed values of this vocabulary: the text that stands for a special id, and that id.
SPECIAL = {"<|endoftext|>": 50256}
#: Windows that a task keeps open, 8 KB each when full; beyond it those of the commonest fill are poured together, or all if no two are alike.
MOST_OPEN = 1024
#: Bytes of text tokenised at a time, and numbers kept apart per task.
TOKENISED_BYTES, PER_TASK = 1 << 20, 1 << 33

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(path: str | None = None) -> tiktoken.Encoding:
    """One per process. ``path`` is a file of ranks, by default the public one of this package's vocabulary."""
    place = path or public_tokenizers.path(VOCABULARY)
    if place not in _encodings:
        _encodings[place] = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranked_pieces(place), special_tokens=SPECIAL
        )
    return _encodings[place]


def ids(text: bytes | None, end: int = END, path: str | None = None) -> np.ndarray:
    """A document's ids: those of the text, special ids written in it included, and the end id."""
    coded = encoding(path).encode_to_numpy((text or b"").decode("utf-8", "replace"), allowed_special="all")
    return np.append(coded, end).astype("<u4")


@dataclass
class Piece:
    """Ids of one document, from ``start`` on."""

    document: object
    start: int
    ids: np.ndarray


@dataclass
class Packer:
    """Windows that are open, by fill, and the numbers of them."""

    window: int = WINDOW
    most_open: int = MOST_OPEN
    by_fill: dict[int, list[list[Piece]]] = field(default_factory=dict)
    n_open: int = 0

    def __post_init__(self) -> None:
        # What one window more of a fill adds to the sum of squares; full ones don't count.
        self.adds = np.ones(self.window + 1, np.int64)
        self.adds[self.window] = 0
        # What one window less takes from it; the empty window takes nothing, and a fill without windows is no choice.
        self.takes = np.full(self.window + 1, -(1 << 60), np.int64)
        self.takes[0] = 0

    def _count(self, fill: int, change: int) -> None:
        self.n_open += change
        self.adds[fill] += 2 * change
        self.takes[fill] = self.adds[fill] - 2 if self.adds[fill] > 1 else -(1 << 60)

    def _open(self, fill: int, pieces: list[Piece]) -> None:
        self.by_fill.setdefault(fill, []).append(pieces)
        self._count(fill, 1)

    def best_fill(self, size: int) -> int:
        """The fill, 0 for a new window, to which ``size`` ids go; the fullest of equally good ones."""
        change = self.adds[size:] - self.takes[: self.window + 1 - size]
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Put a piece of at most a window into a window; windows that this fills."""
        fill, size, pieces = self.best_fill(len(piece.ids)), len(piece.ids), []
        if fill:
            pieces = self.by_fill[fill].pop()
            self._count(fill, -1)
        pieces.append(piece)
        if fill + size == self.window:
            yield pieces
            return
        self._open(fill + size, pieces)
        if self.n_open > self.most_open:
            common = max(self.by_fill, key=lambda level: len(self.by_fill[level]))
            yield from self._pour([common] if len(self.by_fill[common]) > 1 else list(self.by_fill))

    def _pour(self, fills: list[int]) -> Iterator[list[Piece]]:
        """Fill up the fullest windows of these fills from the emptiest; at most one stays open."""
        windows = [pieces for fill in sorted(fills) for pieces in self.by_fill[fill]]
        for fill in fills:
            self._count(fill, -len(self.by_fill.pop(fill)))
        while windows:
            target = windows.pop()
            need = self.window - sum(len(piece.ids) for piece in target)
            while need and windows:
                donor = windows[0]
                piece = donor.pop()
                if len(piece.ids) > need:
                    donor.append(Piece(piece.document, piece.start + need, piece.ids[need:]))
                    piece = Piece(piece.document, piece.start, piece.ids[:need])
                target.append(piece)
                need -= len(piece.ids)
                if not donor:
                    windows.pop(0)
            if need:
                self._open(self.window - need, target)
            else:
                yield target

    def add(self, document: object, coded: np.ndarray) -> Iterator[list[Piece]]:
        """Pack a document; sequences that are complete."""
        whole = len(coded) - len(coded) % self.window
        for start in range(0, whole, self.window):
            yield [Piece(document, start, coded[start : start + self.window])]
        if whole < len(coded):
            yield from self.place(Piece(document, whole, coded[whole:].copy()))

    def finish(self) -> Iterator[list[Piece]]:
        """The sequences still open, poured together, the last cut at powers of two."""
        yield from self._pour(list(self.by_fill))
        rest = [piece for windows in self.by_fill.values() for pieces in windows for piece in pieces]
        left = sum(len(piece.ids) for piece in rest)
        while left:
            need, pieces = 1 << (left.bit_length() - 1), []
            left -= need
            while need:
                piece = rest.pop(0)
                if len(piece.ids) > need:
                    rest.insert(0, Piece(piece.document, piece.start + need, piece.ids[need:]))
                    piece = Piece(piece.document, piece.start, piece.ids[:need])
                pieces.append(piece)
                need -= len(piece.ids)
            yield pieces


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end: int = END,
    path: str | None = None,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """One row per piece: ``_id``, ``_hash``, ``document``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are unsigned little-endian 32-bit numbers, ``start`` counts the document's ids
    before the piece and ``offset`` those of the sequence. Sequences hold ``window`` ids, or
    a power of two: as long as the window is one too, nothing is padded. ``document`` and
    ``sequence_id`` number documents and sequences over all tasks, with gaps, so repeated
    rows and null ids stay documents of their own. A null or empty text is its end id. No
    rows give no rows. Documents of any length are cut freely. ``path`` is a file of ranks
    that executors have too. What goes together depends on the order in which a task reads.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("a window's size must be a power of two")
    ship(docs.sparkSession)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, documents, sequences = Packer(window, most_open), TaskContext.get().partitionId() * PER_TASK, 0, 0
        id_type = None

        def rows_of(done: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences
            flat = [piece for pieces in done for piece in pieces]
            counts = np.array([len(pieces) for pieces in done], np.int64)
            lengths = np.array([len(piece.ids) for piece in flat], np.int64)
            before = np.cumsum(lengths) - lengths
            first = np.repeat(before[np.cumsum(counts) - counts], counts)
            number = base + sequences + np.repeat(np.arange(len(done)), counts)
            sequences += len(done)
            owners = [piece.document for piece in flat]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([owner[0] for owner in owners], id_type),
                    pa.array([owner[1] for owner in owners], pa.int64()),
                    pa.array([owner[2] for owner in owners], pa.int64()),
                    pa.array([piece.start for piece in flat], pa.int64()),
                    pa.array(lengths),
                    pa.array([piece.ids.tobytes() for piece in flat], pa.binary()),
                    pa.array([owner[3] for owner in owners], pa.int64()),
                    pa.array(number),
                    pa.array(before - first),
                ],
                names=["_id", "_hash", "document", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch, texts in small_batches(batches, 2, TOKENISED_BYTES):
            id_type = batch.column(0).type
            done: list[list[Piece]] = []
            for known, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                coded = ids(text, end, path)
                done += packer.add((known, digest, base + documents, len(coded)), coded)
                documents += 1
            if done:
                yield rows_of(done)
        if rest := list(packer.finish()):
            yield rows_of(rest)

    return rows.mapInArrow(
        run,
        f"_id {kind}, _hash long, document long, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long",
    )
