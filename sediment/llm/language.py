"""Language identification by unigrams over all segmentations.

Each language gives every piece of a fixed public vocabulary a probability. The
probability of a word is the sum, over all ways to cut it into pieces, of the products of
their probabilities; a forward pass adds them up without listing them. A text's score is
the product over its words. The piece probabilities are learned by expectation
maximisation, which takes expected piece counts from a forward and a backward pass over
the distinct words of each language.

Texts count in lower case, so that shouting is still a language. Pieces never span words: a
word is a blank and the characters up to the next white space, and one of more than
``LONGEST`` characters counts as several. The 256 single bytes are pieces, so every text
has a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import parts, ship, slim, small_batches, text_hash, tidy
from sediment.session import materialise

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Rounds of expectation maximisation, starting from equal probabilities.
ROUNDS = 3
#: Characters after which a word is cut.
LONGEST = 64
#: Added to every expected count.
SMOOTH = 0.05
#: Bytes of text looked at together, words of one pass, and words of one step of learning.
BATCH, WORDS, LEARN_WORDS = 4 << 20, 1 << 14, 1 << 18
#: Words are padded to a multiple of this, so that few lengths differ.
PAD = 4
UNDETERMINED = "und"
#: A document is rejected below this probability of its best language.
LEAST_SCORE = 0.5

_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEN_BITS = 20
_LETTER = regex.compile(r"\p{L}")
_BREAK = bytes([0x09, 0x0A, 0x0B, 0x0C, 0x0D])


class Pieces:
    """Finds vocabulary pieces among the substrings of many words at once."""

    def __init__(self, path: str = VOCABULARY):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {bytes([b]) for b in range(256)}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                piece = model.id_to_piece(i).replace("▁", " ").encode()
                if b" " not in piece[1:]:
                    pieces.add(piece)
        self.pieces = sorted(pieces)
        self.longest = max(map(len, self.pieces))
        hashes = np.array([self._hash(p) for p in self.pieces], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if (np.diff(self.hashes) == 0).any():
            raise ValueError("two pieces share a hash")
        self.seen = np.zeros(1 << _SEEN_BITS, dtype=bool)
        self.seen[self._slot(self.hashes)] = True
        factors = np.full(4 * LONGEST + PAD + 2, _BASE)
        factors[0] = 1
        self.powers = np.cumprod(factors)

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * _MIX) >> np.uint64(64 - _SEEN_BITS)

    def prefixes(self, words: np.ndarray) -> np.ndarray:
        """Hash of each prefix; words is (count, length)."""
        out = np.zeros((words.shape[0], words.shape[1] + 1), dtype=np.uint64)
        for j in range(words.shape[1]):
            out[:, j + 1] = out[:, j] * _BASE + (words[:, j].astype(np.uint64) + np.uint64(1))
        return out

    def find(self, prefixes: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose bytes [start, stop) are a piece, and its number."""
        h = prefixes[:, stop] - prefixes[:, start] * self.powers[stop - start]
        rows = np.flatnonzero(self.seen[self._slot(h)])
        at = np.searchsorted(self.hashes, h[rows])
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == h[rows]
        return rows[hit], self.order[at[hit]]


_pieces: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """One per process."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of words of similar length, their bytes after a blank, padded, and their lengths so."""
    lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
    padded = -(-lengths // PAD) * PAD
    order = np.argsort(padded, kind="stable")
    cuts = np.flatnonzero(np.diff(padded[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(words)], strict=True):
        width = int(padded[order[a]])
        step = max(1, min(WORDS, WORDS * 16 // width))
        for at in range(a, b, step):
            rows = order[at : min(b, at + step)]
            data = np.frombuffer(b"".join((b" " + words[i]).ljust(width, b"\0") for i in rows), dtype=np.uint8)
            yield rows, data.reshape(len(rows), width), lengths[rows]


def forward(pieces: Pieces, words: np.ndarray, table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, list]:
    """Forward sums at each place, scaled; the logs of the scales; the pieces found.

    ``table`` is (pieces, languages); the sums are (words, languages). Sums of a word are
    scaled together whenever the newest is small, so long words don't vanish. A padded
    word's own sum is at its length; what follows it means nothing.
    """
    hashes = pieces.prefixes(words)
    count, length = words.shape
    sums = [np.ones((count, table.shape[1]))]
    scale = np.zeros((count, table.shape[1]))
    found = []
    for stop in range(1, length + 1):
        now = np.zeros((count, table.shape[1]))
        for start in range(max(0, stop - pieces.longest), stop):
            rows, ids = pieces.find(hashes, start, stop)
            if len(rows):
                now[rows] += sums[start][rows] * table[ids]
                found.append((start, stop, rows, ids))
        sums.append(now)
        if length > 24 and stop % 8 == 0:
            small = now.max(axis=1) < 1e-60
            if small.any():
                factor = np.where(small, now.max(axis=1), 1.0)[:, None]
                for at in range(max(0, stop - pieces.longest), stop + 1):
                    sums[at] = sums[at] / factor
                scale += np.log(factor)
    return sums, scale, found


def word_logs(pieces: Pieces, words: list[bytes], table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.zeros((len(words), table.shape[1]))
    for rows, data, lengths in by_length(words):
        sums, scale, _ = forward(pieces, data, table)
        for length in np.unique(lengths):
            own = lengths == length
            out[rows[own]] = np.log(np.maximum(sums[length][own], 1e-300)) + scale[own]
    return out


def expected(pieces: Pieces, words: list[bytes], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, for one language; table is (pieces, 1)."""
    total = np.zeros(len(pieces.pieces))
    for rows, data, lengths in by_length(words):
        count, width = data.shape
        if width > 64:  # rare, and their sums would need scaling: cut them for learning
            parts = [words[i][at : at + 60] for i in rows for at in range(0, len(words[i]), 60)]
            times = np.repeat(counts[rows], -(-(lengths - 1) // 60))
            total += expected(pieces, parts, times, table)
            continue
        _, _, found = forward(pieces, data, table)
        sums = _plain(found, count, width, table)
        back = [np.zeros(count) for _ in range(width + 1)]
        whole = np.zeros(count)
        for length in np.unique(lengths):
            own = lengths == length
            back[length][own] = 1.0
            whole[own] = sums[length][own]
        weight = counts[rows] / np.maximum(whole, 1e-300)
        for start, stop, r, ids in reversed(found):
            chance = back[stop][r] * table[ids, 0]
            back[start][r] += chance
            total += np.bincount(ids, sums[start][r] * chance * weight[r], len(total))
    return total


def _plain(found: list, count: int, length: int, table: np.ndarray) -> list[np.ndarray]:
    """Forward sums without scales; a double holds them for words of up to 64 bytes."""
    sums = [np.zeros(count) for _ in range(length + 1)]
    sums[0][:] = 1.0
    for start, stop, r, ids in found:
        sums[stop][r] += sums[start][r] * table[ids, 0]
    return sums


def distinct_words(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some texts; for every word of the texts its number and its text's."""
    words, owner = [], []
    for text in texts:
        own = (text or b"").decode("utf-8", "replace").lower().split()
        if own and len(max(own, key=len)) > LONGEST:
            own = [w[at : at + LONGEST] for w in own for at in range(0, len(w), LONGEST)]
        words += own
        owner.append(len(own))
    coded = pa.array(words, pa.string()).dictionary_encode()
    distinct = [w.encode() for w in coded.dictionary.to_pylist()]
    return distinct, coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), owner)


def joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches put together to tables of at least so many rows, but for the last."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


@dataclass
class Model:
    """Piece probabilities per language, and the vocabulary they belong to."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray
    path: str

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Log of prior times probability, per text and language."""
        words, number, owner = distinct_words(texts)
        logs = word_logs(pieces_of(self.path), words, self.table) if words else np.zeros((0, len(self.languages)))
        out = np.tile(np.log(self.prior), (len(texts), 1))
        for k in range(len(self.languages)):
            out[:, k] += np.bincount(owner, logs[number, k], len(texts)) if len(number) else 0.0
        return out

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """The best language of each text and its probability; ``und`` and 0 without a letter."""
        names, probabilities = [], []
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        for text, logs in zip(texts, self.scores(texts), strict=True):
            if text is None or not _LETTER.search(text.decode("utf-8", "replace")):
                names.append(UNDETERMINED)
                probabilities.append(0.0)
            else:
                best = int(logs.argmax())
                names.append(self.languages[best])
                probabilities.append(float(1 / np.exp(logs - logs[best]).sum()))
        return names, probabilities


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    path: str = VOCABULARY,
    rounds: int = ROUNDS,
) -> Model:
    """A model from all documents that are not held out and have a language.

    Words are counted per language, map-side first; each round sums expected piece counts
    over the distinct words. The driver holds one table of pieces by languages. Priors are
    equal. Without such documents the model has no languages.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = slim(docs, _id=id_column, _text=text_column, lang=lang_column).where("lang is not null and _text is not null")
    rows = rows.where(~held_out(F.col("_id"))).select(F.col("lang").cast("string"), F.col("_text").cast("binary"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 1, BATCH):
            langs = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                words, number, _ = distinct_words([t for t, x in zip(texts, langs, strict=True) if x == lang])
                n = np.bincount(number, minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()), pa.array(n, pa.int64())],
                    names=["lang", "word", "n"],
                )

    words = rows.mapInArrow(count, "lang string, word binary, n long")
    words = materialise(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
    pieces = pieces_of(path)
    table = np.full((len(pieces.pieces), len(languages)), 1.0 / len(pieces.pieces))
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast(table)

        def uses(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value)
            for table in joined(batches, LEARN_WORDS):
                langs = pd.Series(table.column(0).to_pylist())
                words = np.array(table.column(1).to_pylist(), dtype=object)
                n = table.column(2).to_numpy().astype(float)
                for lang, at in langs.groupby(langs).indices.items():
                    k = languages.index(lang)
                    total[:, k] += expected(pieces_of(path), list(words[at]), n[at], shared.value[:, k : k + 1])
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(total[piece, lang])],
                names=["piece", "lang", "n"],
            )
            tidy()

        sums = words.mapInArrow(uses, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        found = sums.toArrow()
        table = np.full_like(table, SMOOTH)
        table[found.column(0).to_numpy(), found.column(1).to_numpy()] += found.column(2).to_numpy()
        table /= table.sum(axis=0)
    return Model(languages, np.full(len(languages), 1.0 / max(1, len(languages))), table, path)


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``lang_pred`` and ``score``.

    The score is the probability of the language found, all being equally likely before. A
    null text, or one without a letter, is ``und`` with score 0. Repeated rows stay.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 2, BATCH):
            names, scores = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["_id", "_hash", "lang_pred", "score"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _hash long, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: Model, least_score: float = LEAST_SCORE, text_column: str = "text"
) -> DataFrame:
    """The documents whose language is found with at least ``least_score``, with their own columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for start, stop in parts(texts, BATCH):
                names, scores = shared.value.predict(texts[start:stop].cast(pa.binary()).to_pylist())
                out += [n != UNDETERMINED and s >= least_score for n, s in zip(names, scores, strict=True)]
            yield pa.array(out, pa.bool_())
        tidy()

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    kept = docs.select(whole).where(F.arrow_udf(keep, "boolean")(F.col("doc").getField(text_column)))
    return kept.select("doc.*")
