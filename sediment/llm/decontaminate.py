"""Benchmark passages in documents, by the q-gram lemma over diagonal bands.

Benchmark items are cut into overlapping windows. A window of m characters that occurs in
a document with at most k edits shares at least m + 1 - q - qk q-grams with it, and all of
them lie within k diagonals (place in the document less place in the item). So shared
q-grams are counted in bands of 2k + 1 diagonals that overlap by half; where a band
reaches the bound, the region is verified: by comparison if it holds the window as it is,
by banded alignment otherwise.

Texts are compared in lower case (A-Z) with runs of white space as one blank, as UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import packed, ship, slim, small_batches, text_hash
from sediment.session import materialise

Q = 7
#: Bytes of a window and between windows; edits allowed per byte. A copied part of WINDOW less
#: its edits holds a window within its budget wherever it starts, as STRIDE is at most that budget.
WINDOW, STRIDE, EDIT_RATE = 113, 10, 0.11
#: Bytes in normal form of the shortest item that is looked for.
SHORTEST = 12
#: Bytes of benchmark text that one broadcast index holds; more is done in blocks.
BLOCK_BYTES = 8 << 20
#: Bytes of a document that are searched at a time, and pairs of q-grams held at a time.
CHUNK, PAIRS = 1 << 21, 1 << 20
#: Bits of a table of the q-grams that occur, and at most of a table of counts.
_BITS, _COUNT_BITS = 22, 21
#: Equal items whose rows are made together.
RUN_ROWS = 4096

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[_SPACE] = 0x20


def normal(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text's bytes in normal form, and the place of each in the text."""
    raw = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    blank = raw == 0x20
    keep = np.flatnonzero(~(blank & np.concatenate(([True], blank[:-1]))))
    if len(keep) and raw[keep[-1]] == 0x20:
        keep = keep[:-1]
    return raw[keep], keep


def grams(data: np.ndarray) -> np.ndarray:
    """64 bits that tell q-grams (q from 4 to 8) apart, by place."""
    if len(data) < Q:
        return np.empty(0, dtype=np.uint64)
    two = data[:-1].astype(np.uint32) | (data[1:].astype(np.uint32) << 8)
    four = (two[:-2] | (two[2:] << np.uint32(16))).astype(np.uint64)
    # The first four bytes and the last four, which may share some.
    mixed = (four[: len(four) - (Q - 4)] | (four[Q - 4 :] << np.uint64(8 * (Q - 4)))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Window:
    """A part of an item, with its edit budget and the q-grams it must share."""

    item: int
    start: int
    data: bytes
    edits: int
    least: int

    @cached_property
    def places(self) -> dict[int, int]:
        """A bit per place of each byte."""
        found: dict[int, int] = {}
        for i, byte in enumerate(self.data):
            found[byte] = found.get(byte, 0) | 1 << i
        return found

    def near(self, region: bytes) -> bool:
        """Whether some part of the region is within the budget: edit distance, a column at a time as bits."""
        full = (1 << len(self.data)) - 1
        last = 1 << (len(self.data) - 1)
        up, down, cost, places = full, 0, len(self.data), self.places
        for byte in region:
            same = places.get(byte, 0)
            across = (((same & up) + up) ^ up) | same
            same |= down
            more, less = down | (full & ~(across | up)), up & across
            if more & last:
                cost += 1
            elif less & last:
                cost -= 1
                if cost <= self.edits:
                    return True
            more, less = (more << 1) & full, (less << 1) & full
            up, down = less | (full & ~(same | more)), more & same
        return False


class Index:
    """The q-grams of a bounded block of items, and the items' windows."""

    def __init__(self, items: list[bytes], edit_rate: float = EDIT_RATE):
        self.windows: list[Window] = []
        keys, owners, places = [], [], []
        self.per_item: list[list[int]] = []
        for item, text in enumerate(items):
            data, _ = normal(text)
            own = []
            size = min(WINDOW, len(data))
            # A budget that leaves no q-gram to share would prove nothing.
            edits = min(int(size * edit_rate), (size - Q) // Q)
            if size >= SHORTEST:
                for start in sorted({*range(0, len(data) - size + 1, STRIDE), len(data) - size}):
                    own.append(len(self.windows))
                    least = size + 1 - Q - Q * edits
                    self.windows.append(Window(item, start, data[start : start + size].tobytes(), edits, least))
                found = grams(data)
                keys.append(found)
                owners.append(np.full(len(found), item))
                places.append(np.arange(len(found)))
            self.per_item.append(own)
        keys = np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = (np.concatenate(owners) if owners else np.empty(0, dtype=np.int64))[order]
        self.places = (np.concatenate(places) if places else np.empty(0, dtype=np.int64))[order]
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self.keys >> np.uint64(64 - _BITS)] = True
        self.starts = np.array([w.start for w in self.windows], dtype=np.int64)
        self.sizes = np.array([len(w.data) for w in self.windows], dtype=np.int64)
        self.edits = np.array([w.edits for w in self.windows], dtype=np.int64)
        self.least = np.array([w.least for w in self.windows], dtype=np.int64)
        self.first = np.array([own[0] if own else 0 for own in self.per_item], dtype=np.int64)
        self.many = np.array([len(own) for own in self.per_item], dtype=np.int64)

    def regions(self, data: np.ndarray) -> set[tuple[int, int]]:
        """Window and band start of every band that shares enough q-grams with its window."""
        codes = grams(data)
        at = np.flatnonzero(self.seen[codes >> np.uint64(64 - _BITS)])
        low = np.searchsorted(self.keys, codes[at], "left")
        high = np.searchsorted(self.keys, codes[at], "right")
        at, low, n = at[high > low], low[high > low], (high - low)[high > low]
        fewest = self.least.min(initial=len(data))
        if n.sum() < fewest or (enough := self._crowded(at, low, n, fewest)) is None:
            return set()
        counted: dict[int, int] = {}
        for a, b in _slices(n):
            place, key = _expand(low[a:b], n[a:b])
            diagonal = at[a:b][place] - self.places[key]
            kept = enough(diagonal, self.owners[key])
            self._count(diagonal[kept], key[kept], counted)
        return {divmod(key, 1 << 40) for key, n in counted.items() if n >= self.least[key >> 40]}

    def _crowded(self, at: np.ndarray, low: np.ndarray, n: np.ndarray, fewest: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray] | None:
        """Tells which q-grams lie in a band that shares enough with their whole item, or seems to; None: none do.

        All windows of an item have one size, and a window shares no more than its item does.
        Counts of bands that meet in the table add up, which only lets more through.
        """
        bits = min(_COUNT_BITS, max(10, int(n.sum()).bit_length() + 2))
        table = np.zeros(1 << bits, dtype=np.int64)

        def slots(diagonal: np.ndarray, item: np.ndarray) -> Iterator[np.ndarray]:
            band = diagonal // (self.edits[self.first[item]] + 1) + (item << 40) + (1 << 39)
            for back in (0, 1):
                mixed = (band - back).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                yield (mixed >> np.uint64(64 - bits)).astype(np.int64)

        for a, b in _slices(n):
            place, key = _expand(low[a:b], n[a:b])
            for slot in slots(at[a:b][place] - self.places[key], self.owners[key]):
                table += np.bincount(slot, minlength=len(table))

        if table.max() < fewest:
            return None

        def enough(diagonal: np.ndarray, item: np.ndarray) -> np.ndarray:
            most = np.maximum(*(table[slot] for slot in slots(diagonal, item)))
            return most >= self.least[self.first[item]]

        return enough

    def _count(self, diagonal: np.ndarray, key: np.ndarray, counted: dict[int, int]) -> None:
        # Bands of two steps, one step apart, hold any run of one step of diagonals. A place of
        # the item counts once in a band, however often its q-gram is repeated there.
        number = diagonal // (self.edits[self.first[self.owners[key]]] + 1) + (1 << 29)
        once = np.unique(np.concatenate(((key << 30) + number, (key << 30) + number - 1)))
        key, number = once >> 30, (once & ((1 << 30) - 1)) - (1 << 29)
        item, place = self.owners[key], self.places[key]
        band = number * (self.edits[self.first[item]] + 1) + (1 << 39)
        # Windows of an item start every STRIDE bytes, the last at its end, so few hold a place.
        earliest = np.maximum(0, -(-(place + Q - WINDOW) // STRIDE))
        for k in range(int(-(-WINDOW // STRIDE)) + 2):
            window = np.minimum(earliest + k, self.many[item] - 1)
            repeated = (k > 0) & (earliest + k > self.many[item] - 1)
            window = self.first[item] + window
            inside = (place >= self.starts[window]) & (place + Q <= self.starts[window] + self.sizes[window]) & ~repeated
            keys, n = np.unique((window[inside] << 40) + band[inside], return_counts=True)
            for key, m in zip(keys.tolist(), n.tolist(), strict=True):
                counted[key] = counted.get(key, 0) + m

    def search(self, data: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Item, first and last place in ``data``, and edits of each verified window."""
        text = data.tobytes()
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for w, band in sorted(self.regions(data)):
            window = self.windows[w]
            start = window.start + band - (1 << 39)
            a = max(0, start - window.edits)
            b = min(len(text), start + 2 * window.edits + 2 + len(window.data) + window.edits)
            found = text.find(window.data, a, b)
            if found >= 0:
                hit = (window.item, found, found + len(window.data), 0)
            elif window.edits and window.near(text[a:b]) and (near := align(window.data, text[a:b], window.edits)):
                hit = (window.item, a + near[0], a + near[1], near[2])
            else:
                continue
            if (w, hit[2]) not in best or hit[3] < best[w, hit[2]][3]:
                best[w, hit[2]] = hit
        yield from best.values()


def _slices(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs whose sums stay near PAIRS."""
    if not len(n):
        return
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // PAIRS, prepend=-1))
    yield from zip(cuts, [*cuts[1:], len(n)], strict=True)


def _expand(low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of n keys from low: the run's number, and the key."""
    run = np.repeat(np.arange(len(n)), n)
    return run, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def align(window: bytes, region: bytes, edits: int) -> tuple[int, int, int] | None:
    """Start, stop and edits of the best place of ``window`` in ``region``, within the budget.

    Edit distance with free ends in the region, over the band of diagonals from 0 to
    the difference in length plus the budget; the start is carried with the cheapest path.
    """
    r = np.frombuffer(region, dtype=np.uint8)
    if len(r) + edits < len(window):
        return None
    spread = max(0, len(r) - len(window)) + edits  # diagonals -edits .. spread
    width = spread + edits + 1
    far = edits + 1
    offset = np.arange(width)
    where = offset - edits  # place in the region for row 0
    legal = (where >= 0) & (where <= len(r))
    # Cost and start in one number, so that minima carry both.
    scale = np.int64(len(r) + 2)
    cost = np.where(legal, where, far * scale).astype(np.int64)
    padded = np.concatenate((np.zeros(edits, np.uint8), r, np.zeros(width + 1, np.uint8)))
    valid = np.concatenate((np.zeros(edits, bool), np.ones(len(r), bool), np.zeros(width + 1, bool)))
    for i, byte in enumerate(window):
        # Place j = i + 1 + where after this row; the byte used on the diagonal is j - 1.
        piece, ok = padded[i : i + width], valid[i : i + width]
        same = cost + np.where(ok & (piece == byte), 0, scale)
        same = np.where(ok, same, far * scale)
        skip = np.append(cost[1:], far * scale) + scale  # a byte of the window without a place
        now = np.minimum(same, skip)
        # Bytes of the region without a place: from the left, one edit each.
        now = np.minimum.accumulate(now - offset * scale) + offset * scale
        place = i + 1 + where
        now = np.where((place >= 0) & (place <= len(r)), now, far * scale)
        cost = np.minimum(now, far * scale)
        if cost.min() >= far * scale:
            return None
    at = int(cost.argmin())
    spent, start = divmod(int(cost[at]), int(scale))
    return (start, len(window) + at - edits, spent) if spent <= edits else None


def spans(index: Index, text: bytes) -> list[tuple[int, int, int, int, int]]:
    """Item, windows found, fewest edits of one, first and last byte in ``text``, for each item."""
    data, places = normal(text)
    overlap = 2 * WINDOW
    found: dict[int, list[tuple[int, int, int]]] = {}
    for at in range(0, max(1, len(data) - overlap), CHUNK):
        for item, start, stop, edits in index.search(data[at : at + CHUNK + overlap]):
            found.setdefault(item, []).append((at + start, at + stop, edits))
    return [
        (item, len(set(hits)), min(h[2] for h in hits), int(places[min(h[0] for h in hits)]), int(places[max(h[1] for h in hits) - 1]) + 1)
        for item, hits in sorted(found.items())
    ]


def blocks(benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Item, text and number of equal rows, in blocks of about ``block_bytes``, each small enough to broadcast.

    Equal rows are one row of a block, so that they cannot fill it.
    """
    items = slim(benchmark, _item=item_column, _text=text_column).where("_text is not null")
    items = items.select("_item", F.col("_text").cast("binary").alias("_text"))
    items = materialise(items.groupBy("_item", "_text").agg(F.count("*").alias("n")), "benchmark-items")
    total = items.agg(F.sum(F.length("_text"))).first()[0] or 0
    count = -(-total // block_bytes)
    part = F.pmod(F.xxhash64("_item", "_text"), F.lit(count or 1))
    for block in range(count):
        yield [(r[0], bytes(r[1]), r[2]) for r in items.where(part == block).orderBy("_item", "_text").collect()]


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item found in it.

    ``_id``, ``_hash``, ``_item``, ``windows`` (places verified), ``edits`` (fewest of one),
    ``start`` and ``stop`` (bytes of the text's UTF-8 from the first window to the last).
    Null texts hold nothing; items of fewer than 12 bytes in normal form are not looked for.
    Repeated documents and repeated items each have rows of their own. An empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = slim(docs, _id=id_column, _text=text_column).where("_text is not null")
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))
    kinds = rows.schema["_id"].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"_id {kinds[0]}, _hash long, _item {kinds[1]}, windows long, edits long, start long, stop long, copies long"
    result = spark.createDataFrame([], schema)
    for block in blocks(benchmark, item_column, item_text_column, block_bytes):
        shared = spark.sparkContext.broadcast((Index([text for _, text, _ in block]), [(item, n) for item, _, n in block]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            for batch, texts in small_batches(batches, 2):
                at, found = [], []
                for i, text in enumerate(texts):
                    for hit in spans(index, text):
                        at.append(i)
                        found.append(hit)
                if at:
                    own = [c.take(pa.array(at)) for c in (batch.column(0), batch.column(1))]
                    items = pa.array([names[h[0]][0] for h in found], type=item_type)
                    rest = [pa.array([h[k] for h in found], pa.int64()) for k in (1, 2, 3, 4)]
                    copies = pa.array([names[h[0]][1] for h in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([*own, items, *rest, copies], names=names_out)

        names_out = ["_id", "_hash", "_item", "windows", "edits", "start", "stop", "copies"]
        item_type = pa.string() if kinds[1] == "string" else pa.int32() if kinds[1] == "int" else pa.int64()
        result = result.union(rows.mapInArrow(run, schema))
    # Equal items were searched once; runs keep the arrays short.
    last, run_rows = F.col("copies") - 1, F.lit(RUN_ROWS).cast("long")
    result = result.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), last, run_rows)))
    result = result.withColumn("nth", F.explode(F.sequence("first", F.least(last, F.col("first") + run_rows - 1))))
    return result.drop("copies", "first", "nth")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings
) -> DataFrame:
    """The documents in which no item is found, with their own columns, repeated rows included."""
    found = matches(docs, benchmark, id_column, text_column, **settings)
    bad = materialise(found.select("_id", "_hash").distinct(), "contaminated")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_hash") == F.col("_hash"))
    return packed(docs, id_column, text_column).join(bad, on, "left_anti").select("doc.*")
