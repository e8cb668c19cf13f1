"""Near-duplicate vectors, by tiled comparison in principal-component order.

Vectors are turned into the axes of their principal components. A few leading axes then
hold most of any product, and Cauchy-Schwarz bounds the rest by the norms of what is left:
``x.y <= leading product + |rest of x| |rest of y|``. Vectors are sorted into tiles by
their leading coordinates. Two tiles whose boxes are too far apart have no pair to link;
for the others these bounds are worked out in single precision, block by block, as products
of vectors that hold the leading coordinates and the norm. Blocks with many pairs above the
threshold are taken to more axes. What comes out closer to the threshold than rounding goes
is verified in double precision on the vectors as they came.

A tile is a file in the shared folder, and tasks read the tiles whose pairs they compare: on
data without structure every pair of tiles is compared, and what is written must not grow
with their number. The pairs of a square of tiles are compared by one task, so that a tile
is read once for several pairs.

Equal vectors are one class from the start. A task gives back one row per linked class, its
links counted and a local root, never the pairs.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import components, ship, slim, tidy
from sediment.llm.files import Output, reading
from sediment.session import materialise, scratch_path

THRESHOLD = 0.95
#: Classes of a tile, about, and bytes of their vectors, at most.
TILE, TILE_BYTES = 8192, 8 << 20
#: Classes on either side of the products held at a time.
BLOCK = 512
#: Tiles on either side of the square of pairs that a task compares, at most; bytes of tiles it keeps at hand.
SIDE, AT_HAND = 8, 96 << 20
#: Vectors that the axes are fitted on (any axes are right, these are fast), and axes of a tile's box.
SAMPLE, BOX = 8192, 4
#: Axes after which bounds are looked at.
STEPS = (24, 64, 128, 256, 512)
#: Rows of results that a task gathers before it sums them up.
GATHERED = 1 << 20
_SLACK = 1e-9


def sound(vector: Column) -> Column:
    """Whether a vector can link: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal axes as columns, by falling share of the sample's squares."""
    u = unit(sample)
    values, vectors = np.linalg.eigh(u.T @ u)
    return vectors[:, np.argsort(-values)]


def splits(leading: np.ndarray, tiles: int) -> list[tuple[int, float]]:
    """A balanced binary tree over the sample, as a heap: axis and value that each inner node splits at."""
    depth = max(0, int(np.ceil(np.log2(max(1, tiles)))))
    tree, parts = [], [leading]
    for _ in range(depth):
        following = []
        for part in parts:
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
            at = float(np.median(part[:, axis])) if len(part) else 0.0
            tree.append((axis, at))
            low = part[:, axis] < at
            following += [part[low], part[~low]]
        parts = following
    return tree


def leaf(leading: np.ndarray, tree: list[tuple[int, float]]) -> np.ndarray:
    """The leaf each row falls into, from 0."""
    place = np.zeros(len(leading), dtype=np.int64)
    if not tree:
        return place
    axis, at = np.array([t[0] for t in tree]), np.array([t[1] for t in tree])
    while (place < len(tree)).any():
        right = leading[np.arange(len(leading)), axis[place]] >= at[place]
        place = 2 * place + 1 + right
    return place - len(tree)


class Side:
    """Vectors as they came and, in single precision, turned into the axes, with the norms left after each of the steps."""

    def __init__(self, raw: np.ndarray, basis: np.ndarray):
        turned = unit(raw.astype(np.float64)) @ basis
        width = basis.shape[1]
        self.raw, self.turned = raw, turned.astype(np.float32)
        self.stops = [s for s in STEPS if s < width] + [width]
        self.rests = [np.sqrt((turned[:, s:] ** 2).sum(axis=1, keepdims=True)).astype(np.float32) for s in self.stops]
        self.first = np.hstack((self.turned[:, : self.stops[0]], self.rests[0]))
        starts = range(0, len(raw), BLOCK)
        lead = self.first[:, :-1].astype(np.float64)
        self.boxes = [(x.min(axis=0), x.max(axis=0)) for x in (lead[k : k + BLOCK] for k in starts)]
        self.bytes = sum(x.nbytes for x in (self.raw, self.turned, self.first, *self.rests))

    def upto(self, step: int, rows: slice) -> np.ndarray:
        """Coordinates before a stop and the norm of the rest: the product of two such rows bounds the cosine."""
        if not step:
            return self.first[rows]
        return np.hstack((self.turned[rows, : self.stops[step]], self.rests[step][rows]))


def _links(a: Side, b: Side, threshold: float, upper: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` whose cosine is at least the threshold, block by block; ``upper``: only ``i < j``."""
    # Twice what rounding to single precision can add up to in a product of unit vectors.
    slack = (a.turned.shape[1] + 8) * 2.0**-23
    bar, reach = threshold - slack, 2 - 2 * threshold + slack
    last = len(a.stops) - 1
    for m, (low, high) in enumerate(a.boxes):
        for k, (low2, high2) in enumerate(b.boxes):
            if upper and k < m:
                continue
            gap = np.maximum(np.maximum(low - high2, low2 - high), 0.0)
            if gap @ gap > reach:
                continue
            rows, others, step = slice(m * BLOCK, (m + 1) * BLOCK), slice(k * BLOCK, (k + 1) * BLOCK), 0
            while True:
                bound = a.upto(step, rows) @ b.upto(step, others).T
                at = np.flatnonzero(bound >= bar) if bound.max() >= bar else ()
                if step == last or len(at) * 16 < bound.size:
                    break
                step += 1
            for start in range(0, len(at), 1 << 16):  # a bounded number of pairs at a time
                some = at[start : start + (1 << 16)]
                i, j = some // bound.shape[1] + rows.start, some % bound.shape[1] + others.start
                total = bound.ravel()[some] if step == last else np.einsum("ij,ij->i", a.turned[i], b.turned[j])
                near = (total >= bar) & (i < j) if upper else total >= bar
                i, j, total = i[near], j[near], total[near]
                keep = total >= threshold + slack
                if len(close := np.flatnonzero(~keep)):
                    ours, theirs = (unit(x.astype(np.float64)) for x in (a.raw[i[close]], b.raw[j[close]]))
                    keep[close] = np.einsum("ij,ij->i", ours, theirs) >= threshold
                if keep.any():
                    yield i[keep], j[keep]


def linked(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` whose cosine is at least the threshold."""
    none = np.empty(0, dtype=np.int64)
    i, j = zip((none, none), *_links(Side(a, basis), Side(b, basis), threshold), strict=True)
    return np.concatenate(i), np.concatenate(j)


def roots(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def joined(node: np.ndarray, links: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per node: its links summed, and a root that all nodes have that rows connect."""
    every, at = np.unique(np.concatenate((node, root)), return_inverse=True)
    total = np.bincount(at[: len(node)], links, len(every)).astype(np.int64)
    root = every[roots(len(every), at[: len(node)], at[len(node) :])]
    return every[total > 0], total[total > 0], root[total > 0]


def _matrix(column: pa.Array) -> np.ndarray:
    """An array column of equal lengths as a matrix, single precision left as it is."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(values, dtype="<f4" if values.dtype == np.float32 else "<f8").reshape(len(column), -1)


def _write(folder: str, nodes: np.ndarray, sizes: np.ndarray, raw: np.ndarray) -> str:
    """Writes a tile, and tells its name. No other attempt has that name, and only names in rows that count are read."""
    out = Output(folder, "tile")
    for values in (np.array([*raw.shape, raw.itemsize]), nodes, sizes):
        out.write(values.astype("<i8").tobytes())
    out.write(raw.tobytes())
    out.close()
    return out.temporary


def _read(folder: str, name: str, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, Side]:
    """Nodes, sizes and vectors of a tile."""
    with reading(f"{folder}/{name}") as file:
        data = file.read()
    rows, width, item = (int(x) for x in np.frombuffer(data, "<i8", 3))
    numbers = np.frombuffer(data, "<i8", 2 * rows, 24)
    raw = np.frombuffer(data, f"<f{item}", rows * width, 24 + 16 * rows).reshape(rows, width)
    return numbers[:rows], numbers[rows:], Side(raw, basis)


def _compare(classes: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``links`` (weighted), ``root`` per linked class and task, for vectors of one length."""
    spark = classes.sparkSession
    count = classes.count()
    order = F.xxhash64("embedding", "node")
    picked = classes.where(F.pmod(order, F.lit(max(1, count // (2 * SAMPLE)))) == 0).orderBy(order).limit(SAMPLE)
    sample = _matrix(picked.select("embedding").toArrow().column(0).combine_chunks()).astype(np.float64)
    basis = axes(sample)
    most = max(1, min(TILE, TILE_BYTES // (8 * sample.shape[1])))
    # The tree goes on below the tiles, which keeps what is close together within a tile.
    depth = max(0, int(np.ceil(np.log2(max(1, -(-count // most))))))
    deep = max(depth, min(int(np.log2(SAMPLE)) - 2, int(np.ceil(np.log2(max(1, -(-count // BLOCK)))))))
    tree = splits((unit(sample) @ basis)[:, :BOX], 1 << deep)
    shared = spark.sparkContext.broadcast((basis, tree))

    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, inner = shared.value
        for vectors in batches:
            if len(vectors):
                leading = (unit(_matrix(vectors).astype(np.float64)) @ own)[:, :BOX]
                yield pa.array(leaf(leading, inner))
            else:
                yield pa.array([], pa.int64())

    # A leaf that holds more than a tile, its bounds being a sample's, is dealt out by hash.
    placed = classes.withColumn("fine", F.arrow_udf(place, "long")("embedding"))
    placed = placed.withColumn("leaf", F.shiftright("fine", deep - depth))
    parts = materialise(placed.groupBy("leaf").agg(F.ceil(F.count("*") / most).alias("parts")), "tile-parts")
    tiled = placed.join(parts, "leaf", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    tiled = tiled.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    folder = scratch_path(spark, "tiles")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("fine", "ascending"), ("node", "ascending")])
        raw = _matrix(table.column("embedding").combine_chunks())
        leading = (unit(raw.astype(np.float64)) @ shared.value[0])[:, :BOX]
        name = _write(folder, table.column("node").to_numpy(), table.column("n").to_numpy(), raw)
        box = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (leading.min(axis=0), leading.max(axis=0))]
        keys = [table.column(c)[:1] for c in ("leaf", "parts", "part")]
        return pa.table([*keys, *box, pa.array([name])], names=["leaf", "parts", "part", "low", "high", "name"])

    kept = tiled.select("leaf", "parts", "part", "fine", "node", "n", "embedding")
    schema = "leaf long, parts long, part long, low array<double>, high array<double>, name string"
    tiles = kept.groupBy("leaf", "parts", "part").applyInArrow(pack, schema)
    tiles = materialise(tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")

    # Linked unit vectors differ by at most this much in all axes together.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + _SLACK
    # Pairs of close boxes share cells of a grid; the greatest of the lowest cells is one of these.
    axis = range(min(2, basis.shape[0]))
    first = [F.floor((F.col("low")[k] - reach / 2) / reach) for k in axis]
    stop = [F.floor((F.col("high")[k] + reach / 2) / reach) for k in axis]
    cells = tiles.select("tile", "low", "high", "name", "leaf", "parts", "part", *[x.alias(f"f{k}") for k, x in enumerate(first)])
    for k in axis:
        cells = cells.withColumn(f"c{k}", F.explode(F.sequence(first[k], stop[k])))
    names = [f"c{k}" for k in axis]
    other = cells.select(*names, *[F.col(c).alias(f"{c}2") for c in cells.columns if c not in names])
    pairs = cells.join(other.hint("merge"), names).where("tile <= tile2")
    for k in axis:
        pairs = pairs.where(F.col(f"c{k}") == F.greatest(f"f{k}", f"f{k}2"))
    gaps = F.zip_with(
        F.zip_with("low", "high2", lambda x, y: x - y),
        F.zip_with("low2", "high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    far = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    carried = ["leaf", "parts", "part", "name"]
    pairs = pairs.where(far <= reach * reach).select(*carried, *[f"{c}2" for c in carried])
    pairs = materialise(pairs, "tile-pairs")
    many, tasks = pairs.count(), 4 * spark.sparkContext.defaultParallelism
    bits = int(np.log2(min(SIDE, max(1.0, (many / tasks) ** 0.5))))

    def square(end: str) -> list[Column]:
        alone = F.col(f"parts{end}") == 1
        side = [F.when(alone, F.shiftright(f"leaf{end}", bits)).otherwise(F.col(f"leaf{end}"))]
        side += [F.when(alone, F.lit(-1)).otherwise(F.shiftright(f"part{end}", bits))]
        return [x.alias(f"s{k}{end}") for k, x in enumerate(side)]

    squares = pairs.select(*square(""), *square("2"), "name", "name2")
    dealt = max(1, min(many, max(tasks, many >> 2 * bits)))
    key = ["s0", "s1", "s02", "s12"]
    work = squares.repartitionByRange(dealt, *key).sortWithinPartitions(*key, "name", "name2").select("name", "name2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[str, tuple[np.ndarray, np.ndarray, Side]] = OrderedDict()
        gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def tile(name: str) -> tuple[np.ndarray, np.ndarray, Side]:
            if name not in known:
                known[name] = _read(folder, name, shared.value[0])
                while len(known) > 2 and sum(x[2].bytes for x in known.values()) > AT_HAND:
                    known.popitem(last=False)
            known.move_to_end(name)
            return known[name]

        def rows() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*gathered, strict=True)]
            gathered.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in joined(*columns)], names=["node", "links", "root"])

        for batch in batches:
            for name, name2 in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, n, a = tile(name)
                theirs, m, b = tile(name2)
                same = name == name2
                every, shift = (own, 0) if same else (np.concatenate((own, theirs)), len(own))
                links, ends = np.zeros(len(every)), []
                for i, j in _links(a, b, threshold, upper=same):
                    links += np.bincount(i, m[j], len(every)) + np.bincount(j + shift, n[i], len(every))
                    if len(i) > len(every):  # no more than one end per row goes on
                        root = roots(len(every), i, j + shift)
                        i = np.flatnonzero(root != np.arange(len(every)))
                        ends.append((i, root[i]))
                    else:
                        ends.append((i, j + shift))
                if ends:
                    root = roots(len(every), *(np.concatenate(x) for x in zip(*ends, strict=True)))
                    at = np.flatnonzero(links)
                    gathered.append((every[at], links[at].astype(np.int64), every[root[at]]))
                if sum(len(x[0]) for x in gathered) > GATHERED:
                    summed = rows()
                    if summed.num_rows > GATHERED // 2:
                        yield summed
                    else:
                        gathered.append(tuple(c.to_numpy() for c in summed.columns))
        if gathered:
            yield rows()
        known.clear()
        tidy()

    return work.mapInArrow(compare, "node long, links long, root long")


def key(vector: Column) -> Column:
    """A number that equal vectors share, whatever the sign of their zeros."""
    return F.xxhash64(vector)


def neighbours(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors link at a cosine of at least ``threshold`` (over 0), which makes equal vectors
    linked. Those that are null, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths with one another; they are components of
    their own. A null id is larger than any. No rows give no rows; other columns are not kept.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    spark = vectors.sparkSession
    ship(spark)
    rows = slim(vectors, vec_id=id_column, embedding=vector_column)
    good = rows.where(sound(F.col("embedding")))
    classes = good.groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = classes.withColumn("node", F.monotonically_increasing_id()).withColumn("key", key(F.col("embedding")))
    classes = materialise(classes, "vector-classes")
    lengths = [r[0] for r in classes.select(F.size("embedding")).distinct().orderBy(F.size("embedding")).collect()]
    found = spark.createDataFrame([], "node long, links long, root long")
    for length in lengths:
        found = found.union(_compare(classes.where(F.size("embedding") == length), threshold))
    found = materialise(found, "vector-links")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    whole = classes.select("node", "key", "n", "first").join(degree, "node", "left")
    whole = whole.join(named.withColumnRenamed("root", "named"), "node", "left").select(
        "node",
        F.col("key").alias("own"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("named", "node").alias("root"),
        "first",
    )
    smallest = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = materialise(whole.join(smallest, "root").select("node", "own", "n_links", "component_id"), "vector-classes")
    keyed = rows.withColumn("key", F.when(sound(F.col("embedding")), key(F.col("embedding"))))
    on = F.col("key") == F.col("own")
    if not classes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():  # else keys will do
        whole = whole.join(classes.select("node", F.col("embedding").alias("vector")), "node")
        on = on & (F.col("embedding") == F.col("vector"))
    matched = keyed.join(whole, on, "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return matched.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
