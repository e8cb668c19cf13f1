"""Token counts per document, from flat token files that have no index.

A token file is the documents' token ids one after another, each document ended by an
end-of-document id, and nothing else. Counting reads files in blocks that tasks take on
their own: a block yields the places of its separators, found by one vectorised
comparison. Documents that cross blocks are stitched by a scan over one row per block:
the number of separators before a block numbers its documents, and the last separator
before it is where its first document began.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import ship, slim, small_batches, text_hash
from sediment.llm.files import Output, commit, reading
from sediment.session import materialise, scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of this vocabulary: its splitting pattern and its end-of-document id.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
#: Bytes of an id, and of a block (a multiple of it).
WIDTH = 2
BLOCK_BYTES = 4 << 20

_encodings: dict[str, tiktoken.Encoding] = {}


def ranked_pieces(path: str) -> dict[bytes, int]:
    """Bytes and id of each piece of a file of ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def encoding(path: str = VOCABULARY) -> tiktoken.Encoding:
    """One per process."""
    if path not in _encodings:
        _encodings[path] = tiktoken.Encoding(
            "own", pat_str=PATTERN, mergeable_ranks=ranked_pieces(path), special_tokens={}
        )
    return _encodings[path]


def tokens(text: bytes | None, path: str = VOCABULARY) -> np.ndarray:
    if not text:
        return np.empty(0, dtype=np.uint32)
    return encoding(path).encode_to_numpy(text.decode("utf-8", "replace"), disallowed_special=())


def write(
    docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", path: str = VOCABULARY
) -> tuple[DataFrame, DataFrame]:
    """Token files, one per task; their manifest (``name``, ``bytes``) and who is where.

    The second has ``_id``, ``_hash``, ``name`` and ``ordinal``, the place among the
    documents of the file. Null and empty texts are documents without tokens.
    """
    ship(docs.sparkSession)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))
    kind = rows.schema["_id"].dataType.simpleString()
    dtype = {2: "<u2", 4: "<u4"}[WIDTH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, ordinal = None, 0
        for batch, texts in small_batches(batches, 2):
            out = out or Output(folder, f"part-{TaskContext.get().partitionId():06d}.tokens")
            for text in texts:
                out.write(np.append(tokens(text, path), SEPARATOR).astype(dtype).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([out.name] * n),
                    pa.array(range(ordinal, ordinal + n), pa.int64()),
                    pa.array([out.temporary] * n),
                    pa.array([out.size] * n, pa.int64()),
                ],
                names=["_id", "_hash", "name", "ordinal", "temporary", "bytes"],
            )
            ordinal += n
        if out is not None:
            out.close()

    written = materialise(
        rows.mapInArrow(run, f"_id {kind}, _hash long, name string, ordinal long, temporary string, bytes long"), "tokens"
    )
    files = written.groupBy("name", "temporary").agg(F.max("bytes").alias("bytes"))
    return commit(folder, files), written.select("_id", "_hash", "name", "ordinal")


def scan(
    folder: str, files: DataFrame, separator: int = SEPARATOR, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document of the files: ``name``, ``ordinal``, ``start`` (id), ``n_tokens``, ``ended``.

    ``files`` has ``name`` and ``bytes``. Ids after the last separator are a document that is
    not ended; an empty file has none. The separator does not count as a token.
    """
    if block_bytes % width:
        raise ValueError("blocks must hold whole ids")
    ship(files.sparkSession)
    dtype = {2: "<u2", 4: "<u4"}[width]
    offsets = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(block_bytes).cast("long"))
    blocks = files.where("bytes > 0").select("name", "bytes", F.explode(offsets).alias("offset"))
    blocks = blocks.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4), "name", "offset")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, total, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with reading(f"{folder}/{name}") as file:
                    file.seek(offset)
                    ids = np.frombuffer(file.read(min(block_bytes, total - offset)), dtype=dtype)
                at = np.flatnonzero(ids == separator) + offset // width
                # The first row stands for the block: its ids, not a document.
                places = np.concatenate(([offset // width + len(ids)], at))
                known = np.arange(len(places)) > 1
                starts = np.concatenate(([0, 0], at[:-1] + 1))[: len(places)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(places)),
                        pa.array(np.full(len(places), offset)),
                        pa.array(np.arange(-1, len(at))),
                        pa.array(places),
                        pa.array(starts, mask=~known),
                    ],
                    names=["name", "offset", "nth", "place", "start"],
                )

    schema = "name string, offset long, nth long, place long, start long"
    found = materialise(blocks.mapInArrow(search, schema), "separators")
    is_block = F.col("nth") == -1
    summary = found.groupBy("name", "offset").agg(
        F.max(F.when(is_block, F.col("place"))).alias("stop"),
        F.sum(F.when(is_block, 0).otherwise(1)).alias("n"),
        F.max(F.when(~is_block, F.col("place"))).alias("last"),
    )
    before = Window.partitionBy("name").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    prefix = summary.select(
        "name",
        "offset",
        "stop",
        "n",
        "last",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open"),
        F.lead("offset").over(Window.partitionBy("name").orderBy("offset")).isNull().alias("final"),
    )
    prefix = materialise(prefix, "token-blocks")
    whole = found.where(~is_block).join(prefix.select("name", "offset", "base", "open"), ["name", "offset"]).select(
        "name",
        (F.col("base") + F.col("nth")).alias("ordinal"),
        F.coalesce("start", "open").alias("start"),
        (F.col("place") - F.coalesce("start", "open")).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    begin = F.coalesce(F.col("last") + 1, F.col("open"))
    rest = prefix.where(F.col("final") & (F.col("stop") > begin)).select(
        "name",
        (F.col("base") + F.col("n")).alias("ordinal"),
        begin.alias("start"),
        (F.col("stop") - begin).alias("n_tokens"),
        F.lit(False).alias("ended"),
    )
    return whole.union(rest)


def count(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str = VOCABULARY) -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``name``, ``ordinal``, ``start`` and ``n_tokens``.

    The documents are tokenised into files of the shared folder and counted there. Repeated
    rows are documents of their own, null ids stay null, and no rows give no rows.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    files, places = write(docs, folder, id_column, text_column, path)
    counted = scan(folder, files).drop("ended")
    return places.join(counted, ["name", "ordinal"]).select("_id", "_hash", "name", "ordinal", "start", "n_tokens")
