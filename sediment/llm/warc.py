"""WARC archives: a sharded writer whose files depend on the records alone, and a reader.

Records are range-sorted by page id and payload digest into shards of similar size; the
bounds come from a sample picked by hash, so the same records give the same shards. A
shard is written in order, one gzip member per record, and rolled to a new file at a
compressed size. Ids, lengths, dates and digests in the headers are made anew. Files
appear under their names only by the commit of their manifest (see ``files``).

Of records with equal payloads the one of smallest page id is written in full and the
others as revisits. Who that is comes from one row per digest, combined before the
shuffle; a revisit's row then travels to its shard next to its record, so payloads move
once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import ship, slim
from sediment.llm.files import Output, commit, reading
from sediment.session import materialise, scratch_path

#: Payload bytes of a shard and compressed bytes of a file.
SHARD_BYTES, ROLL_BYTES = 64 << 20, 16 << 20
#: Shards grow beyond SHARD_BYTES rather than number more than this: their bounds go to every task.
MOST_SHARDS = 20_000
SAMPLE_PER_SHARD = 16
DATE = "2026-01-01T00:00:00Z"
LEVEL = 6
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A whole record; fields of value None are left out."""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Date", DATE),
        *fields,
        ("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())),
        ("Content-Length", str(len(block))),
    ]
    lines = [f"{name}: {value}".encode() for name, value in fields if value is not None]
    return b"\r\n".join([VERSION, *lines, b"", block, b"", b""])


def member(data: bytes) -> bytes:
    """One gzip member; its header holds no time."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def safe_uri(url: str | None) -> str | None:
    """The address with what would break a header line percent-encoded."""
    if url is None:
        return None
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_id(page_id: int | None, digest: str, repeat: int) -> str:
    seed = hashlib.sha1(f"{page_id}|{digest}|{repeat}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, repeat: int, refers_to: int | None, revisit: bool
) -> bytes:
    """A response with its payload, or a revisit with the response's headers only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Record-ID", record_id(page_id, digest, repeat)),
        ("WARC-Target-URI", safe_uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", None if page_id is None else str(page_id)),
    ]
    if not revisit:
        return record("response", fields, head + payload)
    fields += [
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", record_id(refers_to, digest, 0)),
        ("X-Refers-To-Page-Id", None if refers_to is None else str(refers_to)),
    ]
    return record("revisit", fields, head)


def _key(page_id: int | None, digest: str) -> tuple:
    return (page_id is not None, page_id or 0, digest)


def shard_bounds(slims: DataFrame, shard_bytes: int) -> list[tuple]:
    """Smallest keys of all shards but the first, from a sample whose rows their hashes pick.

    The sample holds about SAMPLE_PER_SHARD rows per shard; its payload bytes are cut evenly.
    """
    count, total = slims.agg(F.count("*"), F.sum("bytes")).first()
    shards = min(MOST_SHARDS, -(-(total or 0) // shard_bytes))
    if shards <= 1:
        return []
    every = max(1, count // (shards * SAMPLE_PER_SHARD))
    picked = slims.where(F.pmod(F.xxhash64("digest", "page_id"), F.lit(every)) == 0).select("page_id", "digest", "bytes")
    keys = sorted((_key(r[0], r[1]), r[2]) for r in picked.distinct().collect())
    whole, bounds, seen = sum(size for _, size in keys), [], 0
    for key, size in keys:
        if bounds and key == bounds[-1]:
            continue
        if seen and seen * shards >= whole * (len(bounds) + 1):
            bounds.append(key)
        seen += size
    return bounds


def write(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Archives in ``folder``; their manifest: ``name``, ``records``, ``bytes`` and ``sha1`` of each file.

    A null payload is empty. A null page id sorts first, but is the response only where no
    record of the same payload has an id. Rows equal in id and payload follow one another;
    the first is the response if none of smaller id is. A null address is left out. Further
    columns are not kept, and no rows give no files.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = slim(pages, page_id=id_column, url=url_column, payload=payload_column)
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    rows = rows.select("page_id", F.col("url").cast("string"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    slims = materialise(rows.select("page_id", "digest", F.length("payload").cast("long").alias("bytes")), "warc-slim")
    bounds = spark.sparkContext.broadcast(shard_bounds(slims, shard_bytes))
    shards = len(bounds.value) + 1

    @F.pandas_udf("int")
    def shard(ids: pd.Series, digests: pd.Series) -> pd.Series:
        ids = ids.astype("Int64")
        own = bounds.value
        return pd.Series([bisect_right(own, _key(None if i is pd.NA else i, d)) for i, d in zip(ids, digests, strict=True)])

    def placed(frame: DataFrame) -> Column:
        return shard(F.col("page_id"), F.col("digest")) if shards > 1 else F.lit(0)

    heads = slims.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = slims.select("page_id", "digest").distinct().join(heads, "digest")
    known = known.where(~F.col("page_id").eqNullSafe(F.col("first")))
    empty = [F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload")]
    notes = known.select("page_id", *empty, "digest", F.lit(0).alias("kind"), "first")
    records = rows.select("*", F.lit(1).alias("kind"), F.lit(None).cast(known.schema["first"].dataType).alias("first"))
    everything = notes.unionByName(records)
    # By the number itself: a hash of it would put several shards into one task.
    everything = everything.withColumn("shard", placed(everything)).repartitionById(shards, "shard")
    everything = everything.sortWithinPartitions("shard", "page_id", "digest", "kind", "url")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, count, sha, shard_now, number = None, [], 0, None, None, 0
        last, repeat, first, follows = None, 0, None, False

        def close() -> None:
            if out is not None:
                out.close()
                done.append((out.name, out.temporary, count, out.size, sha.hexdigest()))

        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, body, digest, kind, head, part = (c[at].as_py() for c in batch.columns)
                if kind == 0:
                    last, repeat, first, follows = (part, page_id, digest), 0, head, True
                    continue
                if last != (part, page_id, digest):
                    last, repeat, first, follows = (part, page_id, digest), 0, page_id, False
                data = member(
                    page_record(page_id, url, body, base32(bytes.fromhex(digest)), repeat, first, follows or repeat > 0)
                )
                repeat += 1
                if part != shard_now or out.size + len(data) > roll_bytes:
                    close()
                    number = 0 if part != shard_now else number + 1
                    shard_now, count = part, 0
                    out, sha = Output(folder, f"part-{part:05d}-{number:05d}.warc.gz"), hashlib.sha1()
                    info = f"format: WARC File Format 1.1\r\nisPartOf: {out.name}\r\n".encode()
                    fields = [("WARC-Record-ID", record_id(None, out.name, 0)), ("WARC-Filename", out.name)]
                    start = member(record("warcinfo", [*fields, ("Content-Type", "application/warc-fields")], info))
                    out.write(start)
                    sha.update(start)
                out.write(data)
                sha.update(data)
                count += 1
        close()
        names = ["name", "temporary", "records", "bytes", "sha1"]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], names=names)

    columns = ["page_id", "url", "payload", "digest", "kind", "first", "shard"]
    schema = "name string, temporary string, records long, bytes long, sha1 string"
    manifest = materialise(everything.select(*columns).mapInArrow(archive, schema), "warc-written")
    return commit(folder, manifest)


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of every record."""
    while line := stream.readline():
        if line.strip() != VERSION:
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.decode().lower()] = value.strip().decode()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


def read(folder: str, manifest: DataFrame) -> DataFrame:
    """One row per page record of the manifest's archives, which tasks read as streams.

    ``page_id``, ``url``, ``payload`` (null for a revisit), ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` and ``name``. A block or payload that
    does not have its digest is an error.
    """
    ship(manifest.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with reading(f"{folder}/{name}") as file, gzip.GzipFile(fileobj=file) as stream:
                    for fields, block in parse(stream):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        held.append((name, *page(fields, block)))
                        size += len(block)
                        if size > 8 << 20:
                            yield table(held)
                            held, size = [], 0
        if held:
            yield table(held)

    schema = "name string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def table(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    files = manifest.select("name").repartition(manifest.sparkSession.sparkContext.defaultParallelism, "name")
    return files.mapInArrow(rows, schema)


def page(fields: dict[str, str], block: bytes) -> tuple:
    """What ``read`` returns of one record, verified."""
    if "sha1:" + base32(hashlib.sha1(block).digest()) != fields["warc-block-digest"]:
        raise ValueError(f"block of {fields['warc-record-id']} is damaged")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")).partition(b":")[2])
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    number = {k: int(v) if v is not None else None for k, v in ((k, fields.get(k)) for k in ("x-page-id", "x-refers-to-page-id"))}
    return (
        number["x-page-id"],
        fields.get("warc-target-uri"),
        None if revisit else payload,
        length,
        digest,
        fields["warc-type"],
        number["x-refers-to-page-id"],
    )


def archive_folder(pages: DataFrame) -> str:
    """A new folder in the shared one."""
    return scratch_path(pages.sparkSession, "warc")
