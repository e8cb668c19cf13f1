"""Files that tasks write and read themselves, in the folder all executors share.

A task writes under a temporary name that no other attempt uses and returns a manifest
row; Spark keeps the rows of the attempts that count. Renaming by manifest is the commit.
It can be repeated, and readers only open what the manifest names, so files of lost or
repeated attempts are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.session import materialise


# Schemes of Hadoop's file systems for a store, with the store's own.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def own_scheme(uri: str) -> str:
    """The path with the scheme that pyarrow knows its store by."""
    scheme, mark, rest = uri.partition("://")
    return SCHEMES.get(scheme, scheme) + mark + rest


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; a scheme that pyarrow lacks is an error."""
    return fs.FileSystem.from_uri(own_scheme(uri))


def temporary(name: str) -> str:
    return f"_temporary/{uuid.uuid4().hex}-{name}"


class Output:
    """A file being written that knows its size."""

    def __init__(self, folder: str, name: str):
        self.name, self.temporary, self.size = name, temporary(name), 0
        system, path = located(f"{folder}/{self.temporary}")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._stream = system.open_output_stream(path, compression=None)

    def write(self, data: bytes) -> None:
        self._stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._stream.close()


@contextmanager
def reading(uri: str):
    """A seekable file."""
    system, path = located(uri)
    with system.open_input_file(path) as file:
        yield file


def commit(folder: str, manifest: DataFrame) -> DataFrame:
    """Give the files of a written ``manifest`` (``name``, ``temporary``, ...) their names; the manifest, written again."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, old in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = located(f"{folder}/{name}")
                source = located(f"{folder}/{old}")[1]
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, path)
                elif system.get_file_info(path).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"neither {old} nor {name} in {folder}")
            yield batch

    rest = [c for c in manifest.columns if c not in ("name", "temporary")]
    ordered = manifest.select("name", "temporary", *rest)
    return materialise(ordered.mapInArrow(rename, ordered.schema), "manifest").select("name", *[F.col(c) for c in rest])
