"""Moving files within a store, by the file system Spark itself uses for it."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Moves under way at a time; in object stores a move is a copy.
MOVES = 16


def move_files(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Give files other paths, in place of what lies there.

    What an earlier attempt moved already is left; a file found at neither place is an error.
    """
    hadoop, settings = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def move(pair: tuple[str, str]) -> None:
        old, new = (hadoop.Path(path) for path in pair)
        system = old.getFileSystem(settings)
        if not system.exists(old):
            if not system.exists(new):
                raise FileNotFoundError(f"neither {pair[0]} nor {pair[1]}")
            return
        if system.exists(new):
            system.delete(new, False)
        system.mkdirs(new.getParent())
        if not system.rename(old, new):
            raise OSError(f"{pair[0]} could not be moved to {pair[1]}")

    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(move, moves))
