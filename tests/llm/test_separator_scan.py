"""Token counts against tokenising each text, and the scan against splitting whole files."""

import random

import numpy as np
import pytest

from sediment.llm import separator_scan as scan
from sediment.session import scratch_path

SCHEMA = "doc_id long, text string, name string, ordinal string, start string"


def test_counts_equal_direct_tokenising(spark, tables):
    docs = tables("documents")
    wanted = sorted((r["doc_id"], len(scan.tokens(r["text"].encode()))) for r in docs.collect())
    assert sorted((r["_id"], r["n_tokens"]) for r in scan.count(docs).collect()) == wanted


@pytest.mark.parametrize("width", [2, 4])
def test_scan_equals_splitting(spark, tmp_path, width):
    draw = random.Random(1)
    dtype, rows, wanted = {2: "<u2", 4: "<u4"}[width], [], []
    cases = [[], [9], [9, 9, 9], [1, 2, 3], [1, 9], [9, 1], [draw.randrange(10) for _ in range(997)], [1] * 500 + [9] + [2] * 300]
    for k, ids in enumerate(cases):
        data = np.array(ids, dtype=dtype).tobytes()
        (tmp_path / f"f{k}").write_bytes(data)
        rows.append((f"f{k}", len(data)))
        start, ordinal = 0, 0
        for i, x in enumerate(ids):
            if x == 9:
                wanted.append((f"f{k}", ordinal, start, i - start, True))
                start, ordinal = i + 1, ordinal + 1
        if start < len(ids):
            wanted.append((f"f{k}", ordinal, start, len(ids) - start, False))
    files = spark.createDataFrame(rows, "name string, bytes long")
    for block in (width, 4 * width, 64 * width, 1 << 20):
        found = scan.scan(f"file://{tmp_path}", files, 9, width, block).collect()
        assert sorted(tuple(r) for r in found) == sorted(wanted)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "<|endoftext|>"), (4, "x " * 40_000), (5, "same"), (5, "same")]
    frame = spark.createDataFrame([(*r, "n", "o", "s") for r in rows], SCHEMA)
    found = scan.count(frame).collect()
    wanted = [(r[0], len(scan.tokens((r[1] or "").encode()))) for r in rows]
    assert sorted(((r["_id"], r["n_tokens"]) for r in found), key=str) == sorted(wanted, key=str)
    assert scan.count(frame.limit(0)).collect() == []


def test_files_hold_ids_and_nothing_else(spark):
    frame = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string").coalesce(1)
    folder = scratch_path(spark, "tokens-test")
    files, places = scan.write(frame, folder)
    row = files.first()
    with scan.reading(f"{folder}/{row['name']}") as file:
        ids = np.frombuffer(file.read(), "<u2").tolist()
    assert ids == [*scan.tokens(b"one two"), scan.SEPARATOR, *scan.tokens(b"three"), scan.SEPARATOR]
    assert row["bytes"] == 2 * len(ids) and places.count() == 2
