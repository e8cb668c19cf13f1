"""Packed sequences put together again, and each placement against trying every fill."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sediment.llm import square_packing as packing
from sediment.llm.queries import QUERIES

SCHEMA = "doc_id string, text string, start string, ids string, `a.b` int"
PARTS = [
    "a", "B", " ", "  ", "\n", "\t", "'s", "’", "é", "漢字", "😀", "▁", "\x00", "\xa0", "　", "12", "²",
    "<|endoftext|>", "<|endoftext", "|>", "ing", "the", "\r\n", "́", "!", "...", "'ll",
]


@pytest.fixture(scope="module")
def public():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def coded(public, text):
    return public.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_equal_the_public_tokenizer(public):
    draw = random.Random(7)
    for _ in range(3000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(25)))
        assert packing.ids(text.encode()).tolist() == coded(public, text)


def test_placements_minimise_the_sum_of_squares():
    draw = random.Random(3)
    packer = packing.Packer(window=16)
    counts = [0] * 17
    for k in range(2000):
        size = draw.choice([1, 3, 5, 6, 7, 9, 11])

        def after(fill, size=size):
            changed = list(counts)
            changed[fill] -= fill > 0
            changed[fill + size] += 1
            return sum(n * n for n in changed[1:16])

        fills = [f for f in range(17 - size) if not f or counts[f]]
        best = min(map(after, fills))
        chosen = max(f for f in fills if after(f) == best)
        assert packer.best_fill(size) == chosen
        list(packer.place(packing.Piece(k, 0, np.zeros(size, "<u4"))))
        counts[chosen] -= chosen > 0
        counts[chosen + size] += chosen + size < 16
        assert {f: len(w) for f, w in packer.by_fill.items() if w} == {f: n for f, n in enumerate(counts) if n}


@pytest.mark.parametrize("most_open", [2, 64])
def test_windows_open_stay_bounded_and_nothing_is_lost(most_open):
    draw = random.Random(most_open)
    packer, done, texts = packing.Packer(window=64, most_open=most_open), [], []
    for k in range(500):  # over half a window each: no two fit uncut
        texts.append(np.arange(draw.choice([33, 35, 40, 150, 64])).astype("<u4"))
        done += packer.add(k, texts[-1])
        assert packer.n_open <= most_open
    done += packer.finish()
    for sequence in done:
        size = sum(len(piece.ids) for piece in sequence)
        assert size == 64 or size & (size - 1) == 0
    for k, text in enumerate(texts):
        pieces = sorted((p for s in done for p in s if p.document == k), key=lambda p: p.start)
        assert np.array_equal(np.concatenate([p.ids for p in pieces]), text)
        assert [p.start for p in pieces] == [int(p.ids[0]) for p in pieces]


def check(pieces, texts, public):
    """``texts`` by id; the pieces are rows of the query."""
    by_doc, by_sequence = {}, {}
    for row in pieces:
        by_doc.setdefault(row["doc_id"], []).append(row)
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    assert set(by_doc) == set(texts)
    for key, rows in by_doc.items():
        ids, at = np.array(coded(public, texts[key]), "<u4"), 0
        for row in sorted(rows, key=lambda row: row["start"]):
            assert row["start"] == at and row["length"] > 0 and row["doc_tokens"] == len(ids)
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for row in sorted(rows, key=lambda row: row["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)


def test_query_holds_every_id_once(spark, sf_dir, tables, public):
    texts = {row["doc_id"]: row["text"] for row in tables("documents").collect()}
    check(QUERIES["op12_packing"](spark, sf_dir).collect(), texts, public)


def test_edges(spark, public):
    texts = [("1", None), ("2", ""), (None, "a b"), ("3", "word " * 30_000), ("4", "same"), ("4", "same")]
    frame = spark.createDataFrame([(*row, "s", "i", 1) for row in texts], SCHEMA)
    found = packing.pack(frame).collect()
    by_doc = {}
    for row in found:
        by_doc.setdefault(row["document"], []).append(row)
    got = sorted(
        (str(rows[0]["_id"]), sum(row["length"] for row in rows), rows[0]["doc_tokens"]) for rows in by_doc.values()
    )
    sizes = [(str(key), len(coded(public, text))) for key, text in texts]
    assert got == sorted((key, n, n) for key, n in sizes)
    for rows in by_doc.values():
        joined = b"".join(row["ids"] for row in sorted(rows, key=lambda row: row["start"]))
        assert np.frombuffer(joined, "<u4")[-1] == packing.END
    assert packing.pack(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(frame, window=1000)
