"""The forward sum against listing all segmentations; learning by its likelihood and held-out accuracy."""

import itertools
import math
import zlib

import numpy as np
import pytest

from sediment.llm import language

SCHEMA = "doc_id long, text string, lang string, doc string, _hash string"


@pytest.fixture(scope="module")
def pieces():
    return language.pieces_of(language.VOCABULARY)


def cuts(word):
    """All ways to cut a word."""
    for marks in itertools.product((0, 1), repeat=len(word) - 1):
        parts, last = [], 0
        for i, mark in enumerate(marks, 1):
            if mark:
                parts.append(word[last:i])
                last = i
        yield [*parts, word[last:]]


def test_forward_sums_all_segmentations(pieces):
    number = {p: i for i, p in enumerate(pieces.pieces)}
    table = np.random.default_rng(1).dirichlet(np.ones(len(number)), 3).T
    words = [b"the", b"a", "été".encode(), b"ration", b"x", b"qqqq"]
    logs = language.word_logs(pieces, words, table)
    for k, word in enumerate(words):
        for lang in range(3):
            total = sum(
                math.prod(table[number[p], lang] for p in parts)
                for parts in cuts(b" " + word)
                if all(p in number for p in parts)
            )
            assert logs[k, lang] == pytest.approx(math.log(total))


def test_long_words_do_not_vanish(pieces):
    table = np.full((len(pieces.pieces), 1), 1 / len(pieces.pieces))
    short, long = language.word_logs(pieces, [b"ab" * 4, b"ab" * 128], table)[:, 0]
    assert -3000 < long < 10 * short < 0


def test_expected_counts_equal_listing(pieces):
    number = {p: i for i, p in enumerate(pieces.pieces)}
    table = np.random.default_rng(2).dirichlet(np.ones(len(number)), 1).T
    words, counts = [b"the", b"ration"], np.array([2.0, 3.0])
    wanted = np.zeros(len(number))
    for word, n in zip(words, counts, strict=True):
        ways = [[number[p] for p in parts] for parts in cuts(b" " + word) if all(p in number for p in parts)]
        chance = np.array([np.prod(table[w, 0]) for w in ways])
        for way, c in zip(ways, chance / chance.sum(), strict=True):
            np.add.at(wanted, way, n * c)
    assert np.allclose(language.expected(pieces, words, counts, table), wanted)


def test_learning_raises_the_likelihood(spark, pieces, tables):
    docs = tables("documents").where("doc_id < 60")
    texts = [r[0].encode() for r in docs.where("lang = 'en'").select("text").collect()]
    logs = []
    for rounds in (0, 1, 3):
        model = language.learn(docs, rounds=rounds)
        logs.append(model.scores(texts)[:, model.languages.index("en")].sum())
    assert logs[0] < logs[1] < logs[2]


def test_held_out_accuracy(spark, tables):
    docs = tables("documents")
    model = language.learn(docs)
    found = language.identify(docs, model).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in found if zlib.crc32(str(r["_id"]).encode()) % 3 == 1]
    assert len(held) > 30
    assert sum(r["lang_pred"] == truth[r["_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_edges(spark):
    text = "the cat and the dog are in the house with a bird "
    other = "der Hund und die Katze sind in dem Haus mit einem Vogel "
    rows = [(i, (text if i % 2 else other) * 3, "en" if i % 2 else "de") for i in range(12)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !!", "xx"), (None, text, None), (103, "x" * 5000, None), (104, other * 3000, None), (104, other * 3000, None)]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows + odd], SCHEMA)
    model = language.learn(frame.where("lang is null or lang <> 'xx'"))
    assert model.languages == ["de", "en"]
    assert np.allclose(model.table.sum(axis=0), 1)
    found = sorted(((r["_id"], r["lang_pred"], r["score"]) for r in language.identify(frame, model).collect()), key=str)
    by_id = {r[0]: r for r in found}
    assert len(found) == len(rows) + len(odd)
    assert by_id[100][1:] == by_id[101][1:] == by_id[102][1:] == ("und", 0.0)
    assert by_id[None][1] == "en" and by_id[104][1] == "de" and by_id[103][1] in ("de", "en")
    kept = language.keep_identified(frame, model)
    assert kept.columns == frame.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect() if r["doc_id"] != 103) == sorted([-1, *range(12), 104, 104])
    empty = language.learn(frame.limit(0))
    assert empty.languages == [] and {r["lang_pred"] for r in language.identify(frame, empty).collect()} == {"und"}
    assert language.identify(frame.limit(0), model).collect() == []


def test_held_out_uses_the_id_as_text(spark):
    frame = spark.range(-20, 50)
    for r in frame.select("id", language.held_out(frame["id"]).alias("out")).collect():
        assert r["out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1)
