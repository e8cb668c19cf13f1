"""Runs against trying every period at every place, and the query against the contract done by hand."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from sediment.llm import periodic_runs
from sediment.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, runs string, keys string, `a.b` map<string,int>"


def every_run(words, least, exponent):
    found = []
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start + period < len(words):
            stop = start
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            length = stop - start + period
            shorter = any(
                all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, period)
            )
            if stop > start and length >= max(least, exponent * period) and not shorter:
                found.append((start, length, period))
            start = max(stop, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return b" ".join(word for k, word in enumerate(words) if k not in gone)


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (5, 3), (9, 2)])
def test_runs_are_all_and_no_others(least, exponent):
    draw = random.Random(least * 10 + exponent)
    for _ in range(400):
        texts = []
        for _ in range(draw.randrange(1, 4)):
            kinds = draw.choice([1, 2, 2, 3, 5])
            words = [b"%d" % draw.randrange(kinds) for _ in range(draw.randrange(40))]
            if words and draw.random() < 0.5:
                start, period = draw.randrange(len(words)), draw.randrange(1, 6)
                for k in range(start + period, len(words)):
                    words[k] = words[k - period]
            texts.append(words)
        wanted = [every_run(words, least, exponent) for words in texts]
        assert periodic_runs.find_runs(texts, least, exponent) == wanted
        for words, runs in zip(texts, wanted, strict=True):
            assert periodic_runs.collapse(words, runs) == kept(words, runs)


def test_an_exponent_below_two_is_refused():
    with pytest.raises(ValueError):
        periodic_runs.find_runs([[b"a"]], exponent=1)


def test_query_equals_the_contract(spark, sf_dir, tables):
    wanted = {}
    for row in tables("documents").collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (row["text"] or "").encode())
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = every_run(words, 6, 4) if n < 200 else periodic_runs.find_runs([words])[0]
        best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None,) * 3)
        wanted[row["doc_id"]] = (
            len(runs),
            *best,
            1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{ln},{p}\n" for s, ln, p in runs).encode()).hexdigest(),
            hashlib.sha256(kept(words, runs)).hexdigest(),
        )
    found = QUERIES["op11_periodic_runs"](spark, sf_dir).collect()
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert len(found) == len(wanted) and any(row["n_runs"] for row in found)
    assert {row["doc_id"]: tuple(row[name] for name in names) for row in found} == wanted


def test_edges(spark):
    long = "x y " * 60_000
    texts = [None, "", " \t\n", "a a a a a a", "a a a a a", "　 b" * 3, long, "a a a a a a"]
    ids = [1, 2, None, 3, 4, None, 5, 3]
    frame = spark.createDataFrame([(k, t, "r", "k", {"a": 1}) for k, t in zip(ids, texts, strict=True)], SCHEMA)
    found = periodic_runs.runs(frame).collect()
    assert len(found) == len(texts)
    got = sorted(((r["_id"], r["n_words"], [tuple(run) for run in r["runs"]], r["collapsed"]) for r in found), key=str)
    a = [(0, 6, 1)]
    wanted = [
        (1, 0, [], ""),
        (2, 0, [], ""),
        (None, 0, [], ""),
        (3, 6, a, "a"),
        (4, 5, [], "a a a a a"),
        (None, 6, [], "　 b　 b　 b"),
        (5, 120_000, [(0, 120_000, 2)], "x y"),
        (3, 6, a, "a"),
    ]
    wanted[5] = (None, 4, [], "　 b　 b　 b")
    assert got == sorted(wanted, key=str)
    assert periodic_runs.runs(frame.limit(0)).collect() == []
    ranked = periodic_runs.runs(frame).select(periodic_runs.strongest().alias("best")).collect()
    assert sum(row["best"] is None for row in ranked) == 5


def test_ties_go_to_the_first(spark):
    frame = spark.createDataFrame([(1, "a a a a a a b b b b b b c d c d c d c d")], "doc_id long, text string")
    row = periodic_runs.runs(frame).select("runs", periodic_runs.strongest().alias("best")).first()
    assert [tuple(run) for run in row["runs"]] == [(0, 6, 1), (6, 6, 1), (12, 8, 2)]
    assert tuple(row["best"]) == (0, 6, 1)
