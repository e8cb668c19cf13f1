"""License labels: phrases against plain search, notices with edits."""

import random
import re

from sediment.llm import license_vote as lv

SCHEMA = "doc_id long, text string, mask string, template string, score string"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(text):
    words = words_of(text)
    places = [
        (i, label)
        for phrase, label in lv.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base(row):
    return row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]


def test_whole_table(spark, tables):
    docs = tables("documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = lv.licenses(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert base(r) == brute(texts[r["_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_phrases_and_edges(spark):
    draw = random.Random(2)
    pool = "cc by all rights reserved general public license cc-by été x9".split()
    rows = [(i, " ".join(draw.choices(pool, k=draw.randrange(0, 60)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "CC-BY"), (203, "cc by" * 3), (204, "ALL\nRights\x00reserved."), (None, "cc by cc by")]
    rows += [(205, "word " * 100_000 + "all rights reserved"), (206, "cc by all rights reserved"), (206, "cc by all rights reserved"), (207, "y" * 50_000 + " cc by")]
    frame = spark.createDataFrame([(*r, "m", "t", "s") for r in rows], SCHEMA)
    found = lv.licenses(frame).collect()
    assert sorted((str(r["_id"]), *map(str, base(r))) for r in found) == sorted((str(i), *map(str, brute(t))) for i, t in rows)
    assert lv.licenses(frame.limit(0)).collect() == []


def test_notices_with_edits(spark):
    draw = random.Random(4)
    noise = " ".join(f"n{draw.randrange(10**6)}" for _ in range(200))
    rows, wanted = [], {}
    for i, (text, label) in enumerate(lv.NOTICES.items()):
        words = text.split()
        cut = words[: len(words) // 2] + ["inserted"] + words[len(words) // 2 :]
        rows += [(3 * i, f"{noise} {text.upper()} {noise}"), (3 * i + 1, f"{noise} {' '.join(cut)}"), (3 * i + 2, f"{noise} {' '.join(sorted(words))}")]
        wanted |= {3 * i: label, 3 * i + 1: label}
    for r in lv.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        labels = r["labels"].split(",")
        assert (wanted[r["_id"]] in labels) if r["_id"] in wanted else r["labels"] == r["base_labels"], (r["_id"], labels)


def test_license_lines_of_the_table(spark, tables):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
    }
    docs = tables("documents")
    wanted = {r["doc_id"]: {v for k, v in lines.items() if k in (r["text"] or "")} for r in docs.collect()}
    assert {"apache-2.0", "mit"} <= set().union(*wanted.values())
    for r in lv.licenses(docs).collect():
        labels, base_labels = (set(filter(None, r[c].split(","))) for c in ("labels", "base_labels"))
        assert labels == base_labels | wanted[r["_id"]], r
        assert not wanted[r["_id"]] or r["score"] == 1.0


def test_license_lines_are_told_apart(spark):
    rows = [(f"Licensed under {text.removeprefix('released ').removeprefix('under ')}.", {label}) for text, label in lv.LINES.items()]
    rows += [
        ("Distributed under the MIT license", {"mit"}),
        ("licensed under the Apache License, Version 1.1", set()),
        ("licensed under the Eclipse Public License, version 2.0", set()),
        ("the GNU General Public License, version 2.0", set()),
        ("released under the new license", set()),
        ("released into the public eye", set()),
    ]
    frame = spark.createDataFrame([(i, f"some words before. {text} and some after") for i, (text, _) in enumerate(rows)], "doc_id long, text string")
    for r in lv.licenses(frame).collect():
        labels, base_labels = (set(filter(None, r[c].split(","))) for c in ("labels", "base_labels"))
        assert labels == base_labels | rows[r["_id"]][1], (rows[r["_id"]], labels)


def test_pieces_never_cut_words(monkeypatch):
    text = ("ab cd " * 50 + "e" * 40).encode()
    whole = lv.word_hashes(text)
    monkeypatch.setattr(lv, "PIECE", 7)
    assert lv.word_hashes(text).tolist() == whole.tolist()
    assert len(set(whole.tolist())) == 3
