"""Mixing: targets against repeated sharing, totals, expectations and reruns."""

import random
import re

import pytest

from sediment.llm import pivotal

SCHEMA = "doc_id long, text string, source string, copies string, bucket string, place string"


def documents(n=3000, sources=7, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        source = "s0" if draw.random() < 0.4 else f"s{draw.randrange(1, sources)}"
        rows.append((i, " ".join(["w"] * int(draw.paretovariate(1.1))), source, "c", "b", "p"))
    return rows + [(n, None, "s0", "", "", ""), (n + 1, "", None, "", "", ""), (None, "x\ty\x0bz", None, "", "", ""), (5, "dup dup", "s1", "", "", ""), (5, "dup dup", "s1", "", "", "")]


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute_targets(rows):
    per = {}
    for row in rows:
        per[row[2]] = per.get(row[2], 0) + size(row[1])
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, got, open_ = 1.5 * sum(per.values()), dict.fromkeys(per, 0.0), set(per)
    while True:  # share what is left by weight; what passes a limit is shared again
        left = total - sum(got[s] for s in per if s not in open_)
        for s in open_:
            got[s] = left * weight[s] / sum(weight[x] for x in open_)
        above = {s for s in open_ if got[s] > 2 * per[s]}
        if not above:
            return per, got
        for s in above:
            got[s] = 2.0 * per[s]
        open_ -= above


@pytest.mark.parametrize("sources", [2, 5, 9])
def test_targets_and_totals(spark, sources):
    rows = documents(sources=sources, seed=sources)
    per, wanted = brute_targets(rows)
    found = pivotal.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    taken = dict.fromkeys(per, 0)
    for r in found:
        assert r["source_size"] == per[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    most = {s: max((size(x[1]) for x in rows if x[2] == s), default=0) for s in per}
    assert all(abs(taken[s] - wanted[s]) <= most[s] for s in per)
    assert sorted(r["size"] for r in found) == sorted(size(r[1]) for r in rows)


def test_reruns_and_partitions_agree(spark):
    frame = spark.createDataFrame(documents(), SCHEMA)
    runs = [sorted(map(str, pivotal.mix(f).collect())) for f in (frame, frame.repartition(13), frame.orderBy("text"))]
    assert runs[0] == runs[1] == runs[2]


def test_many_buckets_meet_in_the_tree(spark, monkeypatch):
    monkeypatch.setattr(pivotal, "BUCKET_ROWS", 3)
    monkeypatch.setattr(pivotal, "FAN_IN", 4)
    rows = documents()
    per, wanted = brute_targets(rows)
    taken = dict.fromkeys(per, 0)
    for r in pivotal.mix(spark.createDataFrame(rows, SCHEMA)).collect():
        taken[r["source"]] += r["taken"]
    most = {s: max(size(x[1]) for x in rows if x[2] == s) for s in per}
    assert all(abs(taken[s] - wanted[s]) <= most[s] for s in per)


def test_repeated_rows_are_dealt_to_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(pivotal, "BUCKET_ROWS", 100)
    monkeypatch.setattr(pivotal, "RUN_ROWS", 64)
    written, write = {}, pivotal.materialise
    monkeypatch.setattr(pivotal, "materialise", lambda frame, label: written.setdefault(label, write(frame, label)))
    rows = [(None, "one two three", "a", "", "", "")] * 5000 + [(None, None, "a", "", "", "")] * 300
    found = pivotal.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(r["count"] for r in written["mix-buckets"].groupBy("source", "bucket").count().collect()) < 200
    assert len(found) == len(rows) and sum(r["size"] for r in found) == 15000
    assert abs(sum(r["taken"] for r in found) - 22500) <= 3


def test_settle_keeps_sums_and_expectations():
    draw = random.Random(9)
    sizes = [draw.randrange(1, 50) for _ in range(40)]
    chance = [draw.random() for _ in sizes]
    hits = [0] * len(sizes)
    for _ in range(4000):
        whole, left, x = pivotal.settle(sizes, chance, [draw.random() for _ in sizes])
        total = sum(s * (x if i == left else w) for i, (s, w) in enumerate(zip(sizes, whole, strict=True)))
        assert total == pytest.approx(sum(s * c for s, c in zip(sizes, chance, strict=True)))
        for i, w in enumerate(whole):
            hits[i] += draw.random() < x if i == left else w
    assert all(abs(h / 4000 - c) < 0.05 for h, c in zip(hits, chance, strict=True))


def test_copies_keep_columns(spark):
    frame = spark.createDataFrame(documents(300), SCHEMA)
    mixed = pivotal.copies(frame)
    assert mixed.columns == ["doc_id", "text", "source", "bucket", "place", "copies", "taken"]
    by_row = {}
    for r in pivotal.mix(frame).collect():
        by_row[r["_id"], r["_hash"]] = by_row.get((r["_id"], r["_hash"]), 0) + r["copies"]
    assert sorted(r["copies"] for r in mixed.collect()) == sorted(c for c in by_row.values() if c)


def test_empty_and_wordless(spark):
    frame = spark.createDataFrame(documents(10), SCHEMA)
    assert pivotal.mix(frame.limit(0)).collect() == []
    none = frame.where("text is null or text = ''")
    assert [r["taken"] for r in pivotal.mix(none).collect()] == [0, 0]
