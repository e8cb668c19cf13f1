"""Benchmark passages against edit distances by the plain recurrence."""

import random

import numpy as np
import pytest

from sediment.llm import decontaminate as d

SCHEMA = "doc_id long, text string, item_id string, doc string, _hash string, windows string"


def prose(draw, n):
    return " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randrange(2, 9))) for _ in range(n))


def best_distance(window, region):
    """Fewest edits between a window and any part of a region."""
    row = [0] * (len(region) + 1)
    for i, c in enumerate(window):
        now = [i + 1]
        for j, r in enumerate(region):
            now.append(min(row[j] + (c != r), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


def edited(draw, text, edits):
    text = list(text)
    for _ in range(edits):
        at = draw.randrange(len(text))
        kind = draw.randrange(3)
        if kind == 0:
            text[at] = "z"
        elif kind == 1:
            text.insert(at, "z")
        else:
            del text[at]
    return "".join(text)


def test_alignment_equals_plain_recurrence():
    draw = random.Random(2)
    for _ in range(150):
        window = "".join(draw.choices("abc", k=draw.randrange(12, 40)))
        region = "".join(draw.choices("abc", k=draw.randrange(0, 10))) + edited(draw, window, draw.randrange(0, 5)) + "ab" * draw.randrange(0, 4)
        budget = draw.randrange(0, 6)
        best = best_distance(window, region)
        got = d.align(window.encode(), region.encode(), budget)
        # Paths outside the band need more edits than the budget.
        assert (got is None) == (best > budget)
        if got:
            assert got[2] == best
            assert best_distance(window, region[got[0] : got[1]]) <= best


def test_windows_within_budget_are_never_missed():
    draw = random.Random(4)
    items = [prose(draw, 60).encode() for _ in range(5)]
    index = d.Index(items)
    for trial in range(60):
        window = index.windows[draw.randrange(len(index.windows))]
        text = prose(draw, 40) + " " + edited(draw, window.data.decode(), draw.randrange(0, window.edits + 1)) + " " + prose(draw, 40)
        data, _ = d.normal(text.encode())
        best = best_distance(window.data.decode(), data.tobytes().decode())
        if best <= window.edits:
            assert any(hit[0] == window.item for hit in index.search(data)), trial


def test_matches_and_filter(spark):
    draw = random.Random(6)
    items = [prose(draw, 50) for _ in range(4)]
    bench = spark.createDataFrame([*enumerate(items), (4, None), (5, ""), (None, items[0]), (6, "short")], "item_id long, text string")
    clean = prose(draw, 300)
    rows = [
        (1, clean + " " + items[0] + " " + clean),
        (2, items[1].upper().replace(" ", " \n\t")),
        (3, clean),
        (4, None),
        (5, ""),
        (6, clean + edited(draw, items[2], 6) + clean),
        (None, items[3]),
        (7, items[3][:100]),
        (8, clean[:1500] + (clean + " ") * 900 + items[1] + clean),
        (9, "short"),
        (10, "aaaa" * 5000),
        (1, clean + " " + items[0] + " " + clean),
    ]
    frame = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)
    for block in (1 << 20, 200):  # one block, and several
        found = {(r["_id"], r["_item"]) for r in d.matches(frame, bench, block_bytes=block).collect()}
        assert found == {(1, 0), (1, None), (2, 1), (6, 2), (None, 3), (8, 1)}
    for r in d.matches(frame, bench).where("_id = 1 and _item = 0").collect():
        text = rows[0][1].encode()
        assert text[r["start"] : r["stop"]].decode() == items[0]
    kept = d.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 7, 9, 10]
    assert d.matches(frame.limit(0), bench).collect() == []
    assert d.matches(frame, bench.limit(0)).collect() == []
    assert d.drop_contaminated(frame, bench.limit(0)).count() == len(rows)


def test_partial_passages_of_two_windows(spark):
    draw = random.Random(8)
    item = prose(draw, 80)
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    frame = spark.createDataFrame([(1, prose(draw, 50) + " " + item[60:230] + " " + prose(draw, 50))], "doc_id long, text string")
    assert [r["_item"] for r in d.matches(frame, bench).collect()] == [0]


def test_shortest_copies_are_found_at_every_offset():
    draw = random.Random(10)
    item = prose(draw, 50).encode()[:253]
    index = d.Index([item])
    least = d.WINDOW - int(d.WINDOW * d.EDIT_RATE)
    assert least == 101 and least + d.STRIDE <= 120
    for size in (least, 111, 120):
        for start in range(len(item) - size + 1):
            assert d.spans(index, b"0" * 200 + item[start : start + size] + b"1" * 200), (size, start)


def test_one_replaced_word_leaves_a_window():
    draw = random.Random(12)
    for _ in range(30):
        item = prose(draw, 40)[:200]
        words = item.split()
        words[draw.randrange(len(words))] = "z" * 8
        assert d.spans(d.Index([item.encode()]), f"{prose(draw, 30)} {' '.join(words)} {prose(draw, 30)}".encode())


def test_counts_in_slices_lose_nothing(monkeypatch):
    draw = random.Random(14)
    items = [prose(draw, 40).encode() for _ in range(20)]
    index = d.Index(items)
    data = np.frombuffer(b" ".join(items), dtype=np.uint8)
    whole = index.regions(data)
    monkeypatch.setattr(d, "PAIRS", 50)
    monkeypatch.setattr(d, "_COUNT_BITS", 10)
    assert {i.item for i in index.windows} == {index.windows[w].item for w, _ in whole} and index.regions(data) >= whole


def test_repeated_items_do_not_fill_a_block(spark, monkeypatch):
    monkeypatch.setattr(d, "RUN_ROWS", 64)
    draw = random.Random(16)
    items = [prose(draw, 30) for _ in range(3)]
    bench = spark.createDataFrame([(0, items[0])] * 500 + [(None, items[1])] * 2 + [(2, items[2])], "item_id long, text string")
    assert [sum(map(len, block)) for block in ([b for _, b, *_ in x] for x in d.blocks(bench, "item_id", "text", 1 << 20))] == [sum(map(len, items))]
    frame = spark.createDataFrame([(1, items[0] + " and " + items[1]), (2, items[2]), (2, items[2])], "doc_id long, text string")
    found = [(r["_id"], r["_item"]) for r in d.matches(frame, bench).collect()]
    assert {x: found.count(x) for x in found} == {(1, 0): 500, (1, None): 2, (2, 2): 2}
    assert d.drop_contaminated(frame, bench).count() == 0


def test_normal_form_places():
    data, places = d.normal("  Ab\t\n C ".encode())
    assert data.tobytes() == b"ab c" and places.tolist() == [2, 3, 4, 7]
    assert len(d.grams(np.zeros(5, np.uint8))) == 0


@pytest.mark.parametrize("size", [12, 30, 81, 120, 121, 500])
def test_every_item_has_windows_to_its_end(size):
    index = d.Index([bytes(random.Random(size).choices(range(97, 123), k=size))])
    assert index.windows[-1].start + len(index.windows[-1].data) == size
    assert all(w.least >= 1 for w in index.windows)
