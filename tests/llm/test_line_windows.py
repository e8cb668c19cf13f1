"""Repeated three-line passages against a plain loop over all lines."""

import random

from sediment.llm import line_windows

SCHEMA = "doc_id long, text string, spans string, doc string, removed string"
BLANK = " \t\n\r\x0b\x0c"


def brute(rows):
    """Distinct (id, text) in order; the line numbers to cut from each."""
    first, cuts = {}, {}
    for doc in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, str(r[1]))):
        lines = (doc[1] or "").split("\n")
        full = [i for i, line in enumerate(lines) if line.strip(BLANK)]
        for k in range(len(full) - 2):
            window = tuple(lines[i].strip(BLANK) for i in full[k : k + 3])
            if first.setdefault(window, (doc, full[k])) != (doc, full[k]):
                cuts.setdefault(doc, set()).update(range(full[k], full[k + 2] + 1))
    out = []
    for doc in rows:
        lines = (doc[1] or "").split("\n")
        gone = cuts.get(doc, set())
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((doc[0], None if doc[1] is None else kept, sum(1 for i in gone if lines[i].strip(BLANK))))
    return out


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    found = line_windows.deduplicate(frame).select("doc.*", "removed").collect()
    return sorted(((r[0], r[1], r[-1]) for r in found), key=str)


def test_matches_plain_loop(spark):
    draw = random.Random(3)
    lines = [f"line {i}" for i in range(12)] + ["", "  ", "line 1  ", "\tline 2"]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randrange(0, 14)))) for i in range(60)]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_edges(spark):
    passage = "a\nb\nc"
    rows = [
        (1, passage),
        (2, "x\n" + passage + "\ny"),
        (3, "a\n\nb\n \nc\nd"),
        (4, None),
        (5, ""),
        (6, "a\nb"),
        (None, passage),
        (7, "same\n" * 9),
        (8, "r\ns\nt\nu"),
        (8, "r\ns\nt\nu"),
        (9, "\n".join(f"long {i}" for i in range(30_000))),
        (10, "\n".join(f"long {i}" for i in range(5, 20_000)) + "\nend"),
        (11, "a\r\nb\r\nc\r\n"),
    ]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_emptied_documents_go_and_columns_stay(spark):
    frame = spark.createDataFrame([(1, "a\nb\nc", "s", "d", "r"), (2, "a\nb\nc", "s", "d", "r"), (3, "", "s", "d", "r"), (4, None, "s", "d", "r")], SCHEMA)
    kept = line_windows.drop_emptied(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    assert line_windows.drop_emptied(frame.limit(0)).collect() == []


def test_windows_are_not_broadcast(spark, tmp_path):
    """Texts of a file under the broadcast limit make rows for all their lines."""
    draw = random.Random(3)
    lines = [f"line {i}" for i in range(40)]
    rows = [(i, "\n".join(draw.choices(lines, k=30))) for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    found = line_windows.covered(spark.read.parquet(f"{tmp_path}/docs"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
