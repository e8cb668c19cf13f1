"""What the ledger runs, sets aside and moves, over arrivals of all kinds."""

import os
from datetime import datetime
from pathlib import Path

import pytest

from sediment.session import scratch_path
from sediment.sinks.files import land
from sediment.sources import files
from sediment.streaming import arrivals
from sediment.streaming.ledger import NO_LOAD, Ledger
from tests.test_history import DAYS, name

SCHEMA = "id int, city string"


class Kept:
    """A handler that keeps the rows of each load, replacing what an attempt before brought."""

    def __init__(self):
        self.loads, self.calls, self.aside = {}, [], {}

    def __call__(self, rows, load, at):
        assert load == arrivals.load_id(at)
        self.loads[at] = sorted(row.id for row in rows.collect())
        self.calls.append(at)

    def errored(self, rows, load):
        self.aside[load] = sorted(row.record for row in rows.collect())


def rows(spark, *ids):
    return spark.createDataFrame([(k, "x") for k in ids], SCHEMA).coalesce(1)


def tree(root, source):
    """Files below the source, without Spark's own."""
    found = []
    for folder, _, names in os.walk(f"{root}/{source}"):
        found += [f"{folder}/{n}" for n in names if not n.startswith((".", "_"))]
    return sorted(path.removeprefix(f"{root}/{source}/").partition("/")[0] for path in found)


def staged(root, source, at=None, text="", kind="json", file="part-x.json"):
    folder = Path(files.staged_path(root, source, at, kind) if at else f"{root}/{source}/{files.STAGED}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text(text)


@pytest.mark.parametrize("move", [False, True])
def test_late_files_run_their_load_again_and_those_after(spark, move):
    root, source, kept = scratch_path(spark, "staged"), name("people"), Kept()
    ledger = Ledger(root, source, "json", SCHEMA, move=move)
    for at, ids in ((DAYS[0], [1]), (DAYS[1], [2]), (DAYS[2], [3])):
        land(rows(spark, *ids), root, source, at)
    ledger.run(spark, kept)
    assert kept.calls == DAYS[:3] and kept.loads == {DAYS[0]: [1], DAYS[1]: [2], DAYS[2]: [3]}
    ledger.run(spark, kept)
    assert len(kept.calls) == 3
    staged(root, source, DAYS[1], '{"id":7,"city":"x"}\n')
    land(rows(spark, 9), root, source, DAYS[3])
    ledger.run(spark, kept)
    assert kept.calls[3:] == [DAYS[1], DAYS[2], DAYS[3]] and kept.loads[DAYS[1]] == [2, 7] and kept.loads[DAYS[2]] == [3]
    assert tree(root, source) == [files.LOADED if move else files.STAGED] * 5
    assert ledger.loads(spark) == [arrivals.load_id(at) for at in DAYS[:4]]
    staged(root, source, DAYS[1], '{"id":77,"city":"x"}\n{"id":78,"city":"x"}\n')  # sent again, with other records
    ledger.run(spark, kept)
    assert kept.loads[DAYS[1]] == [2, 77, 78] and ledger.files(spark).count() == 5


def test_strays_are_set_aside_and_counted(spark):
    root, source, kept = scratch_path(spark, "staged"), name("people"), Kept()
    ledger = Ledger(root, source, "json", SCHEMA, move=True)
    land(rows(spark, 1, 2), root, source, DAYS[0])
    staged(root, source, None, '{"id":3,"city":"x"}\n', file="api_export.json")
    staged(root, source, DAYS[0], "4,x\n", "csv", "part-a.csv")
    staged(root, "other", DAYS[0], '{"id":5,"city":"x"}\n')
    wrong_day = Path(f"{root}/{source}/{files.STAGED}/2026/01/09/{source}_2026_01_08_00_00_00.json")
    wrong_day.parent.mkdir(parents=True)
    wrong_day.write_text('{"id":6,"city":"x"}\n')
    assert files.misplaced_files(spark, root, source, "json").count() == 3
    ledger.run(spark, kept, kept.errored)
    assert kept.loads == {DAYS[0]: [1, 2]}
    assert kept.aside == {NO_LOAD: ["4,x", '{"id":3,"city":"x"}', '{"id":6,"city":"x"}']}
    assert tree(root, source) == [files.ERRORED] * 3 + [files.LOADED]
    staged(root, source, None, '{"id":8,"city":"x"}\n', file="more.json")
    ledger.run(spark, kept, kept.errored)
    assert len(kept.aside[NO_LOAD]) == 4 and len(kept.calls) == 1
    outcomes = {(row.outcome, row.reason is None): row["count"] for row in ledger.files(spark).groupBy("outcome", "reason").count().collect()}
    assert outcomes == {("loaded", True): 1, ("errored", False): 4}


def test_per_load_refuses_strays(spark):
    root, source = scratch_path(spark, "staged"), name("people")
    land(rows(spark, 1), root, source, DAYS[0])
    staged(root, source, None, '{"id":3,"city":"x"}\n', file="api_export.json")
    handler = arrivals.per_load(root, source, "json", SCHEMA, lambda *_: None)
    stream = arrivals.read_arrivals(spark, root, source, "json", SCHEMA)
    with pytest.raises(Exception, match="belong to no load"):
        arrivals.on_arrival(stream, handler, scratch_path(spark, "offsets")).awaitTermination()


@pytest.mark.parametrize("move", [False, True])
def test_loads_whose_records_do_not_fit(spark, move):
    root, source, kept = scratch_path(spark, "staged"), name("people"), Kept()
    land(rows(spark, 1), root, source, DAYS[0])
    staged(root, source, DAYS[1], '{"id":"zz"}\n')
    land(rows(spark, 3), root, source, DAYS[2])
    strict = Ledger(root, source, "json", SCHEMA, move=move)
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        strict.run(spark, kept)
    assert strict.loads(spark) == [arrivals.load_id(DAYS[0])]
    going = Ledger(root, source, "json", SCHEMA, move=move, keep_going=True)
    going.run(spark, kept, kept.errored)
    assert kept.loads == {DAYS[0]: [1], DAYS[2]: [3]}
    assert kept.aside == {arrivals.load_id(DAYS[1]): ['{"id":"zz"}']}
    assert going.files(spark).where("outcome = 'errored'").count() == 1
    going.run(spark, kept, kept.errored)
    assert kept.calls == [DAYS[0], DAYS[2]]
    if move:
        assert tree(root, source) == [files.ERRORED, files.LOADED, files.LOADED]


def test_a_load_is_noted_only_once_it_is_handled(spark, monkeypatch):
    root, source, kept = scratch_path(spark, "staged"), name("people"), Kept()
    ledger = Ledger(root, source, "json", SCHEMA, move=True)
    land(rows(spark, 1), root, source, DAYS[0])
    land(rows(spark, 2), root, source, DAYS[1])

    def failing(frame, load, at):
        kept(frame, load, at)
        if at == DAYS[1]:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        ledger.run(spark, failing)
    assert tree(root, source) == [files.STAGED, files.LOADED]
    with monkeypatch.context() as patch:  # the driver is lost between the note and the move
        patch.setattr("sediment.streaming.ledger.move_files", lambda *_: None)
        ledger.run(spark, kept)
    assert tree(root, source) == [files.STAGED, files.LOADED] and len(kept.calls) == 3
    ledger.run(spark, kept)
    assert tree(root, source) == [files.LOADED, files.LOADED] and len(kept.calls) == 3


def test_an_empty_tree_and_a_load_without_rows(spark):
    root, source, kept = scratch_path(spark, "staged"), name("people"), Kept()
    Path(f"{root}/{source}/{files.STAGED}").mkdir(parents=True)
    ledger = Ledger(root, source, "json", SCHEMA, move=True)
    ledger.run(spark, kept, kept.errored)
    assert not kept.calls and not kept.aside
    staged(root, source, DAYS[0], "\n")
    ledger.run(spark, kept, kept.errored)
    assert kept.loads == {DAYS[0]: []} and isinstance(kept.calls[0], datetime)
