"""Publication in one step, older runs repeated, versions that nobody names."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from sediment.operators import quality
from sediment.plans import warehouse
from sediment.plans.warehouse import Fact, Warehouse
from sediment.sinks import publication
from sediment.sources.tables import read_table, table_exists
from tests.test_history import DAYS, name, people, source


def versions(spark, table):
    """Partitions kept for a published table."""
    entry = next(entry for entry in publication.manifest(spark) if entry.table == table and not entry.age)
    return spark.sql(f"SHOW PARTITIONS {entry.storage}").count()


def seen(spark, *tables):
    return [sorted(map(str, read_table(spark, table).collect())) if table_exists(spark, table) else None for table in tables]


@pytest.mark.parametrize("failing", [0, 1, 2])
def test_a_fault_at_any_name_leaves_all_as_before(spark, failing):
    persons, places, sold = source(name("people")), source(name("places")), source(name("sales"))
    spec = Fact(name("sales"), sold.source_name, {"person_key": (persons.source_name, {"person": "id"})}, ["id"])
    names = [f"dim.{persons.source_name}", f"dim.{places.source_name}", f"fact.{spec.name}"]
    sales = spark.createDataFrame([(1, 1), (2, 1)], "id int, person int")

    def load(batch, city, announce=None, wide=False):
        rows = {persons.source_name: people(spark, (1, "a", city)), places.source_name: people(spark, (7, city, "z"))}
        rows[sold.source_name] = sales.where(F.col("id") <= batch)
        step = {places.source_name: lambda df, s: df.withColumn("extra", F.lit(batch))} if wide else {}
        Warehouse(spark, batch, DAYS[batch - 1], step, announce=announce).run([persons, places, sold], [spec], data=rows)

    def broken(entry):
        if entry.table == names[failing]:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        load(1, "x", broken)
    assert seen(spark, *names) == [None] * 3
    load(1, "x")
    first = seen(spark, *names)
    for wide in (False, True):  # with the same columns, and with other ones
        with pytest.raises(RuntimeError, match="stop"):
            load(2, "y", broken, wide)
        assert seen(spark, *names) == first
        assert [versions(spark, table) for table in names] == [1, 1, 1]
    load(2, "y", wide=True)
    after = seen(spark, *names)
    assert all(a != b for a, b in zip(first, after, strict=True)) and "extra=2" in after[1][0]


def test_a_definition_that_was_cut_off_is_made_up_for(spark, monkeypatch):
    entry = source(name("people"))
    table = f"dim.{entry.source_name}"
    with monkeypatch.context() as patch:
        patch.setattr(publication, "_define", lambda *_: None)  # the driver is lost before names are defined
        Warehouse(spark, 1, DAYS[0]).run([entry], data={entry.source_name: people(spark, (1, "a", "x"))})
    assert not table_exists(spark, table) and publication.read_published(spark, table).count() == 1
    publication.settle(spark)
    assert read_table(spark, table).count() == 1
    with pytest.raises(ValueError, match="not published"):
        publication.read_published(spark, f"dim.{name('nothing')}")


def test_runs_keep_the_state_before_and_nothing_else(spark):
    entry = source(name("people"))
    table = f"dim.{entry.source_name}"
    rule = quality.PrimaryKey(entry.source_name, ("city",))
    for batch in range(1, 5):
        run = Warehouse(spark, batch, DAYS[0] + timedelta(days=batch))
        run.run([entry], data={entry.source_name: people(spark, (1, "a", str(batch)))})
        assert versions(spark, table) == min(batch, 2)
    assert [publication.read_published(spark, table, age).first().city for age in (0, 1)] == ["4", "3"]
    with pytest.raises(quality.KeyViolation):
        run.run([entry], constraints=[rule], data={entry.source_name: people(spark, (1, "a", "q"), (2, "b", "q"))})
    assert versions(spark, table) == 2
    rows = publication.identified(read_table(spark, table), ["surrogate_key"])
    left = publication.prepare_version(rows, table, 9)  # a run that never came to its end
    assert versions(spark, table) == 3 and publication.expire_versions(spark, [table]) == 1
    assert versions(spark, table) == 2 and seen(spark, table)[0][0].count("city='4'") == 1
    assert left not in publication.manifest(spark)


def test_a_name_that_was_a_table_becomes_a_view(spark):
    entry = source(name("people"))
    spark.sql("CREATE DATABASE IF NOT EXISTS dim")
    people(spark, (9, "old", "x")).write.saveAsTable(f"dim.{entry.source_name}")
    Warehouse(spark, 1, DAYS[0]).run([entry], data={entry.source_name: people(spark, (1, "a", "x"))})
    assert [row.id for row in read_table(spark, f"dim.{entry.source_name}").collect()] == [1]


def test_a_version_is_read_by_its_files_only(spark):
    entry = source(name("people"))
    for batch in (1, 2):
        run = Warehouse(spark, batch, DAYS[batch - 1])
        run.run([entry], data={entry.source_name: people(spark, (1, "a", str(batch)))})
    view = read_table(spark, f"dim.{entry.source_name}")
    assert [row.city for row in view.collect()] == ["2"]
    assert len(view.select(F.input_file_name()).distinct().collect()) == 1
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_version" in plan


def rows_of(draw, spark):
    return people(spark, *[(k, f"n{draw.randrange(2)}", draw.choice("xyz")) for k in range(6) if draw.random() < 0.7])


@pytest.mark.parametrize(("seed", "kind"), [(1, "Full"), (2, "Full"), (3, "Delta"), (4, "Delta")])
def test_a_repeated_run_gives_the_history_of_its_new_rows(spark, seed, kind):
    draw = random.Random(seed)
    entry = source(name("people"), 2, kind)
    loads = {batch: rows_of(draw, spark) for batch in (1, 2, 3, 4)}
    schedule = [1, 2, 3, 4, draw.choice([1, 2, 3]), draw.choice([1, 2, 3])]
    for k, batch in enumerate(schedule):
        if k > 3:
            loads[batch] = rows_of(draw, spark)
        Warehouse(spark, batch, DAYS[0] + timedelta(days=batch)).run([entry], data={entry.source_name: loads[batch]})
    plain = source(name("people"), 2, kind)
    for batch, rows in loads.items():
        Warehouse(spark, batch, DAYS[0] + timedelta(days=batch)).run([plain], data={plain.source_name: rows})
    run = Warehouse(spark, 4, DAYS[0] + timedelta(days=4))
    columns = ["id", "name", "city", "valid_from", "valid_to", "is_current"]
    got, wanted = (sorted(map(str, run.full_history(s).select(*columns).collect())) for s in (entry, plain))
    assert got == wanted
    members = [
        sorted(map(str, read_table(spark, f"dim.{s.source_name}").select("id", "name", "city", "valid_from").collect()))
        for s in (entry, plain)
    ]
    assert members[0] == members[1]


def test_surrogate_keys_stay_when_an_older_run_is_repeated(spark):
    entry = source(name("people"))
    loads = [(1, people(spark, (1, "a", "x"))), (2, people(spark, (1, "a", "x"), (5, "e", "x"))), (3, people(spark, (1, "a", "x"), (5, "e", "x"), (6, "f", "x")))]
    loads.append((2, people(spark, (1, "a", "y"), (4, "d", "x"), (6, "f", "x"))))
    for batch, rows in loads:
        found = Warehouse(spark, batch, DAYS[batch - 1]).run([entry], data={entry.source_name: rows})[entry.source_name]
    assert {(row.surrogate_key, row.id) for row in found.collect()} == {(1, 1), (2, 5), (3, 6)}


def test_facts_show_the_newest_run_when_an_older_one_is_repeated(spark):
    persons, full = source(name("people")), source(name("sales"))
    delta = replace(full, load_type="Delta")
    spec = Fact(name("sales"), full.source_name, {"person_key": (persons.source_name, {"person": "id"})}, ["id", "amount"])
    rows = lambda *r: spark.createDataFrame(list(r), "id int, person int, amount int")
    loads = [(1, full, rows((1, 1, 5))), (2, delta, rows((2, 1, 6))), (3, delta, rows((1, 2, 7))), (2, delta, rows((1, 1, 1), (3, 2, 8)))]
    for batch, entry, data in loads:
        run = Warehouse(spark, batch, DAYS[batch - 1])
        members = people(spark, (1, "a", "x"), (2, "b", str(batch)))
        found = run.run([persons, entry], [spec], data={persons.source_name: members, entry.source_name: data})
    assert {(r.person_key, r.id, r.amount) for r in found[spec.name].collect()} == {(2, 1, 7), (2, 3, 8)}
    assert {r.city for r in found[persons.source_name].collect()} == {"x", "3"}


def test_a_redo_that_was_cut_off_is_finished_by_the_next_run(spark, monkeypatch):
    entry = source(name("people"))
    loads = {1: people(spark, (1, "a", "x")), 2: people(spark, (1, "a", "y")), 3: people(spark, (1, "a", "z"))}
    for batch, rows in loads.items():
        Warehouse(spark, batch, DAYS[batch - 1]).run([entry], data={entry.source_name: rows})
    kept = Warehouse.keep_history

    def broken(self, source, staged, location=""):
        if self.batch_id == 3:
            raise RuntimeError("lost")
        return kept(self, source, staged, location)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "keep_history", broken)
        with pytest.raises(RuntimeError, match="lost"):
            Warehouse(spark, 2, DAYS[1]).run([entry], data={entry.source_name: people(spark, (1, "a", "z"))})
    assert read_table(spark, f"dim.{entry.source_name}").first().valid_from == DAYS[2]
    with pytest.raises(RuntimeError, match="must be done again"):
        Warehouse(spark, 3, DAYS[2]).full_history(entry)
    run = Warehouse(spark, 4, DAYS[0] + timedelta(days=9))
    run.run([entry], data={entry.source_name: people(spark, (1, "a", "z"))})
    assert {(r.city, r.valid_from, r.valid_to) for r in run.full_history(entry).collect()} == {("x", DAYS[0], DAYS[1]), ("z", DAYS[1], None)}


def test_runs_that_cannot_be_repeated_are_refused(spark, monkeypatch):
    first = source(name("people"), 1)
    rows = lambda city: people(spark, (1, "a", city))
    for batch in (1, 2, 3, 4):
        at = DAYS[0] + timedelta(days=batch)
        Warehouse(spark, batch, at).run([first], data={first.source_name: rows(str(batch))})
    before = seen(spark, f"psh.{first.source_name}")
    with pytest.raises(ValueError, match="type 1"):
        Warehouse(spark, 2, DAYS[0] + timedelta(days=2)).run([first], data={first.source_name: rows("q")})
    with pytest.raises(ValueError, match="time between"):
        Warehouse(spark, 3, DAYS[0] + timedelta(days=8)).run([first], data={first.source_name: rows("q")})
    monkeypatch.setattr(warehouse, "REDONE", 0)
    Warehouse(spark, 4, DAYS[0] + timedelta(days=4)).run([first], data={first.source_name: rows("4")})
    with pytest.raises(ValueError, match="not noted"):
        Warehouse(spark, 3, DAYS[0] + timedelta(days=3)).run([first], data={first.source_name: rows("q")})
    assert seen(spark, f"psh.{first.source_name}") == before
