"""Dimensions and facts carried on by changes: equal to those written whole, and small."""

import re
from dataclasses import replace
from datetime import timedelta
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from sediment.plans.warehouse import Fact, Warehouse
from sediment.sinks import publication
from sediment.sources.tables import read_table
from tests.test_history import DAYS, name, people, source


def day(batch):
    return DAYS[0] + timedelta(days=batch)


def state(spark, table, age=0):
    return next(e for e in publication.manifest(spark) if e.table == table and e.age == age)


def rows(df):
    return sorted(map(str, df.collect()))


def crowd(spark, n, **cities):
    changed = {int(key[1:]): city for key, city in cities.items()}
    return people(spark, *[(i, f"n{i}", changed.get(i, "x")) for i in range(1, n + 1) if changed.get(i) != "gone"])


def part_bytes(spark, entry, part):
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {entry.storage}").where("col_name = 'Location'").first().data_type
    folder = Path(unquote(urlparse(location).path)) / f"_version={part}"
    return sum(file.stat().st_size for file in folder.glob("*.parquet"))


def test_a_dimension_is_carried_on_by_what_changed(spark):
    entry = source(name("people"))
    table = f"dim.{entry.source_name}"

    def load(batch, frame, **more):
        return Warehouse(spark, batch, day(batch), **more).run([entry], data={entry.source_name: frame})[entry.source_name]

    load(1, crowd(spark, 60))
    found = load(2, crowd(spark, 61, p3="y", p4="gone"))
    first, second = state(spark, table, 1), state(spark, table)
    assert second.parts[:-1] == first.parts and second.follows == first.state
    assert publication.last_changes(spark, second).where("NOT _gone").count() == 2
    seen = {r.id: r.city for r in read_table(spark, table).collect()}
    assert len(seen) == 60 and seen[3] == "y" and 4 not in seen and seen[61] == "x"
    assert rows(found) == rows(read_table(spark, table))
    assert rows(publication.read_published(spark, table, 1).select("id", "city")) == rows(crowd(spark, 60).select("id", "city"))

    load(3, crowd(spark, 61, p3="x"))  # a member comes back
    third = rows(read_table(spark, table))
    assert len(state(spark, table).parts) == 3 and len(third) == 61
    load(3, crowd(spark, 61, p3="x"), rebuild=True)
    assert len(state(spark, table).parts) == 1 and rows(read_table(spark, table)) == third


def test_repeated_and_failed_runs_follow_the_right_state(spark):
    entry = source(name("people"))
    table = f"dim.{entry.source_name}"

    def load(batch, frame, announce=None):
        return Warehouse(spark, batch, day(batch), announce=announce).run([entry], data={entry.source_name: frame})

    def stop(published):
        raise RuntimeError("stop")

    load(1, crowd(spark, 40))
    with pytest.raises(RuntimeError, match="stop"):
        load(2, crowd(spark, 40, p5="wrong"), stop)
    assert {r.city for r in read_table(spark, table).collect()} == {"x"}
    assert spark.sql(f"SHOW PARTITIONS {state(spark, table).storage}").count() == 1
    load(2, crowd(spark, 40, p6="y"))
    assert {r.id for r in read_table(spark, table).where("city <> 'x'").collect()} == {6}
    load(2, crowd(spark, 40, p7="z"))  # repeated with other rows: derived from load 1 again
    assert len(state(spark, table).parts) == 2
    assert {r.id for r in read_table(spark, table).where("city <> 'x'").collect()} == {7}
    load(3, crowd(spark, 40, p8="z"))
    assert {r.id for r in read_table(spark, table).where("city <> 'x'").collect()} == {8}
    load(2, crowd(spark, 40, p9="q"))  # an older one: load 3 is done again
    assert {r.id for r in read_table(spark, table).where("city <> 'x'").collect()} == {8}
    parts = {part for e in publication.manifest(spark) if e.table == table for part in e.parts}
    assert spark.sql(f"SHOW PARTITIONS {state(spark, table).storage}").count() == len(parts)


def test_transformed_dimensions_are_whole_unless_row_wise(spark):
    plain, by_row = source(name("plain")), source(name("by_row"))
    step = lambda df, s: df.where("city <> 'hidden'").withColumn("city", F.upper("city"))
    steps = {plain.source_name: step, by_row.source_name: step}
    for batch, frame in enumerate([crowd(spark, 20), crowd(spark, 20, p1="hidden", p2="y")], 1):
        run = Warehouse(spark, batch, day(batch), steps, row_wise={by_row.source_name}, unknown_member=batch == 1)
        run.run([plain, by_row], data={plain.source_name: frame, by_row.source_name: frame})
    tables = [f"dim.{e.source_name}" for e in (plain, by_row)]
    assert [len(state(spark, table).parts) for table in tables] == [1, 2]
    first, second = (rows(read_table(spark, table).select("surrogate_key", "id", "city")) for table in tables)
    assert first == second and len(first) == 19


def test_many_changes_are_folded(spark, monkeypatch):
    monkeypatch.setattr(publication, "MOST_CHANGES", 2)
    entry = source(name("people"))
    table, moved = f"dim.{entry.source_name}", {}
    for batch in range(1, 7):
        frame = crowd(spark, 60, **moved)
        Warehouse(spark, batch, day(batch)).run([entry], data={entry.source_name: frame})
        assert len(state(spark, table).parts) <= 4
        assert rows(read_table(spark, table).select("id", "city")) == rows(frame.select("id", "city"))
        moved = {**moved, f"p{batch}": "gone" if batch % 2 else "y"}
    assert state(spark, table).rows == 60


@pytest.mark.parametrize("as_of", [False, True])
def test_a_fact_is_carried_on_by_its_loads_and_by_changed_members(spark, as_of):
    persons, sold = source(name("people")), source(name("sales"))
    delta = replace(sold, load_type="Delta")
    held = {"person_key": ("sold_at", {"city_then": "city"})} if as_of else {}
    held = {key: (at, {attribute: column for column, attribute in names.items()}) for key, (at, names) in held.items()}
    columns = ["id", "amount", *(["city_then"] if as_of else [])]
    keys = {"person_key": (persons.source_name, {"person": "id"})}
    spec = Fact(name("sales"), sold.source_name, keys, columns, as_of=held)
    table = f"fact.{spec.name}"

    def sales(*found):
        made = spark.createDataFrame(list(found), "id int, person int, amount int, days int")
        at = F.to_timestamp_ntz(F.lit(str(day(0)))) + F.make_dt_interval("days")
        return made.withColumn("sold_at", at).drop("days")

    first = [(i, i % 45, i, 1 + i % 9) for i in range(1, 201)]  # 41 to 44 and 0 are not known yet
    loads = [
        (sold, sales(*first), crowd(spark, 40)),
        (delta, sales((5, 2, -5, 3), (300, 41, 1, 3)), crowd(spark, 41, p3="y")),
        (delta, sales((6, 6, -6, 9)), crowd(spark, 41, p3="y", p7="gone")),
    ]
    for batch, (entry, found, members) in enumerate(loads, 1):
        run = Warehouse(spark, batch, day(batch))
        run.run([persons, entry], [spec], data={persons.source_name: members, entry.source_name: found})
    assert len(state(spark, table).parts) == 3
    kept = rows(read_table(spark, table))
    written = publication.last_changes(spark, state(spark, table))
    assert {r.id for r in written.collect()} == {6} | {i for i in range(1, 201) if i % 45 == 7}
    replace(run, rebuild=True).run([persons, entry], [spec], data={persons.source_name: members, entry.source_name: found})
    assert len(state(spark, table).parts) == 1 and rows(read_table(spark, table)) == kept and len(kept) == 201


def test_a_small_change_writes_little(spark, tables):
    persons, sold = source(name("people")), source(name("sales"))
    delta = replace(sold, load_type="Delta")
    spec = Fact(name("sales"), sold.source_name, {"key": (persons.source_name, {"person": "id"})}, ["id", "note"])
    members = tables("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.sha2("c_name", 512).alias("city"))
    facts = tables("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person"), F.sha2(F.col("o_orderkey").cast("string"), 512).alias("note"))
    key = members.agg(F.min("id")).first()[0]
    later = members.withColumn("city", F.when(F.col("id") == key, "moved").otherwise(F.col("city")))
    one = facts.limit(1).withColumn("note", F.lit("new"))
    for batch, entry, frame, found in ((1, sold, members, facts), (2, delta, later, one)):
        run = Warehouse(spark, batch, day(batch))
        run.run([persons, entry], [spec], data={persons.source_name: frame, entry.source_name: found})
    for table in (f"dim.{persons.source_name}", f"fact.{spec.name}"):
        entry = state(spark, table)
        assert part_bytes(spark, entry, entry.parts[-1]) * 4 < part_bytes(spark, entry, entry.parts[0])
        assert entry.changed <= 3
    view = read_table(spark, f"dim.{persons.source_name}")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\n]*array_position\(", plan)) == 2
