"""History, surrogate keys, layers and warehouse over several loads."""

import uuid
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sediment.functions.lineage import add_metadata, batch_time
from sediment.functions.types import table_types
from sediment.operators import history, keys, quality
from sediment.plans.medallion import Medallion
from sediment.plans.warehouse import Fact, Warehouse, create_control_table
from sediment.session import scratch_path
from sediment.sinks import tables as sinks
from sediment.sources import control
from sediment.sources.tables import list_tables, read_table, table_exists

DAYS = [datetime(2026, 1, day) for day in range(1, 6)]


def name(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


def people(spark, *values):
    return spark.createDataFrame(list(values), "id int, name string, city string")


def test_versions_neither_overlap_nor_leave_gaps(tables):
    found = history.versions(tables("events"), "user_id", ["ts", "event_id"], ["event_type"])
    current = found.where("is_current").groupBy("user_id").count().where("count <> 1")
    assert current.isEmpty()
    ends = found.where("valid_to IS NOT NULL").select("user_id", F.col("valid_to").alias("valid_from"))
    assert ends.join(found, ["user_id", "valid_from"], "left_anti").isEmpty()
    assert found.where("valid_to <= valid_from").isEmpty()


def test_version_count_of_the_fixture(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    found = history.versions(events, "user_id", ["ts", "event_id"], ["event_type"])
    assert found.count() == 8016
    assert found.where("is_current").count() == 150


def test_type2_over_three_loads(spark):
    first = people(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "x"))
    open_rows = history.open_history(first, batch_time(DAYS[0]))
    closed = []
    loads = [
        people(spark, (1, "a", "y"), (2, "b", "x")),
        people(spark, (1, "a", "y"), (2, "b", "x"), (3, "c", "x")),
    ]
    for day, load in zip(DAYS[1:], loads):
        merged = history.merge_type2(open_rows, load, "id", batch_time(day))
        closed += merged.where("NOT is_current").collect()
        open_rows = spark.createDataFrame(merged.where("is_current").collect(), merged.schema)
    assert {(r.id, r.city, r.valid_from, r.valid_to) for r in closed} == {
        (1, "x", DAYS[0], DAYS[1]),
        (3, "x", DAYS[0], DAYS[1]),
    }
    assert {(r.id, r.city, r.valid_from) for r in open_rows.collect()} == {
        (1, "y", DAYS[1]),
        (2, "x", DAYS[0]),
        (3, "x", DAYS[2]),
    }


def test_type1_keeps_old_stamps_of_unchanged_rows(spark):
    current = add_metadata(people(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "x")), at=DAYS[0])
    later = add_metadata(people(spark, (1, "a", "y"), (2, "b", "x"), (4, "d", "x")), at=DAYS[1])
    full = {r.id: (r.city, r.ingestion_timestamp) for r in history.merge_type1(current, later, "id").collect()}
    assert full == {1: ("y", DAYS[1]), 2: ("x", DAYS[0]), 4: ("x", DAYS[1])}
    delta = history.merge_type1(current, later, "id", delta=True)
    assert {r.id for r in delta.collect()} == {1, 2, 3, 4}


def test_surrogate_keys_never_change(spark):
    day1 = spark.createDataFrame([("b",), ("d",), ("b",), (None,)], "k string")
    first = keys.surrogate_keys(day1, "k")
    assert {r.k: r.surrogate_key for r in first.collect()} == {None: 1, "b": 2, "d": 3}
    day2 = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    second = keys.surrogate_keys(day2, "k", first)
    assert {r.k: r.surrogate_key for r in second.collect()} == {"a": 4, "c": 5}
    assert keys.surrogate_keys(day2, "k", first.unionByName(second)).isEmpty()


def test_surrogate_keys_are_dense_over_many_partitions(tables):
    lines = tables("lineitem")
    found = keys.surrogate_keys(lines, ["l_orderkey", "l_linenumber"])
    summary = found.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("surrogate_key").alias("d"), F.max("surrogate_key").alias("m")
    ).first()
    assert summary.n == summary.d == summary.m == lines.select("l_orderkey", "l_linenumber").distinct().count()


def test_layers_over_four_loads(spark):
    layers = Medallion(spark, name("people"), ["id"], "people_api", "0.1")
    first = people(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "x"))
    second = people(spark, (1, "a", "y"), (2, "b", "x"), (4, "d", "x"))
    counts = lambda **n: {"new": 0, "changed": 0, "deleted": 0, "unchanged": 0, **n}
    assert layers.run(first, 1, DAYS[0]) == counts(new=3)
    assert layers.run(second, 2, DAYS[1]) == counts(new=1, changed=1, deleted=1)
    assert layers.run(second, 3, DAYS[2]) == counts()
    assert layers.run(second, 2, DAYS[1]) == counts(new=1, changed=1, deleted=1)
    silver = read_table(spark, layers.silver_table)
    assert silver.count() == 6
    assert sinks.batches(spark, layers.silver_table) == [1, 2]
    gold = read_table(spark, layers.gold_table)
    assert {(r.id, r.city) for r in gold.collect()} == {(1, "y"), (2, "x"), (4, "x")}
    assert gold.columns == ["id", "name", "city", "source", "version", "ingestion_timestamp"]
    assert layers.run(first, 4, DAYS[3]) == counts(new=1, changed=1, deleted=1)
    back = read_table(spark, layers.silver_table).where("batch_id = 4 AND id = 3").first()
    assert back.status == "new" and back.name == "c"


def test_silver_delta_load_keeps_absent_keys(spark):
    layers = Medallion(spark, name("people"), ["id"])
    layers.run(people(spark, (1, "a", "x"), (2, "b", "x")), 1, DAYS[0])
    assert layers.run(people(spark, (1, "a", "y")), 2, DAYS[1], delta=True)["deleted"] == 0
    assert read_table(spark, layers.gold_table).count() == 2


def test_declared_lengths_are_enforced_on_load(spark):
    wide = table_types({"columns": {"city": {"type": "String", "length": 1}}})
    layers = Medallion(spark, name("people"), ["id"], types=wide)
    layers.run(people(spark, (1, "a", "x")), 1, DAYS[0])
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH|exceeds"):
        layers.run(people(spark, (1, "a", "too long")), 2, DAYS[1])
    assert [r.city for r in read_table(spark, layers.gold_table).collect()] == ["x"]


def test_gold_rules(spark):
    layers = Medallion(spark, name("people"), ["id"])
    layers.run(people(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "y")), 1, DAYS[0])
    layers.load_gold(DAYS[0], {"group_by": ["city"], "measures": {"n": ("count", "*")}})
    assert {(r.city, r.n) for r in read_table(spark, layers.gold_table).collect()} == {("x", 2), ("y", 1)}
    with pytest.raises(ValueError):
        layers.load_gold(DAYS[0], {"group_by": ["city"], "measures": {"n": ("mode", "id")}})


def source(label, kind=2, load="Full"):
    return control.source(
        {
            "Source_Type": "table",
            "Source_Name": label,
            "Connection": "none",
            "Primary Key": ["id"],
            "Compare Columns": ["city"],
            "Load Type": load,
            "SCD Type": kind,
        }
    )


def test_warehouse_history_replays_and_prunes(spark):
    entry = source(name("people"))
    loads = {
        1: people(spark, (1, "a", "x"), (2, "b", "x")),
        2: people(spark, (1, "a", "y"), (2, "b", "x")),
        3: people(spark, (1, "a", "y")),
        4: people(spark, (1, "a", "z")),
    }
    for batch in (1, 2, 2, 3, 4, 4):
        run = Warehouse(spark, batch, DAYS[batch - 1])
        tables = run.run([entry], data={entry.source_name: loads[batch]})
    full = {(r.id, r.city, r.valid_from, r.valid_to) for r in run.full_history(entry).collect()}
    assert full == {
        (1, "x", DAYS[0], DAYS[1]),
        (1, "y", DAYS[1], DAYS[3]),
        (1, "z", DAYS[3], None),
        (2, "x", DAYS[0], DAYS[2]),
    }
    member = tables[entry.source_name].collect()
    assert [(r.surrogate_key, r.id, r.city) for r in member] == [(1, 1, "z")]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS psh.{entry.source_name}").collect()]
    assert sorted(p for p in parts if p.endswith("is_current=true")) == [
        "batch_id=3/is_current=true",
        "batch_id=4/is_current=true",
    ]


def test_control_table_drives_the_run(spark, sf_dir, tables):
    entry = source(name("customer"))
    text = scratch_path(spark, "source")
    tables("customer").write.csv(text, header=True)
    row = {
        "Source_Type": "csv",
        "Source_Name": entry.source_name,
        "Connection": text,
        "Primary Key": "c_custkey",
        "Load Type": "Full",
        "SCD Type": "2",
    }
    stored = create_control_table(spark, f"staging.{name('control')}", [row])
    plan = control.load_plan(stored)
    run = Warehouse(spark, 1, DAYS[0], schemas={entry.source_name: tables("customer").schema})
    found = run.run(plan)[entry.source_name]
    assert found.count() == tables("customer").count()
    assert found.columns[:2] == ["surrogate_key", "c_custkey"]


def test_warehouse_type1_and_delta(spark):
    entry = source(name("people"), 1, "Delta")
    Warehouse(spark, 1, DAYS[0]).run([entry], data={entry.source_name: people(spark, (1, "a", "x"), (2, "b", "x"))})
    run = Warehouse(spark, 2, DAYS[1])
    run.run([entry], data={entry.source_name: people(spark, (1, "a", "y"), (3, "c", "x"))})
    assert {(r.id, r.city, r.valid_from) for r in run.full_history(entry).collect()} == {
        (1, "y", DAYS[1]),
        (2, "x", DAYS[0]),
        (3, "x", DAYS[1]),
    }


def test_warehouse_stops_on_a_broken_key(spark):
    people_source, sales_source = source(name("people")), source(name("sales"))
    sales = spark.createDataFrame([(1, 1, 5.0), (2, 9, 7.0)], "id int, person int, amount double")
    fact = Fact(name("sales"), sales_source.source_name, {"person_key": (people_source.source_name, {"person": "id"})}, ["id", "amount"])
    data = {people_source.source_name: people(spark, (1, "a", "x")), sales_source.source_name: sales}
    run = Warehouse(spark, 1, DAYS[0])
    found = run.run([people_source, sales_source], [fact], data=data)
    assert {(r.person_key, r.id) for r in found[fact.name].collect()} == {(1, 1), (-1, 2)}
    rule = quality.ForeignKey(fact.name, people_source.source_name, (("person_key", "surrogate_key"),))
    with pytest.raises(quality.KeyViolation, match="-1"):
        run.run([people_source, sales_source], [fact], [rule], data)


def test_table_modes(spark):
    table = f"staging.{name('modes')}"
    first = people(spark, (1, "a", "x"))
    sinks.load_table(first, table)
    with pytest.raises(ValueError, match="already exists"):
        sinks.load_table(first, table, "fail")
    sinks.load_table(first.select("city", "id"), table, "append")
    assert [(r.id, r.name) for r in read_table(spark, table).orderBy("name").collect()] == [(1, None), (1, "a")]
    with pytest.raises(ValueError, match="not in table"):
        sinks.load_table(first.withColumn("extra", F.lit(1)), table, "append")
    sinks.load_table(read_table(spark, table).where("name IS NOT NULL"), table)
    assert read_table(spark, table).count() == 1
    assert table_exists(spark, table) and table.split(".")[1] in list_tables(spark, "staging")
    with pytest.raises(ValueError):
        sinks.load_table(first, table, "merge")
    with pytest.raises(ValueError, match="Failed to read"):
        read_table(spark, "staging.nothing_here")


def test_failed_replace_keeps_the_old_table(spark):
    table = f"staging.{name('safe')}"
    sinks.load_table(people(spark, (1, "a", "x")), table)
    broken = people(spark, (1, "a", "x")).withColumn("name", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(PySparkException):
        sinks.load_table(broken, table)
    assert read_table(spark, table).count() == 1
    assert [t for t in list_tables(spark, "staging") if t.startswith(table.split(".")[1])] == [table.split(".")[1]]
