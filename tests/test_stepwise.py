"""Newest rows and totals kept by steps, against drawing them from the whole log."""

import os
import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sediment.operators.model import gold
from sediment.plans import stepwise
from sediment.plans.medallion import Medallion, newest_first
from sediment.sources.tables import read_table
from tests.test_history import DAYS, name

SCHEMA = "id int, part string, city string, amount decimal(10,2), weight double, n int"
RULES = {
    "group_by": ["city"],
    "measures": {
        "rows": ("count", "*"),
        "known": ("count", "amount"),
        "total": ("sum", "amount"),
        "n": ("sum", "n"),
        "mean": ("avg", "n"),
        "heaviest": ("max", "weight"),
        "least": ("min", "n"),
        "weight": ("sum", "weight"),
        "parts": ("count_distinct", "part"),
    },
}


def load(draw, spark, share=0.7):
    rows = []
    for k in [None, *range(8)]:
        if draw.random() < share:
            amount = None if draw.random() < 0.3 else Decimal(draw.randrange(-500, 500)) / 100
            city = draw.choice([None, "x", "y", "z"])
            rows.append((k, "p", city, amount, float(draw.randrange(4)), draw.choice([None, 1, 2, 3])))
    return spark.createDataFrame(rows, SCHEMA)


def plain(layers, rules=None):
    """Gold as drawn from the whole of silver."""
    silver = read_table(layers.spark, layers.silver_table)
    return gold(silver, layers.keys, newest_first(silver), rules)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gold_equals_what_the_whole_log_gives(spark, seed, monkeypatch):
    draw = random.Random(seed)
    # Small buckets, so that some load outgrows them.
    layers = Medallion(spark, name("things"), ["id", "part"], bucket_rows=draw.choice([1, 3, 100]))
    monkeypatch.setattr(stepwise, "OUTGROWN", draw.choice([1, 4]))
    monkeypatch.setattr(stepwise, "ADDED_UP", draw.choice([0, 4]))
    schedule = [1, 2, 3, draw.choice([2, 3]), 4, 4, draw.choice([1, 2])]
    for batch in schedule:
        at = DAYS[0] + timedelta(days=batch)
        layers.load_bronze(load(draw, spark, draw.choice([0.2, 0.8])), at)
        layers.load_silver(batch, at, delta=batch > 1 and draw.random() < 0.5)
        layers.load_gold(at, RULES)
        kept = read_table(spark, layers.gold_table)
        wanted = plain(layers, RULES)
        assert kept.drop("source", "version", "ingestion_timestamp").dtypes == wanted.dtypes
        assert rows(kept.select(*wanted.columns)) == rows(wanted)
        assert {row.ingestion_timestamp for row in kept.collect()} <= {at}
    layers.load_gold(DAYS[0])
    columns = ["id", "part", "city", "amount", "weight", "n"]
    assert rows(read_table(spark, layers.gold_table).select(*columns)) == rows(plain(layers).select(*columns))
    steps = layers.newest().steps
    assert len({part[0] for part in steps.parts()}) <= len(steps.noted()) <= 9


def files_read(df):
    return sum(os.path.getsize(path.removeprefix("file://")) for path in df.inputFiles())


def test_a_small_delta_reads_a_bucket_however_long_the_log(spark):
    layers = Medallion(spark, name("things"), ["id"], bucket_rows=100)
    first = spark.range(4000).selectExpr("cast(id as int) AS id", "concat('thing ', id) AS label", "id % 7 AS n")
    layers.run(first, 1, DAYS[0])
    read = []
    for batch in range(2, 14):
        at = DAYS[0] + timedelta(days=batch)
        one = spark.createDataFrame([(5, "thing", batch)], "id int, label string, n long")
        assert layers.run(one, batch, at, delta=True)["changed"] == 1
        newest, steps = layers._state()
        read.append(files_read(newest.current(steps, ["label", "n"], newest.buckets_of(one, steps))))
        written = newest.steps.noted()[-1].rows
        assert 0 < written < 400  # one of forty buckets
    assert max(read) < 1.2 * min(read)
    assert read[-1] * 10 < files_read(newest.rows(steps))
    assert read_table(spark, layers.gold_table).where("n = 13").first().id == 5
    assert read_table(spark, layers.gold_table).count() == 4000
    # Of steps that nothing needs, nothing stays.
    assert len(newest.steps.parts()) == 41 and len(newest.steps.noted()) <= 4


def test_hashes_are_read_in_place_of_columns(spark):
    layers = Medallion(spark, name("things"), ["id"])
    first = spark.range(100).selectExpr("cast(id as int) AS id", "concat('thing ', id) AS label")
    layers.run(first, 1, DAYS[0])
    newest, steps = layers._state()
    plan = newest.current(steps, ["label"]).select("id", "hash_column")._jdf.queryExecution().executedPlan().toString()
    assert "label" not in plan.partition("ReadSchema")[2]
    other = newest.current(steps, ["id"])  # hashes that cover other columns are made anew
    assert other.where(F.col("hash_column") == F.sha2(F.col("id").cast("string"), 256)).count() == 100


def test_an_interrupted_load_is_made_up_for(spark, monkeypatch):
    layers = Medallion(spark, name("things"), ["id", "part"])
    draw = random.Random(5)
    layers.run(load(draw, spark), 1, DAYS[0])
    gold_before = rows(read_table(spark, layers.gold_table))
    for lost in ("note", "write"):
        with monkeypatch.context() as patch:
            def fail(*_, **__):
                raise RuntimeError("lost")

            patch.setattr(stepwise.Steps, lost, fail)
            with pytest.raises(RuntimeError, match="lost"):
                layers.run(load(draw, spark), 2, DAYS[1])
        assert rows(read_table(spark, layers.gold_table)) == gold_before
    layers.run(load(draw, spark), 3, DAYS[2])
    columns = ["id", "part", "city", "amount", "weight", "n"]
    assert rows(read_table(spark, layers.gold_table).select(*columns)) == rows(plain(layers).select(*columns))


def test_totals_write_only_what_a_load_changes(spark):
    layers = Medallion(spark, name("things"), ["id"])
    rules = {"group_by": ["grp"], "measures": {"n": ("sum", "n"), "most": ("max", "n")}}
    first = spark.range(1000).selectExpr("cast(id as int) AS id", "id % 200 AS grp", "id AS n")
    layers.load_bronze(first, DAYS[0])
    layers.load_silver(1, DAYS[0])
    layers.load_gold(DAYS[0], rules)
    one = spark.createDataFrame([(3, 4, 10_000)], "id int, grp long, n long")
    layers.load_bronze(one, DAYS[1])
    layers.load_silver(2, DAYS[1], delta=True)
    layers.load_gold(DAYS[1], rules)
    totals = stepwise.Totals(layers._state()[0], layers.gold_table, rules["group_by"], rules["measures"])
    assert [(step.whole, step.rows) for step in totals.steps.noted()] == [(1, 200), (0, 2)]
    found = {row.grp: (row.n, row.most) for row in read_table(spark, layers.gold_table).where("grp IN (3, 4)").collect()}
    assert found == {3: (203 + 403 + 603 + 803, 803), 4: (4 + 204 + 404 + 604 + 804 + 10_000, 10_000)}
    layers.load_gold(DAYS[1], {"group_by": ["grp"], "measures": {"rows": ("count", "*")}})
    assert read_table(spark, layers.gold_table).agg(F.sum("rows")).first()[0] == 1000
    left = [t.name for t in spark.catalog.listTables("gold_layer") if t.name.startswith(layers.gold_table.split(".")[1] + "_totals")]
    assert len(left) == 1


def test_hashes_are_kept_as_bytes_and_totals_match_no_keys(spark, monkeypatch):
    layers = Medallion(spark, name("things"), ["id"])
    rules = {"group_by": ["grp"], "measures": {"n": ("sum", "n"), "most": ("max", "n")}}
    rows_of = [[(1, "a", 5), (2, "a", 7), (3, "b", 7), (4, "c", 1)], [(1, "b", 7), (2, "a", 7), (3, "a", 5), (4, "c", 1)]]
    matched = []
    pairs = stepwise.NullSafeKeys
    monkeypatch.setattr(stepwise, "NullSafeKeys", lambda a, b, keys: matched.append(keys) or pairs(a, b, keys))
    for batch, held in enumerate(rows_of, 1):
        layers.load_bronze(spark.createDataFrame(held, "id int, grp string, n long"), DAYS[batch - 1])
        layers.load_silver(batch, DAYS[batch - 1])
        layers.load_gold(DAYS[batch - 1], rules)
    # Rows changed places between groups, whose counts stayed.
    found = {row.grp: (row.n, row.most) for row in read_table(spark, layers.gold_table).collect()}
    assert found == {"a": (12, 7), "b": (7, 7), "c": (1, 1)}
    assert matched and all(keys == ["grp"] for keys in matched)
    newest, steps = layers._state()
    kept = newest.rows(steps).where("id = 1").first().hash_column
    assert bytes(kept).hex() == newest.current(steps, ["grp", "n"]).where("id = 1").first().hash_column
