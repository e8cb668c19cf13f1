"""Contracts at their edges: reruns, guards, drift, headers, connections, plan shapes."""

import os
import uuid
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sediment.functions.hashing import add_row_hash
from sediment.operators import compare, history, model, quality
from sediment.operators.skew import lookup_join
from sediment.plans import warehouse
from sediment.plans.medallion import Medallion, silver_delta, first_silver
from sediment.queries.registry import QUERIES
from sediment.session import scratch_path
from sediment.sinks import tables as sinks
from sediment.sources import control, files, payload
from sediment.sources.tables import read_table

DAYS = [datetime(2026, 1, d) for d in range(1, 6)]


def name(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, name string, city string")


def source(label, load="Full", kind=2, key="id"):
    row = {"Source_Type": "table", "Source_Name": label, "Connection": "none", "Primary Key": key, "Load Type": load}
    return control.source(row | {"SCD Type": kind})


def exchanges(df):
    """Shuffles of a plan, before adaptive execution and without broadcasts."""
    spark = df.sparkSession
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return sum(1 for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_counts_take_one_shuffle_of_keys_and_one_of_outcomes(tables):
    orders = add_row_hash(tables("orders"), ["o_orderstatus"])
    assert exchanges(compare.count_by_key(orders, orders, "o_orderkey")) == 2


def test_keyless_comparison_shuffles_each_side_once(tables):
    documents = add_row_hash(tables("documents"), ["text"])
    assert exchanges(compare.compare_by_hash(documents, documents)) == 2


def test_newest_versions_and_join_share_a_shuffle(spark, tables):
    silver = first_silver(tables("orders"), at=DAYS[0])
    assert exchanges(silver_delta(silver, tables("orders"), "o_orderkey")) == 2


def test_counts_refuse_repeated_keys_and_match_nulls(spark):
    a = add_row_hash(people(spark, (None, "a", "x"), (1, "b", "x")), ["city"])
    b = add_row_hash(people(spark, (None, "a", "y"), (2, "b", "x")), ["city"])
    found = {r["status"]: r["n"] for r in compare.count_by_key(a, b, "id").collect()}
    assert found == {"changed": 1, "deleted": 1, "new": 1}
    for sides, word in (((a.union(a), b), "current"), ((a, b.union(b)), "new")):
        with pytest.raises(PySparkException, match=f"found in {word}"):
            compare.count_by_key(*sides, "id").collect()


def test_empty_rerun_leaves_nothing(spark):
    table = f"staging.{name('batch')}"
    rows = people(spark, (1, "a", "x"), (2, "b", "y"))
    assert sinks.write_batch(rows, table, 1, ["city"]) == {"rows": 2}
    assert sinks.write_batch(rows, table, 2, ["city"]) == {"rows": 2}
    assert sinks.write_batch(rows.where("id = 1"), table, 2, ["city"]) == {"rows": 1}
    assert {(r.id, r.batch_id) for r in read_table(spark, table).collect()} == {(1, 1), (2, 1), (1, 2)}
    assert sinks.write_batch(rows.limit(0), table, 2, ["city"]) == {"rows": 0}
    assert sinks.batches(spark, table) == [1]
    odd = rows.withColumn("city", F.when(F.col("id") == 1, "a/b=c d"))
    sinks.write_batch(odd, table, 3, ["city"])
    sinks.write_batch(odd, table, 3, ["city"])
    assert read_table(spark, table).where("batch_id = 3").count() == 2


def test_publishing_keeps_columns_or_changes_them(spark):
    table = f"staging.{name('moved')}"
    sinks.replace_table(people(spark, (1, "a", "x")), table)
    before = read_table(spark, table)
    sinks.replace_table(people(spark, (2, "b", "y")), table)
    assert [r.id for r in read_table(spark, table).collect()] == [2]
    assert [r.id for r in before.collect()] in ([1], [2])  # planned before: the old files are still there
    sinks.replace_table(people(spark, (3, "c", "z")).drop("city"), table)
    assert read_table(spark, table).columns == ["id", "name"]


def test_first_loads_refuse_repeated_keys(spark):
    double = people(spark, (1, "a", "x"), (1, "b", "x"))
    with pytest.raises(PySparkException, match="Duplicate keys"):
        Medallion(spark, name("people"), ["id"]).run(double, 1, DAYS[0])
    entry = source(name("people"))
    with pytest.raises(PySparkException, match="Duplicate keys"):
        warehouse.Warehouse(spark, 1, DAYS[0]).run([entry], data={entry.source_name: double})


def test_reserved_names_are_refused(spark):
    clash = people(spark, (1, "a", "x")).withColumnRenamed("city", "status")
    with pytest.raises(ValueError, match="status"):
        Medallion(spark, name("people"), ["id"]).run(clash, 1, DAYS[0])
    hashed = add_row_hash(clash, ["name"])
    with pytest.raises(ValueError, match="status"):
        compare.compare_by_key(hashed, hashed, "id")
    entry = source(name("people"))
    with pytest.raises(ValueError, match="valid_from"):
        dated = people(spark, (1, "a", "x")).withColumnRenamed("city", "valid_from")
        warehouse.Warehouse(spark, 1, DAYS[0]).run([entry], data={entry.source_name: dated})


def test_drift_is_an_error(spark):
    first = people(spark, (1, "a", "x"))
    wider = first.withColumn("extra", F.lit(1))
    opened = history.open_history(first, F.lit("2026-01-01"))
    for merge in (
        lambda: history.merge_type1(first, wider, "id", ["city"]),
        lambda: history.merge_type2(opened, wider, "id", F.lit("2026-01-02"), ["city"]),
        lambda: silver_delta(first_silver(first, at=DAYS[0]), wider, "id", ["city"]),
    ):
        with pytest.raises(ValueError, match="extra"):
            merge()


def test_a_broken_key_leaves_the_tables_of_the_run_before(spark):
    persons, sold = source(name("people")), source(name("sales"))
    spec = warehouse.Fact(name("sales"), sold.source_name, {"person_key": (persons.source_name, {"person": "id"})}, ["id"])
    rule = quality.ForeignKey(spec.name, persons.source_name, (("person_key", "surrogate_key"),))
    sales = spark.createDataFrame([(1, 1), (2, 1)], "id int, person int")
    data = {persons.source_name: people(spark, (1, "a", "x")), sold.source_name: sales}
    warehouse.Warehouse(spark, 1, DAYS[0]).run([persons, sold], [spec], [rule], data)
    broken = data | {sold.source_name: sales.withColumn("person", F.col("id") + 6)}
    with pytest.raises(quality.KeyViolation) as raised:
        warehouse.Warehouse(spark, 2, DAYS[1]).run([persons, sold], [spec], [rule], broken)
    assert [(r.table_name, r.n) for r in raised.value.report.collect()] == [(spec.name, 2)]
    assert {(r.person_key, r.id) for r in read_table(spark, f"fact.{spec.name}").collect()} == {(1, 1), (1, 2)}
    assert not [t for t in spark.catalog.listTables("fact") if t.name.startswith(f"{spec.name}_") and not t.name.endswith("_rows")]


def test_delta_facts_follow_the_last_full_load(spark):
    persons, full = source(name("people")), source(name("sales"))
    delta = source(full.source_name, "Delta")
    spec = warehouse.Fact(name("sales"), full.source_name, {"person_key": (persons.source_name, {"person": "id"})}, ["id", "amount"])
    rows = lambda *r: spark.createDataFrame(list(r), "id int, person int, amount int")
    loads = [(full, rows((1, 1, 5), (2, 1, 6))), (delta, rows((2, 1, 7), (3, 1, 8))), (full, rows((9, 1, 9))), (delta, rows((4, 1, 4)))]
    wanted = [{(1, 5), (2, 6)}, {(1, 5), (2, 7), (3, 8)}, {(9, 9)}, {(9, 9), (4, 4)}]
    for batch, ((entry, data), expected) in enumerate(zip(loads, wanted, strict=True), 1):
        run = warehouse.Warehouse(spark, batch, DAYS[batch - 1])
        found = run.run([persons, entry], [spec], data={persons.source_name: people(spark, (1, "a", "x")), entry.source_name: data})
        assert {(r.id, r.amount) for r in found[spec.name].collect()} == expected


def test_lookups_accept_integers_of_either_width(spark, everything_hot):
    left = spark.range(2000).selectExpr("cast(id % 3 as int) as k", "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    found = lookup_join(left, right, ["k"])
    assert {(r.k, r.v) for r in found.collect()} == {(0, "a"), (1, "b"), (2, None)} and found.count() == 2000
    with pytest.raises(TypeError):
        lookup_join(left, right.withColumn("k", F.col("k").cast("string")), ["k"])


@pytest.fixture
def everything_hot(spark):
    spark.conf.set("spark.sediment.splitBytes", "8b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sediment.splitBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_point_in_time_ignores_versions_that_hold_at_no_time(spark, monkeypatch):
    spans = spark.sql(
        "SELECT 1 AS k, timestamp_ntz'2026-01-02' AS valid_from, timestamp_ntz'2026-01-02' AS valid_to, 'zero' AS v "
        "UNION ALL SELECT 1, timestamp_ntz'2026-01-02', timestamp_ntz'2026-01-03', 'b' "
        "UNION ALL SELECT 1, null, timestamp_ntz'2026-01-09', 'open' UNION ALL SELECT 2, null, null, 'n'"
    )
    rows = spark.sql(
        "SELECT k, at FROM VALUES (1), (2), (null) AS a(k) CROSS JOIN VALUES (timestamp_ntz'2026-01-01'), "
        "(timestamp_ntz'2026-01-02'), (timestamp_ntz'2026-01-03'), (null) AS b(at)"
    )
    found = []
    for small in (True, False):
        monkeypatch.setattr(model, "fits_broadcast", lambda df, small=small: small)
        found.append(sorted(map(str, model.point_in_time(rows, spans, "k", "at", ["v"]).collect())))
    assert found[0] == found[1] and sum("v='b'" in r for r in found[0]) == 1
    assert sum("v=None" in r for r in found[0]) == 11


def test_records_that_do_not_fit_are_errors_or_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text('amount,id\n1.5,1\noops,2\n2.5,"3"\n1,2,3\n')
    (tmp_path / "b.jsonl").write_text('{"id":1,"amount":2}\n{"id":"zz"}\n{broken\n{"id":4,"more":1}\n')
    schema = "id int, amount double"
    for file, kind, bad, good in (("a.csv", "csv", 2, {1, 3}), ("b.jsonl", "json", 2, {1, 4})):
        path = str(tmp_path / file)
        with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
            files.read_files(spark, path, kind, schema, lines=True).collect()
        kept, errored = files.read_records(spark, path, kind, schema, lines=True)
        assert {r.id for r in kept.collect()} == good and errored.count() == bad
        assert all(r.file_path.endswith(file) for r in errored.collect())
    with pytest.raises(ValueError, match="header"):
        files.read_files(spark, str(tmp_path / "a.csv"), "csv", "id int, total double")


def test_database_connections_carry_options(monkeypatch):
    monkeypatch.setenv("SEDIMENT_TEST_SECRET", "s;=x")
    text = "jdbc:sqlserver://h;databaseName=d;dbo.t;user=u;password=env:SEDIMENT_TEST_SECRET;partition_column=id;partitions=8"
    url, table, options = warehouse.database_connection(text)
    assert (url, table) == ("jdbc:sqlserver://h;databaseName=d", "dbo.t")
    assert options == {"user": "u", "password": "s;=x", "partition_column": "id", "partitions": "8"}
    assert warehouse.database_connection("jdbc:x://h/d;t") == ("jdbc:x://h/d", "t", {})


def test_a_small_delta_writes_little(spark, monkeypatch):
    def size(table, batch):
        rows = spark.table(table).where(F.col("batch_id") == batch)
        return sum(os.path.getsize(f.removeprefix("file://")) for f in {r[0] for r in rows.select(F.input_file_name()).distinct().collect()})

    written, histories = [], []
    for n in (400, 4000):
        entry = source(name("people"), "Delta")
        first = spark.range(n).selectExpr("cast(id as int) as id", "concat('name ', id) as name", "'x' as city")
        loads = [first, people(spark, (5, "name 5", "y")), people(spark, (5, "name 5", "z"), (n, "new", "x"))]
        loads += [first.where("id % 2 = 0").withColumn("city", F.lit("w")), people(spark, (7, "name 7", "y"))]
        for batch, rows in enumerate(loads, 1):
            run = warehouse.Warehouse(spark, batch, DAYS[batch - 1])
            dimension = run.run([entry], data={entry.source_name: rows})[entry.source_name]
            if batch == 3:  # again
                run.run([entry], data={entry.source_name: rows})
        written.append([size(f"psh.{entry.source_name}", b) for b in (2, 3)])
        full = run.full_history(entry)
        assert dimension.count() == n + 1 == full.where("is_current").count()
        five = {(r.city, r.valid_from, r.valid_to) for r in full.where("id = 5").collect()}
        assert five == {("x", DAYS[0], DAYS[1]), ("y", DAYS[1], DAYS[2]), ("z", DAYS[2], None)}
        assert full.where("id = 4 AND is_current").first().city == "w" and full.count() == n + 1 + 2 + n // 2 + 1
        histories.append([load.base for load in run._loads(f"psh.{entry.source_name}")])
    assert written[1] == pytest.approx(written[0], rel=0.1)
    assert histories[0] == histories[1] == [1, 1, 1, 4, 4]


def test_an_emptied_history_is_empty(spark):
    entry = source(name("people"))
    for batch, rows in enumerate((people(spark, (1, "a", "x")), people(spark), people(spark, (1, "a", "x"))), 1):
        run = warehouse.Warehouse(spark, batch, DAYS[batch - 1])
        found = run.run([entry], data={entry.source_name: rows})[entry.source_name]
        assert found.count() == rows.count()
    assert {(r.valid_from, r.valid_to) for r in run.full_history(entry).collect()} == {(DAYS[0], DAYS[1]), (DAYS[2], None)}


def test_item_lookup_warns(spark, caplog):
    rows = spark.createDataFrame([(1, "a")], "id int, title string")
    assert payload.item(rows, "2", warn=True).collect() == [] and "no record" in caplog.text
    with pytest.raises(TypeError, match="id"):
        payload.item(rows.drop("id"), 1)


def test_loads_are_found_by_their_folders(spark, tables):
    root = scratch_path(spark, "staged.json")
    from sediment.sinks.files import land

    for at in DAYS[:2]:
        land(tables("supplier").repartition(3), root, "api", at, "json")
    found = files.staged_loads(spark, root, "api", "json").orderBy("staged_at").collect()
    assert [r.staged_at for r in found] == DAYS[:2]
    assert all(spark.read.json(r.path).count() == tables("supplier").count() for r in found)


def test_optional_operators_are_optional(tmp_path):
    """Without the optional folder the entry module still imports and lists the other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(QUERIES)), "True"], said.stderr
