"""Declared types, readers, payloads, writers, streams."""

import json
import logging
import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions import cleaning, lineage, types
from sediment.plans.extract import extract
from sediment.plans.warehouse import transform
from sediment.sinks import files as file_sinks
from sediment.sinks import tables as table_sinks
from sediment.sources import control, files, payload
from sediment.sources import tables as table_sources
from sediment.streaming import arrivals

AT = datetime(2026, 10, 25, 13, 2, 56)
PRODUCT = {"id": "integer32", "title": "string", "rating": {"rate": "float64", "count": "integer32"}}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


# --- types ------------------------------------------------------------------------


def test_record_schema():
    schema = types.record_schema({"a": "unsigned_integer64", "b": {"c": "date64", "d": "null"}, "e": "string_view"})
    assert schema.simpleString() == "struct<a:decimal(20,0),b:struct<c:date,d:void>,e:string>"
    assert [name for name, _ in types.record_fields(PRODUCT)] == ["id", "title", "rating"]
    for bad in ("varchar", None, 3):
        with pytest.raises(ValueError, match="Unsupported type"):
            types.record_schema({"a": bad})


def test_table_schema(spark, tmp_path):
    text = "columns:\n  id: {type: Integer}\n  name: {type: String, length: 5}\n  price: {type: Numeric}\n  tax: {type: Numeric, precision: 8, scale: 3}\n"
    schema = types.load_table_schema(spark, write(tmp_path / "schema.yaml", text))
    found = {name: t.simpleString() for name, t in types.table_types(schema).items()}
    assert found == {"id": "int", "name": "varchar(5)", "price": "decimal(10,2)", "tax": "decimal(8,3)"}
    assert types.table_types({}) == {} == types.table_types({"columns": None})
    with pytest.raises(ValueError, match="Unsupported type 'Blob'"):
        types.table_types({"columns": {"x": {"type": "Blob"}}})


def test_every_declared_type_writes_and_reads(spark, tmp_path):
    schema = types.record_schema({f"c_{token}": token for token in types.INGEST_TYPES})
    path = str(tmp_path / "all")
    file_sinks.write_parquet(spark.range(1).drop("id"), path, schema)
    back = spark.read.parquet(path)
    assert back.columns == schema.names
    assert back.schema["c_unsigned_integer64"].dataType == T.DecimalType(20, 0)


def test_apply_types(spark):
    df = spark.sql("SELECT '7' AS n, 2.345D AS p, named_struct('a', 1) AS j, 'x' AS other")
    schema = {"columns": {"n": {"type": "BigInteger"}, "p": {"type": "Numeric"}, "j": {"type": "JSON"}, "none": {"type": "Text"}}}
    row = types.apply_types(df, types.table_types(schema)).first()
    assert row.n == 7 and str(row.p) == "2.35" and json.loads(row.j) == {"a": 1} and row.other == "x"
    with pytest.raises(PySparkException):
        types.apply_types(spark.sql("SELECT 'x' AS n"), types.table_types({"columns": {"n": {"type": "Integer"}}})).collect()


def test_metadata_is_one_stamp_per_batch(spark):
    stamped = lineage.add_metadata(spark.range(3))
    rows = stamped.collect()
    assert {(r.source, r.version) for r in rows} == {("unknown", "1.0")}
    assert len({r.ingestion_timestamp for r in rows}) == 1
    again = lineage.add_metadata(stamped, "s", "2", AT)
    assert again.columns == stamped.columns
    assert again.first().ingestion_timestamp == AT
    assert isinstance(again.schema["ingestion_timestamp"].dataType, T.TimestampNTZType)


def test_cleaning(spark):
    df = spark.createDataFrame([(" a ", "  ", "X")], "p string, q string, r string")
    assert cleaning.clean(df).first() == ("a", None, "X")
    assert cleaning.clean(df, {"r": ["lower"]}).first() == (" a ", "  ", "x")
    with pytest.raises(KeyError):
        cleaning.clean(df, {"nope": ["trim"]})
    with pytest.raises(ValueError):
        cleaning.clean(df, {"p": ["reverse"]})


# --- files ------------------------------------------------------------------------


def test_format_dispatch(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported file_type 'xml'"):
        files.read_files(spark, "x", "xml")
    document = write(tmp_path / "a.json", '[{"id": 1, "t": "x\\ny"},\n {"id": 2}]')
    assert files.read_files(spark, document, "json", "id int, t string").collect() == [(1, "x\ny"), (2, None)]
    text = write(tmp_path / "a.csv", 'id,t\n1,"say ""hi"", you\nthere"\n2, padded \n')
    found = files.read_files(spark, text, "csv")
    assert found.collect() == [(1, 'say "hi", you\nthere'), (2, " padded ")]


def test_object_path_and_missing_object(spark, tmp_path):
    assert files.object_path("s3a://", "b", "k/f.csv") == "s3a://b/k/f.csv"
    write(tmp_path / "b" / "k.csv", "id\n4\n")
    assert files.read_object(spark, "b", "k.csv", "csv", str(tmp_path)).first().id == 4
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        files.read_object(spark, "b", "none.csv", "csv", str(tmp_path))


def test_write_csv_follows_the_field_names(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, named_struct('rate', 1.5D, 'count', null) AS rating")
    path = str(tmp_path / "out")
    file_sinks.write_csv(df, path, ["rating", "missing", "id"])
    assert spark.read.text(path).first()[0] == "rating,missing,id"
    back = files.read_files(spark, path, "csv", "rating string, missing string, id int").first()
    assert json.loads(back.rating) == {"rate": 1.5, "count": None} and back.missing is None and back.id == 1
    with pytest.raises(ValueError, match="rating"):
        file_sinks.write_csv(df, str(tmp_path / "no"), ["id"])


def test_staged_tree(spark, tmp_path):
    path = file_sinks.land(spark.range(3), str(tmp_path), "api_source", AT, "csv")
    assert path.endswith("api_source/00_staged_files/2026/10/25/api_source_2026_10_25_13_02_56.csv")
    single = "api_source/00_staged_files/2026/1/2/api_source_2026_1_2_3_4_5.csv"
    write(tmp_path / single, "id\n9\n")
    rows = files.read_staged(spark, str(tmp_path), "api_source", "csv", "id bigint").collect()
    assert {(r.id, r.staged_source, r.staged_state, r.staged_at) for r in rows} == {
        *((i, "api_source", "00_staged_files", AT) for i in range(3)),
        (9, "api_source", "00_staged_files", datetime(2026, 1, 2, 3, 4, 5)),
    }


# --- payloads ---------------------------------------------------------------------

PAYLOADS = {
    "bad_element": '[{"id":"zz","title":"a"},{"id":3,"title":"ok"}]',
    "drift": '[{"id":1,"title":"a","extra":9},{"id":2}]',
    "item": '{"id":9,"title":"single"}',
    "none": "[]",
    "cut": '[{"id":1},',
    "blank": "  \n",
    "zero": "",
}


@pytest.fixture
def landed(tmp_path):
    for label, text in PAYLOADS.items():
        write(tmp_path / f"{label}.json", text)
    return str(tmp_path)


def outcomes(parsed):
    return {(r.file_path.split("/")[-1][:-5], r.outcome): r["count"] for r in parsed.groupBy("file_path", "outcome").count().collect()}


def test_payload_outcomes(spark, landed):
    parsed = payload.parse_payload(payload.read_text_files(spark, landed), types.record_schema(PRODUCT))
    assert outcomes(parsed) == {
        ("bad_element", "record"): 1,
        ("bad_element", "corrupt_record"): 1,
        ("drift", "record"): 2,
        ("item", "record"): 1,
        ("none", "empty"): 1,
        ("cut", "corrupt_file"): 1,
        ("blank", "empty"): 1,
    }
    assert {(r.id, r.title) for r in payload.good_records(parsed).collect()} == {
        (3, "ok"), (1, "a"), (2, None), (9, "single"),
    }
    errored = payload.errored_records(parsed).collect()
    assert {r.element for r in errored} == {'{"id":"zz","title":"a"}', '[{"id":1},'}
    assert [r.path.split("/")[-1] for r in files.empty_files(spark, landed).collect()] == ["zero.json"]


def test_payload_shapes(spark, landed, caplog):
    schema = types.record_schema(PRODUCT)
    with pytest.raises(TypeError, match="list"):
        payload.read_collection(spark, f"{landed}/item.json", schema)
    single = payload.parse_payload(payload.read_text_files(spark, f"{landed}/drift.json"), schema, "item")
    assert outcomes(single) == {("drift", "corrupt_file"): 1}
    with caplog.at_level(logging.WARNING):
        assert payload.read_collection(spark, f"{landed}/none.json", schema).count() == 0
    assert "no records" in caplog.text
    assert payload.read_collection(spark, f"{landed}/drift.json", schema).count() == 2
    with pytest.raises(ValueError):
        payload.parse_payload(payload.read_text_files(spark, landed), schema, "tree")


def test_item_lookup(tables):
    parts = tables("part")
    assert payload.item(parts, "42", "p_partkey").count() == 1
    assert payload.item(parts, -5, "p_partkey").isEmpty()
    for bad in ("x", None, [1]):
        with pytest.raises(TypeError):
            payload.item(parts, bad, "p_partkey")
    plan = payload.item(parts, 42, "p_partkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_partkey,42)" in plan


def test_field_names_and_drift(spark, landed):
    read = lambda label: payload.read_text_files(spark, f"{landed}/{label}.json")
    assert payload.field_names(read("drift")) == ["id", "title", "extra"]
    assert payload.field_names(read("none")) == []
    with pytest.raises(TypeError):
        payload.field_names(read("item"))
    drift = payload.field_drift(read("drift"), types.record_schema(PRODUCT))
    assert {tuple(r) for r in drift.collect()} == {("extra", "undeclared", 1), ("rating", "missing", 0)}


def test_extract(spark, landed, tmp_path):
    result = extract(spark, f"{landed}/drift.json", PRODUCT, str(tmp_path / "out"))
    assert result.field_names == ("id", "title", "extra")
    assert spark.read.parquet(result.parquet).orderBy("id").collect() == [(1, "a", None), (2, None, None)]
    assert files.read_files(spark, result.csv, "csv").columns == ["id", "title", "rating"]
    mixed = extract(spark, f"{landed}/bad_element.json", PRODUCT, str(tmp_path / "mixed"))
    assert spark.read.json(mixed.errored).first().outcome == "corrupt_record"


# --- control, queries, database ---------------------------------------------------


def test_control_table(spark):
    rows = [
        {"Source_Type": "CSV", "Source_Name": "a", "Connection": "p", "Primary Key": "id, day", "Load Type": "delta", "SCD Type": "Type 1"},
        {"source_type": "table", "source_name": "b", "connection": "q", "primary_key": ["id"]},
    ]
    plan = control.load_plan(control.control_frame(spark, rows))
    assert [(s.source_name, s.primary_key, s.delta, s.scd_type) for s in plan] == [
        ("a", ("id", "day"), True, 1),
        ("b", ("id",), False, 2),
    ]
    for change in ({"Load Type": "Half"}, {"SCD Type": 3}, {"Source_Type": "fax"}, {"Primary Key": ""}, {"Owner": "x"}):
        with pytest.raises(ValueError):
            control.source({**rows[0], **change})
    with pytest.raises(ValueError, match="twice"):
        control.control_frame(spark, [rows[0], rows[0]])


def test_query_binds_values(spark, tables):
    tables("nation").createOrReplaceTempView("nations_for_test")
    found = table_sources.read_query(spark, "SELECT * FROM nations_for_test WHERE n_name = :name", {"name": "NATION_3' OR 1=1"})
    assert found.isEmpty()


def test_database_options_are_checked(spark):
    """No database is started here: only what needs none."""
    options = table_sources.jdbc_options("jdbc:postgresql://host/db", {"fetchsize": 5000})
    assert options == {"url": "jdbc:postgresql://host/db", "fetchsize": "5000"}
    with pytest.raises(ValueError):
        table_sources.jdbc_options("postgresql://host/db")
    with pytest.raises(ValueError):
        table_sinks.write_database(spark.range(1), "t", "jdbc:x:y", "merge")


def test_transform_registry(spark):
    entry = control.source({"Source_Type": "table", "Source_Name": "t", "Connection": "t", "Primary Key": "id"})
    registry = {"t": lambda df, source, add: df.withColumn("id", F.col("id") + add)}
    assert transform(spark.range(1), "t", entry, registry, add=5).first().id == 5
    assert transform(spark.range(1), "other", entry, registry).first().id == 0


# --- streams ----------------------------------------------------------------------


def test_stream_equals_batch_and_reads_files_once(spark, tmp_path, tables):
    orders = tables("orders")
    root, out, offsets = (str(tmp_path / n) for n in ("root", "out", "offsets"))

    def catch_up():
        stream = arrivals.read_arrivals(spark, root, "orders_api", "json", orders.schema, max_files=1)
        arrivals.on_arrival(stream, arrivals.replace_batch(out), offsets).awaitTermination()

    parts = [orders.where(F.col("o_orderkey") % 3 == i) for i in range(3)]
    for i, part in enumerate(parts[:2]):
        file_sinks.land(part, root, "orders_api", datetime(2026, 1, 1 + i), "json")
    catch_up()
    file_sinks.land(parts[2], root, "orders_api", datetime(2026, 1, 3), "json")
    catch_up()
    catch_up()
    stored = spark.read.parquet(out)
    assert stored.select("batch_id").distinct().count() == 3
    landed = stored.select(*orders.columns)
    assert landed.count() == orders.count() and landed.exceptAll(orders).isEmpty()


def test_failed_batch_comes_again_and_replaces_itself(spark, tmp_path):
    root, out, offsets = (str(tmp_path / n) for n in ("root", "out", "offsets"))
    file_sinks.land(spark.range(10), root, "api", AT, "json")
    store, attempts = arrivals.replace_batch(out), []

    def failing(rows, batch_id):
        store(rows, batch_id)
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost after the write")

    def run():
        stream = arrivals.read_arrivals(spark, root, "api", "json", "id bigint")
        arrivals.on_arrival(stream, failing, offsets).awaitTermination()

    with pytest.raises(PySparkException):
        run()
    run()
    assert attempts == [0, 0]
    assert spark.read.parquet(out).count() == 10


def test_processed_files_move_on(spark, tmp_path):
    root, out, offsets = (str(tmp_path / n) for n in ("root", "out", "offsets"))
    for day in (1, 2, 3):
        file_sinks.land(spark.range(1).coalesce(1), root, "api", datetime(2026, 1, day), "json")
        stream = arrivals.read_arrivals(spark, root, "api", "json", "id bigint", archive=True)
        arrivals.on_arrival(stream, arrivals.replace_batch(out), offsets).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    archived = list((tmp_path / "root" / "api" / "01_loaded_files").rglob("*.json"))
    assert [p for p in archived if p.is_file()]


def test_errored_payloads_are_set_aside(spark, tmp_path, landed):
    for label in ("bad_element", "cut", "drift"):
        write(tmp_path / "root" / "api" / "00_staged_files" / "2026" / "1" / "1" / f"{label}.json", PAYLOADS[label])
    root, out, offsets = (str(tmp_path / n) for n in ("root", "out", "offsets"))

    def errored(rows, batch_id):
        file_sinks.land_errored(rows, root, "api", AT)

    stream = arrivals.read_payload_arrivals(spark, root, "api", types.record_schema(PRODUCT))
    handler = arrivals.split_payload(arrivals.replace_batch(out), errored)
    arrivals.on_arrival(stream, handler, offsets).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    aside = files.read_staged(spark, root, "api", "json", state=files.ERRORED)
    assert {r.outcome for r in aside.collect()} == {"corrupt_record", "corrupt_file"}


@pytest.mark.parametrize("missing", ["tiktoken", "sediment.llm", "corpus_pipeline"])
def test_the_other_queries_need_nothing_of_the_text_operators(missing):
    code = (
        "import sys\n"
        f"sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "from sediment.queries import QUERIES\n"
        "assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(QUERIES)\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert "without the operators for training text" in done.stderr
