"""Arrays cut into blocks at any byte, against parsing whole files."""

import json
import random

import pytest
from pyspark.sql import types as T

from sediment.sources.arrays import TASKS_PER_CORE, _blocks, _session, parse_arrays
from sediment.sources.payload import errored_records, good_records, parse_payload, read_text_files

RATING = T.StructType([T.StructField("rate", T.DoubleType()), T.StructField("note", T.StringType())])
SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("rating", RATING),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)
TITLES = ["a", "", "b}c", "{[", '"', "\\", '\\"}', "\\\\", "é漢😀", "x\ny", "],[", '"},{"', "}" * 9]


def record(draw, k):
    tags = [draw.choice(TITLES) for _ in range(draw.randrange(4))]
    return {"id": k, "title": draw.choice(TITLES), "rating": {"rate": k / 2, "note": draw.choice(TITLES)}, "tags": tags}


def outcomes(parsed):
    good = sorted(map(str, good_records(parsed).collect()))
    return good, sorted((r.file_path.rpartition("/")[2], r.outcome) for r in errored_records(parsed).collect())


@pytest.mark.parametrize("size", [97, 3000, 1 << 20])
def test_records_equal_those_of_whole_files(spark, tmp_path, size):
    draw = random.Random(size)
    n = {97: 8, 3000: 120}.get(size, 400)
    for k, indent in enumerate((None, 2)):
        rows = [record(draw, j) for j in range(n)]
        (tmp_path / f"{k}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=draw.random() < 0.5) + "\n" * k)
    (tmp_path / "one.json").write_text(' [ {"id":7} ] ')
    (tmp_path / "odd.json").write_text('[{"id":1},{"id":"zz"},{"id":3}]')
    wanted = outcomes(parse_payload(read_text_files(spark, str(tmp_path)), SCHEMA, "collection"))
    found = parse_arrays(spark, str(tmp_path), SCHEMA, size)
    assert outcomes(found) == wanted and len(wanted[0]) == 2 * n + 3 and wanted[1] == [("odd.json", "corrupt_record")]


@pytest.mark.parametrize("size", [9, 1 << 20])
def test_files_that_are_no_arrays(spark, tmp_path, size):
    texts = {
        "cut": '[{"id":1},{"id":2',
        "comma": '[{"id":1},',
        "open": '[{"id":1}',
        "item": '{"id":9}',
        "words": "no json",
        "string": '[{"id":1,"title":"x}]',
        "empty": "[ ]",
        "blank": " \n",
    }
    for label, text in texts.items():
        (tmp_path / f"{label}.json").write_text(text)
    found = parse_arrays(spark, str(tmp_path), SCHEMA, size)
    assert good_records(found).collect() == []
    told = {r.file_path.rpartition("/")[2].removesuffix(".json"): r.outcome for r in found.collect()}
    assert told == {label: "empty" if label in ("empty", "blank") else "corrupt_file" for label in texts}


def test_a_stray_between_records_is_set_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":1}, 5, {"id":2}, {"id":3}]')
    found = parse_arrays(spark, str(tmp_path), SCHEMA)
    assert [r.id for r in good_records(found).orderBy("id").collect()] == [1, 3]
    assert [r.element for r in errored_records(found).collect()] == [', 5, {"id":2}']


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": k, "title": "x" * 50} for k in range(2000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = _blocks(_session(spark, 20_000), str(tmp_path))
    assert rows.rdd.getNumPartitions() >= 5 and rows.select("file_block_start").distinct().count() >= 5
    assert good_records(parse_arrays(spark, str(tmp_path), SCHEMA, 20_000)).count() == 2000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_very_many_blocks_are_read_by_few_tasks(spark, tmp_path):
    rows = [{"id": k, "title": "x" * (k % 300)} for k in range(2000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    parsed = parse_arrays(spark, str(tmp_path), SCHEMA, 1000)
    assert (tmp_path / "a.json").stat().st_size > 300_000
    written = [path for path in parsed.inputFiles() if "array-records" in path]  # a file per task
    assert 5 <= len(written) <= TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert sorted((r.id, r.title) for r in good_records(parsed).collect()) == [(r["id"], r["title"]) for r in rows]
