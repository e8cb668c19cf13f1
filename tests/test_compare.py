"""Contract of the snapshot comparison."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sediment.functions.hashing import add_row_hash, hashed_columns
from sediment.operators import compare


def counts(df):
    return {row.status: row.n for row in compare.status_counts(df).collect()}


def frame(spark, values, schema="id int, name string"):
    return add_row_hash(spark.createDataFrame(values, schema))


def test_status_truth_table(spark):
    current = frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    new = frame(spark, [(1, "a"), (2, "B"), (4, "d")])
    result = compare.compare(current, new, "id")
    assert result.columns == ["id", "hash_column_current", "name", "hash_column_new", "status"]
    found = {row.id: (row.status, row.name) for row in result.collect()}
    assert found == {1: ("unchanged", "a"), 2: ("changed", "B"), 3: ("deleted", None), 4: ("new", "d")}


def test_keyless_statuses_keep_copies_of_the_new_side(spark):
    current = frame(spark, [(1, "a"), (1, "a"), (2, "b")])
    new = frame(spark, [(1, "a"), (1, "a"), (3, "c"), (3, "c")])
    result = compare.compare(current, new)
    assert result.columns == ["hash_column", "id", "name", "status"]
    assert counts(result) == {"unchanged": 2, "new": 2, "removed_or_changed": 1}


def test_null_keys_match_each_other(spark):
    current = frame(spark, [(None, "a"), (0, "z")])
    new = frame(spark, [(None, "b"), (0, "z")])
    result = compare.compare(current, new, "id")
    assert {(r.id, r.status) for r in result.collect()} == {(None, "changed"), (0, "unchanged")}


def test_keys_of_every_plain_type(spark):
    row = spark.sql(
        "SELECT true AS b, 1Y AS t, 1.5D AS d, 2.50BD AS n, 's' AS s, X'00' AS x, date'2026-01-01' AS day, "
        "timestamp'2026-01-01' AS at, timestamp_ntz'2026-01-01' AS local"
    )
    names = row.columns
    empty = row.select(*[F.lit(None).cast(row.schema[c].dataType).alias(c) for c in names])
    both = add_row_hash(row.unionByName(empty))
    result = compare.compare(both, both, names)
    assert counts(result) == {"unchanged": 2}


def test_int_and_long_keys_meet(spark):
    current = frame(spark, [(1, "a")], "id int, name string")
    new = frame(spark, [(1, "a")], "id bigint, name string")
    assert counts(compare.compare(current, new, "id")) == {"unchanged": 1}
    with pytest.raises(TypeError):
        compare.compare(current, frame(spark, [("1", "a")], "id string, name string"), "id")


@pytest.mark.parametrize("split", ["128m", "8b"])
@pytest.mark.parametrize("side", ["current", "new"])
def test_repeated_key_is_an_error(spark, split, side):
    single, double = frame(spark, [(1, "a")]), frame(spark, [(1, "a"), (1, "b")])
    pair = (double, single) if side == "current" else (single, double)
    spark.conf.set("spark.sediment.splitBytes", split)
    try:
        with pytest.raises(PySparkException, match=f"found in {side}"):
            compare.status_counts(compare.compare(*pair, "id")).collect()
        nulls = frame(spark, [(None, "a"), (None, "b")])
        with pytest.raises(PySparkException, match="Duplicate"):
            compare.compare(nulls, single, "id").collect()
    finally:
        spark.conf.unset("spark.sediment.splitBytes")


def test_guards_name_what_is_missing(spark):
    good = frame(spark, [(1, "a")])
    with pytest.raises(KeyError, match="current"):
        compare.compare(good.drop("hash_column"), good, "id")
    with pytest.raises(KeyError, match="new: .*id"):
        compare.compare(good, good.drop("id"), "id")
    with pytest.raises(KeyError, match="nope"):
        add_row_hash(good, ["nope"])


def test_empty_sides(spark):
    some, none = frame(spark, [(1, "a")]), frame(spark, [])
    assert counts(compare.compare(none, some, "id")) == {"new": 1}
    assert counts(compare.compare(some, none, "id")) == {"deleted": 1}
    assert counts(compare.compare(none, none, "id")) == {}


def snapshots(tables):
    orders = tables("orders")
    columns = ["o_orderstatus"]
    changed = F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))
    current = orders.where("o_orderkey % 10 <> 0")
    new = orders.where("o_orderkey % 10 <> 1").withColumn("o_orderstatus", changed)
    return add_row_hash(current, columns), add_row_hash(new, columns)


def test_known_counts(tables):
    current, new = snapshots(tables)
    assert counts(compare.compare(current, new, "o_orderkey")) == {
        "changed": 171, "deleted": 150, "new": 150, "unchanged": 1029,
    }
    documents = add_row_hash(tables("documents"), ["text"])
    keyless = compare.compare(documents.where("doc_id % 5 <> 0"), documents.where("doc_id % 5 <> 1"))
    assert counts(keyless) == {"new": 37, "removed_or_changed": 37, "unchanged": 123}


def test_properties(tables):
    current, new = snapshots(tables)
    assert set(counts(compare.compare(new, new, "o_orderkey"))) == {"unchanged"}
    forth, back = (counts(compare.compare(a, b, "o_orderkey")) for a, b in ((current, new), (new, current)))
    assert (forth["new"], forth["deleted"]) == (back["deleted"], back["new"])
    union = current.select("o_orderkey").union(new.select("o_orderkey")).distinct().count()
    assert sum(forth.values()) == union


def test_delta_flags_and_hash_columns(tables):
    current, new = snapshots(tables)
    result = compare.compare(current, new, "o_orderkey")
    assert set(counts(compare.altered(result))) == {"new", "changed", "deleted"}
    assert set(counts(compare.altered(result, delta=True))) == {"new", "changed"}
    flags = {(r.status, r.flag) for r in compare.with_flag(result).select("status", "flag").distinct().collect()}
    assert flags == {("unchanged", "I"), ("changed", "C"), ("new", "N"), ("deleted", None)}
    assert not [c for c in compare.drop_hashes(result).columns if "hash" in c]
    keyless = compare.compare(current, new)
    assert "hash_column" not in compare.drop_hashes(keyless).columns


def test_hash_covers_all_but_bookkeeping(spark):
    df = spark.createDataFrame([(1, "a", "s", "v", "t")], "id int, name string, source string, version string, status string")
    assert hashed_columns(df) == ["id", "name", "status"]
    assert hashed_columns(df, exclude=["id"]) == ["name", "source", "version", "status"]
    assert hashed_columns(df, ["name", "id"]) == ["name", "id"]


def test_hash_is_order_sensitive_and_strict_on_request(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("NULL", "x")], "p string, q string")
    loose = [r.hash_column for r in add_row_hash(df).collect()]
    assert loose[0] == loose[1] and loose[2] == loose[3]
    strict = [r.hash_column for r in add_row_hash(df, strict=True).collect()]
    assert len(set(strict)) == 4
    swapped = [r.hash_column for r in add_row_hash(df, ["q", "p"]).collect()]
    assert loose[2] != swapped[2]


def test_nested_columns_are_hashed_with_their_nulls(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', null, 'b', 1) AS s UNION ALL SELECT 1, named_struct('a', 1, 'b', null)")
    assert add_row_hash(df).select("hash_column").distinct().count() == 2
