"""Hot keys: found, handled apart, same results."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sediment.operators import compare, history, keys, model, quality, skew


@pytest.fixture
def large(spark):
    spark.conf.set("spark.sediment.splitBytes", "256b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sediment.splitBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def lopsided(tables):
    """Events in which one user holds a third of all rows, and so does the null user."""
    third = F.col("event_id") % 3
    return (
        tables("events")
        .select("event_id", "user_id", "ts", "event_type")
        .withColumn("user_id", F.when(third == 0, F.lit(7)).when(third == 1, F.col("user_id")))
    )


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_small_tables_are_not_probed(lopsided):
    assert skew.hot_keys(lopsided, ["user_id"]) == {}


def test_hot_keys_include_the_null_key(spark, lopsided, large):
    hot = skew.hot_keys(lopsided, ["user_id"])
    wanted = spark.createDataFrame([(7,), (None,)], "user_id bigint").select(skew.key_hash(["user_id"])).collect()
    assert set(hot) == {row[0] for row in wanted}
    assert all(parts >= 1 for parts in hot.values())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(spark, lopsided, large, how):
    users = spark.range(0, 12).select(F.col("id").alias("user_id"), (F.col("id") * 10).alias("score"))
    joined = skew.lookup_join(lopsided, users, ["user_id"], how)
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == rows(lopsided.join(users, ["user_id"], how))


def test_key_checks_deal_keys_to_tasks_by_the_size_of_the_input(spark, lopsided, large):
    users = spark.range(0, 12).select(F.col("id").alias("user_id"))
    for keys_of, parents in ((["event_id"], lopsided.where("event_id % 5 > 0")), (["user_id"], users.union(users))):
        repeated = quality.primary_key_violations(lopsided, keys_of)
        missing = quality.foreign_key_violations(lopsided, parents, {key: key for key in keys_of})
        counted = lopsided.groupBy(*keys_of).agg(F.count(F.lit(1)).alias("n"))
        assert rows(repeated.drop("rule")) == rows(counted.where(f"n > 1 OR {keys_of[0]} IS NULL"))
        assert rows(missing) == rows(counted.dropna().join(parents, keys_of, "left_anti")) != []
        for checked in (repeated, missing):
            plan = checked._jdf.queryExecution().executedPlan().toString()
            assert "REPARTITION_BY_NUM" in plan and "SortMergeJoin" not in plan
            # Rows of hot keys, here of users, are counted per task before they are dealt.
            assert ("_hot" in plan) == (keys_of == ["user_id"])
    texts = users.select(F.col("user_id").cast("string").alias("user_id"))
    counted = lopsided.dropna(subset=["user_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    missing = quality.foreign_key_violations(lopsided, texts, {"user_id": "user_id"})
    assert rows(missing) == rows(counted.where("user_id >= 12"))


def test_lookup_join_refuses_mixed_types(spark, lopsided):
    users = spark.range(3).select(F.col("id").cast("string").alias("user_id"))
    with pytest.raises(TypeError):
        skew.lookup_join(lopsided, users, ["user_id"])


def test_timeline_cuts_hot_keys_into_ranges(lopsided, large):
    timeline = skew.Timeline(lopsided, ["user_id"], ["ts", "event_id"])
    assert timeline.cut
    per_key = timeline._df.groupBy("user_id").agg(F.count_distinct("_range").alias("n")).collect()
    cut = {row.user_id: row.n for row in per_key}
    assert cut[7] > 1 and cut[None] > 1
    biggest = timeline._df.groupBy("user_id", "_range").count().agg(F.max("count")).first()[0]
    assert biggest < lopsided.count() / 5


def test_timeline_equals_plain_windows(lopsided, large):
    timeline = skew.Timeline(lopsided, ["user_id"], ["ts", "event_id"])
    window = Window.partitionBy("user_id").orderBy("ts", "event_id")
    previous = timeline.with_previous("event_type", "p", "f").df
    assert rows(previous) == rows(
        lopsided.withColumns(
            {"p": F.lag("event_type").over(window), "f": F.lag(F.lit(1)).over(window).isNull()}
        )
    )
    assert rows(timeline.with_next("ts", "n").df) == rows(lopsided.withColumn("n", F.lead("ts").over(window)))
    marked = F.when(F.col("event_type") == "error", F.col("event_id"))
    latest = skew.Timeline(lopsided.withColumn("e", marked), ["user_id"], ["ts", "event_id"]).with_latest("e", "l")
    assert rows(latest.df) == rows(
        lopsided.withColumn("e", marked).withColumn(
            "l", F.last("e", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))
        )
    )


def test_history_is_the_same_with_hot_keys(spark, lopsided):
    args = ("user_id", ["ts", "event_id"], ["event_type"])
    plain = rows(history.versions(lopsided, *args))
    spark.conf.set("spark.sediment.splitBytes", "256b")
    try:
        assert rows(history.versions(lopsided, *args)) == plain
    finally:
        spark.conf.unset("spark.sediment.splitBytes")


def test_point_in_time_three_ways(spark, tables, lopsided):
    spans = history.versions(lopsided, "user_id", ["ts", "event_id"], ["event_type"]).withColumnRenamed("event_type", "state")
    asked = lopsided.select("event_id", "user_id", "ts")
    joined = rows(model.point_in_time(asked, spans, "user_id", "ts", ["state"]))
    assert len(joined) == lopsided.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(model.point_in_time(asked, spans, "user_id", "ts", ["state"])) == joined
        spark.conf.set("spark.sediment.splitBytes", "256b")
        assert rows(model.point_in_time(asked, spans, "user_id", "ts", ["state"])) == joined
    finally:
        spark.conf.unset("spark.sediment.splitBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_point_in_time_outside_any_interval(spark):
    spans = spark.sql(
        "SELECT 1 AS k, timestamp_ntz'2026-01-02' AS valid_from, timestamp_ntz'2026-01-03' AS valid_to, 'a' AS state"
    )
    asked = spark.sql(
        "SELECT k, at FROM VALUES (1, timestamp_ntz'2026-01-01'), (1, timestamp_ntz'2026-01-02'), "
        "(1, timestamp_ntz'2026-01-03'), (2, timestamp_ntz'2026-01-02') AS t(k, at)"
    )

    def states():
        found = model.point_in_time(asked, spans, "k", "at", ["state"])
        return [row.state for row in found.orderBy("k", "at").collect()]

    assert states() == [None, "a", None, None]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert states() == [None, "a", None, None]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_comparison_shuffles_each_side_once(spark, tables):
    orders = tables("orders").withColumn("hash_column", F.sha2("o_orderstatus", 256))
    for split in ("128m", "8b"):
        spark.conf.set("spark.sediment.splitBytes", split)
        text = plan(compare.compare_by_key(orders, orders, ["o_orderkey"]))
        spark.conf.unset("spark.sediment.splitBytes")
        assert text.count("Exchange") == 2
        assert "Python" not in text and "Cartesian" not in text and "SinglePartition" not in text
        assert ("WindowGroupLimit" in text) == (split == "8b")


def test_latest_version_limits_before_the_shuffle(tables):
    text = plan(history.latest_version(tables("events"), "user_id", [F.col("ts").desc()]))
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_versions_shuffle_once(tables):
    text = plan(history.versions(tables("events"), "user_id", ["ts", "event_id"], ["event_type"]))
    assert text.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(tables):
    counted = compare.status_counts(
        compare.compare_by_key(
            *[tables("orders").withColumn("hash_column", F.sha2("o_orderstatus", 256)) for _ in range(2)], "o_orderkey"
        )
    )
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan(counted)


def test_key_numbering_needs_no_global_sort(tables):
    text = plan(keys.surrogate_keys(tables("customer"), "c_custkey"))
    scan = text[text.index("FileScan") :]
    assert "c_name" not in scan
    assert text.count("Window") <= 2  # over one row per partition
