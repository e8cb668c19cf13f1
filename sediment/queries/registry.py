"""The queries by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.functions import cleaning, hashing, lineage, types
from sediment.operators import compare, history, keys, model, quality
from sediment.plans import extract as extraction
from sediment.plans import medallion, warehouse
from sediment.queries.snapshots import (
    FIRST,
    SECOND,
    THIRD,
    later_documents,
    later_lineitem,
    later_orders,
    null_key,
    table,
)
from sediment.session import scratch_path
from sediment.sinks import files as file_sinks
from sediment.sinks import tables as table_sinks
from sediment.sources import control, files, payload, tables
from sediment.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _money(name: str):
    """Exact sums: cents as decimals."""
    return F.col(name).cast("decimal(18,2)")


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# --- row hashes and lineage -------------------------------------------------------


@query
def row_hash(spark, sf_dir):
    return hashing.add_row_hash(table(spark, sf_dir, "customer"))


@query
def row_hash_lineitem(spark, sf_dir):
    rows = hashing.add_row_hash(table(spark, sf_dir, "lineitem"))
    return rows.select(*LINE_KEYS, "hash_column")


@query
def row_hash_subset(spark, sf_dir):
    rows = hashing.add_row_hash(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_totalprice", "o_orderdate"])
    return rows.select("o_orderkey", "hash_column")


@query
def row_hash_strict(spark, sf_dir):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    rows = hashing.add_row_hash(table(spark, sf_dir, "customer"), columns, strict=True)
    return rows.select("c_custkey", "hash_column")


@query
def row_hash_text(spark, sf_dir):
    rows = hashing.add_row_hash(table(spark, sf_dir, "documents"), ["text", "lang", "source"])
    return rows.select("doc_id", "hash_column")


@query
def add_metadata(spark, sf_dir):
    return lineage.add_metadata(table(spark, sf_dir, "supplier"), "supplier_file", "0.1", FIRST)


# --- snapshot comparison ----------------------------------------------------------


def _compared_orders(spark, sf_dir):
    current = table(spark, sf_dir, "orders")
    return compare.compare_by_key(
        hashing.add_row_hash(current, ORDER_COLUMNS),
        hashing.add_row_hash(later_orders(current), ORDER_COLUMNS),
        "o_orderkey",
    )


@query
def snapshot_diff_keyed(spark, sf_dir):
    current = table(spark, sf_dir, "orders")
    return compare.count_by_key(
        hashing.add_row_hash(current, ORDER_COLUMNS),
        hashing.add_row_hash(later_orders(current), ORDER_COLUMNS),
        "o_orderkey",
    )


@query
def snapshot_diff_rows(spark, sf_dir):
    return compare.drop_hashes(compare.altered(_compared_orders(spark, sf_dir)))


@query
def snapshot_diff_full(spark, sf_dir):
    return _compared_orders(spark, sf_dir)


@query
def snapshot_diff_composite_key(spark, sf_dir):
    current = table(spark, sf_dir, "lineitem")
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return compare.count_by_key(
        hashing.add_row_hash(current, measures), hashing.add_row_hash(later_lineitem(current), measures), LINE_KEYS
    )


@query
def snapshot_diff_null_keys(spark, sf_dir):
    current = table(spark, sf_dir, "orders")
    compared = compare.compare_by_key(
        hashing.add_row_hash(null_key(current), ORDER_COLUMNS),
        hashing.add_row_hash(null_key(later_orders(current)), ORDER_COLUMNS),
        "o_orderkey",
    )
    return compared.select("o_orderkey", "o_custkey", "status")


@query
def snapshot_diff_keyless(spark, sf_dir):
    current = table(spark, sf_dir, "documents")
    compared = compare.compare_by_hash(
        hashing.add_row_hash(current, ["text"]), hashing.add_row_hash(later_documents(current), ["text"])
    )
    return compared.select("hash_column", "doc_id", "lang", "status")


@query
def diff_flags(spark, sf_dir):
    flagged = compare.with_flag(_compared_orders(spark, sf_dir))
    return flagged.select("o_orderkey", "status", "flag")


@query
def delta_load_no_delete(spark, sf_dir):
    rows = compare.altered(_compared_orders(spark, sf_dir), delta=True)
    return rows.select("o_orderkey", *ORDER_COLUMNS, "status")


# --- layers -----------------------------------------------------------------------


def _silver_first(spark, sf_dir):
    return medallion.first_silver(table(spark, sf_dir, "orders"), "orders_file", "0.1", FIRST)


def _silver_second(spark, sf_dir):
    silver = _silver_first(spark, sf_dir)
    later = later_orders(table(spark, sf_dir, "orders"))
    delta = medallion.silver_delta(silver, later, "o_orderkey", None, "orders_file", "0.1", SECOND)
    return history.preserve_history(silver, delta)


@query
def silver_first_load(spark, sf_dir):
    return _silver_first(spark, sf_dir)


@query
def silver_increment(spark, sf_dir):
    return _silver_second(spark, sf_dir)


@query
def silver_reappearing_keys(spark, sf_dir):
    """A third load brings back the first one: deleted keys return as new."""
    silver = _silver_second(spark, sf_dir)
    again = table(spark, sf_dir, "orders")
    delta = medallion.silver_delta(silver, again, "o_orderkey", None, "orders_file", "0.1", THIRD)
    return delta.select("o_orderkey", "o_orderstatus", "status", "ingestion_timestamp")


@query
def gold_latest(spark, sf_dir):
    silver = _silver_second(spark, sf_dir)
    return model.gold(silver, "o_orderkey", medallion.newest_first(silver))


@query
def gold_aggregate(spark, sf_dir):
    silver = _silver_second(spark, sf_dir).withColumn("price", _money("o_totalprice"))
    rules = {
        "group_by": ["o_orderstatus"],
        "measures": {
            "n_orders": ("count", "*"),
            "revenue": ("sum", "price"),
            "last_order": ("max", "o_orderdate"),
            "n_customers": ("count_distinct", "o_custkey"),
        },
    }
    return _as_double(model.gold(silver, "o_orderkey", medallion.newest_first(silver), rules), "revenue")


def _fresh_name(spark, label: str) -> str:
    """A table name of its own per run, in layer schemas kept in the shared folder."""
    for schema in (medallion.BRONZE, medallion.SILVER, medallion.GOLD, *_WAREHOUSE_SCHEMAS):
        if not spark.catalog.databaseExists(schema):
            spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, schema)}'")
    return f"{label}_{uuid.uuid4().hex}"


_WAREHOUSE_SCHEMAS = (
    warehouse.STAGING,
    warehouse.HISTORY,
    warehouse.KEYS,
    warehouse.DIMENSIONS,
    warehouse.FACTS,
)


@query
def medallion_run(spark, sf_dir):
    """Two loads through real tables, the second one run twice as after a failure."""
    orders = table(spark, sf_dir, "orders")
    layers = medallion.Medallion(
        spark,
        _fresh_name(spark, "orders"),
        ["o_orderkey"],
        "orders_file",
        "0.1",
        types=types.table_types({"columns": {"o_orderstatus": {"type": "String", "length": 1}}}),
    )
    layers.run(orders, 1, FIRST)
    layers.run(later_orders(orders), 2, SECOND)
    layers.run(later_orders(orders), 2, SECOND)
    silver = tables.read_table(spark, layers.silver_table).groupBy("batch_id", "status").agg(F.count(F.lit(1)).alias("n"))
    gold = tables.read_table(spark, layers.gold_table).agg(F.count(F.lit(1)).alias("n"))
    return silver.select(F.lit("silver").alias("layer"), "batch_id", "status", "n").unionByName(
        gold.select(F.lit("gold").alias("layer"), F.lit(0).cast("bigint").alias("batch_id"), F.lit("live").alias("status"), "n")
    )


# --- history ----------------------------------------------------------------------


@query
def latest_version(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return history.latest_version(events, "user_id", [F.col("ts").desc(), F.col("event_id").desc()])


@query
def change_points(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return history.change_points(events, "user_id", ["ts", "event_id"], ["event_type"])


def _event_versions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return history.versions(events, "user_id", ["ts", "event_id"], ["event_type"])


@query
def history_scd2(spark, sf_dir):
    return _event_versions(spark, sf_dir).select("user_id", "event_type", "valid_from", "valid_to", "is_current")


@query
def history_scd1(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    current = lineage.add_metadata(orders, "orders_file", "0.1", FIRST)
    later = lineage.add_metadata(later_orders(orders), "orders_file", "0.1", SECOND)
    return history.merge_type1(current, later, "o_orderkey")


@query
def history_scd1_delta(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return history.merge_type1(orders, later_orders(orders), "o_orderkey", ["o_orderstatus"], delta=True)


def _orders_merged(spark, sf_dir, delta):
    orders = table(spark, sf_dir, "orders")
    current = history.open_history(orders, lineage.batch_time(FIRST))
    return history.merge_type2(current, later_orders(orders), "o_orderkey", lineage.batch_time(SECOND), delta=delta)


@query
def history_scd2_merge(spark, sf_dir):
    return _orders_merged(spark, sf_dir, False)


@query
def history_scd2_merge_delta(spark, sf_dir):
    merged = _orders_merged(spark, sf_dir, True)
    return merged.select("o_orderkey", "o_orderstatus", "valid_from", "valid_to", "is_current")


# --- keys and model ---------------------------------------------------------------


@query
def surrogate_keys(spark, sf_dir):
    return keys.surrogate_keys(table(spark, sf_dir, "customer"), "c_custkey")


@query
def surrogate_keys_composite(spark, sf_dir):
    return keys.surrogate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query
def surrogate_keys_increment(spark, sf_dir):
    """Building customers got their keys in an earlier load; the others follow."""
    customer = table(spark, sf_dir, "customer")
    known = keys.surrogate_keys(customer.where("c_mktsegment = 'BUILDING'"), "c_custkey")
    return known.unionByName(keys.surrogate_keys(customer, "c_custkey", known))


def _dimension(spark, sf_dir, name, key):
    rows = table(spark, sf_dir, name)
    return model.dimension(rows, keys.surrogate_keys(rows, key), key)


@query
def dim_customer(spark, sf_dir):
    return _dimension(spark, sf_dir, "customer", "c_custkey")


def _fact_orders(spark, sf_dir, columns):
    customers = _dimension(spark, sf_dir, "customer", "c_custkey").where("c_mktsegment <> 'FURNITURE'")
    return model.fact(
        table(spark, sf_dir, "orders").withColumns(
            {"order_month": F.date_format("o_orderdate", "yyyy-MM"), "price": _money("o_totalprice")}
        ),
        {"customer_key": (customers, {"o_custkey": "c_custkey"})},
        columns,
    )


@query
def fact_orders(spark, sf_dir):
    """Furniture customers are missing from the dimension: their orders get the unknown member."""
    return _fact_orders(spark, sf_dir, ["o_orderkey", "o_totalprice", "o_orderdate"])


@query
def fact_lineitem(spark, sf_dir):
    dimensions = {
        "part_key": (_dimension(spark, sf_dir, "part", "p_partkey"), {"l_partkey": "p_partkey"}),
        "supplier_key": (_dimension(spark, sf_dir, "supplier", "s_suppkey"), {"l_suppkey": "s_suppkey"}),
    }
    return model.fact(table(spark, sf_dir, "lineitem"), dimensions, ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query
def fact_orders_monthly(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {"order_month": F.date_format("o_orderdate", "yyyy-MM"), "price": _money("o_totalprice")}
    )
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = model.lookup_join(orders, customers, ["o_custkey"])
    grain = ["c_mktsegment", "o_orderpriority", "order_month"]
    facts = model.aggregate(joined, grain, {"n_orders": ("count", "*"), "revenue": ("sum", "price")})
    return _as_double(facts, "revenue")


@query
def fact_point_in_time(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    spans = _event_versions(spark, sf_dir).withColumnRenamed("event_type", "state").withColumn("since", F.col("valid_from"))
    return model.point_in_time(events, spans, "user_id", "ts", ["state", "since"])


@query
def warehouse_run(spark, sf_dir):
    """Control-driven run over two loads: customers kept as type 2, orders as a fact."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    dim_name, fact_source, fact_name = (_fresh_name(spark, n) for n in ("customer", "orders", "sales"))
    plan = control.load_plan(
        control.control_frame(
            spark,
            [
                {
                    "Source_Type": "parquet",
                    "Source_Name": dim_name,
                    "Connection": f"{sf_dir}/customer.parquet",
                    "Primary Key": "c_custkey",
                    "Compare Columns": "c_mktsegment, c_acctbal",
                    "Load Type": "Full",
                    "SCD Type": 2,
                },
                {
                    "Source_Type": "parquet",
                    "Source_Name": fact_source,
                    "Connection": f"{sf_dir}/orders.parquet",
                    "Primary Key": "o_orderkey",
                    "Load Type": "Full",
                    "SCD Type": 1,
                },
            ],
        )
    )
    sales = warehouse.Fact(
        fact_name,
        fact_source,
        {"customer_key": (dim_name, {"o_custkey": "c_custkey"})},
        ["o_orderpriority", "order_year", "price"],
        ["customer_key", "o_orderpriority", "order_year"],
        {"n_orders": ("count", "*"), "revenue": ("sum", "price")},
    )
    transforms = {
        fact_source: lambda df, source: df.withColumns(
            {"order_year": F.year("o_orderdate"), "price": _money("o_totalprice")}
        )
    }
    constraints = [
        quality.PrimaryKey(dim_name, ("c_custkey",)),
        quality.PrimaryKey(fact_name, ("customer_key", "o_orderpriority", "order_year")),
        quality.ForeignKey(fact_name, dim_name, (("customer_key", "surrogate_key"),)),
    ]
    warehouse.Warehouse(spark, 1, FIRST, transforms).run(plan, [sales], constraints)
    moved = F.when(F.col("c_mktsegment") == "BUILDING", "MACHINERY").otherwise(F.col("c_mktsegment"))
    second = warehouse.Warehouse(spark, 2, SECOND, transforms).run(
        plan, [sales], constraints, {dim_name: customer.withColumn("c_mktsegment", moved), fact_source: orders}
    )
    members = second[dim_name].select(F.col("surrogate_key").alias("customer_key"), "c_mktsegment", "valid_from")
    joined = model.lookup_join(second[fact_name], members, ["customer_key"], "inner")
    measures = {"n_orders": ("sum", "n_orders"), "revenue": ("sum", "revenue")}
    report = model.aggregate(joined, ["c_mktsegment", "valid_from", "order_year"], measures)
    return _as_double(report, "revenue")


# --- checks -----------------------------------------------------------------------


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def pk_check(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    )
    return quality.primary_key_violations(lines, ["l_orderkey", "l_linenumber"])


@query
def fk_check(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").where("c_mktsegment <> 'FURNITURE'")
    return quality.foreign_key_violations(table(spark, sf_dir, "orders"), customers, {"o_custkey": "c_custkey"})


@query
def fk_orphans(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").where("c_mktsegment <> 'FURNITURE'")
    return quality.orphans(table(spark, sf_dir, "orders"), customers, {"o_custkey": "c_custkey"})


@query
def constraint_report(spark, sf_dir):
    found = {name: table(spark, sf_dir, name) for name in ("customer", "orders", "lineitem", "nation")}
    found["customer"] = found["customer"].where("c_mktsegment <> 'FURNITURE'")
    report = quality.check_keys(
        found,
        [
            quality.PrimaryKey("orders", ("o_orderkey",)),
            quality.PrimaryKey("lineitem", ("l_orderkey",)),
            quality.ForeignKey("lineitem", "orders", (("l_orderkey", "o_orderkey"),)),
            quality.ForeignKey("orders", "customer", (("o_custkey", "c_custkey"),)),
            quality.ForeignKey("customer", "nation", (("c_nationkey", "n_nationkey"),)),
        ],
    )
    return report.groupBy("table_name", "rule").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows")
    )


# --- sources, sinks, types --------------------------------------------------------

# The fields of the records that the source's service sends.
PRODUCT_FIELDS = {
    "id": "integer64",
    "title": "string",
    "price": "float64",
    "description": "string",
    "category": "string",
    "image": "string",
    "rating": {"rate": "float64", "count": "integer32"},
}


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("description"),
        F.col("p_brand").alias("category"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("image"),
        F.struct((F.col("p_size") / 10).alias("rate"), F.col("p_size").alias("count")).alias("rating"),
    )


PAGE = 1000


def _write_payload(records: DataFrame, page, spark, text=None) -> str:
    """Product records as the service sends them: one JSON array of a page per file."""
    path = scratch_path(spark, "payload")
    body = F.to_json(F.struct(*records.columns)) if text is None else text
    (
        records.groupBy(page.alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(body), ","), F.lit("]")).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


def _page():
    return F.floor(F.col("id") / PAGE)


@query
def json_payload_ingest(spark, sf_dir):
    path = _write_payload(_products(table(spark, sf_dir, "part")), _page(), spark)
    good, _ = payload.read_payload(spark, path, types.record_schema(PRODUCT_FIELDS), "collection")
    return good.select(
        "id", "title", "price", "description", "category", "image",
        F.col("rating.rate").alias("rate"), F.col("rating.count").alias("rating_count"),
    )


@query
def payload_quarantine(spark, sf_dir):
    """Promo articles arrive with a text where the price should be: only those are set aside."""
    products = _products(table(spark, sf_dir, "part"))
    whole = F.to_json(F.struct(*products.columns))
    broken = F.to_json(F.struct("id", "title", F.lit("n/a").alias("price"), "description"))
    text = F.when(F.col("description") == "PROMO", broken).otherwise(whole)
    path = _write_payload(products, _page(), spark, text)
    files_ = payload.read_text_files(spark, path)
    parsed = payload.parse_payload(files_, types.record_schema(PRODUCT_FIELDS))
    kind = F.coalesce(F.col("parsed.description"), F.get_json_object("element", "$.description"))
    return parsed.groupBy("outcome", kind.alias("description")).agg(F.count(F.lit(1)).alias("n"))


@query
def field_drift(spark, sf_dir):
    """Records drop a field for some articles and carry one the schema does not know."""
    products = _products(table(spark, sf_dir, "part")).drop("image").withColumn("colour", F.lit("red"))
    path = _write_payload(products, _page(), spark)
    return payload.field_drift(payload.read_text_files(spark, path), types.record_schema(PRODUCT_FIELDS))


@query
def item_lookup(spark, sf_dir):
    """Look one record of the landed payload up by the text form of its id."""
    path = _write_payload(_products(table(spark, sf_dir, "part")), _page(), spark)
    good, _ = payload.read_payload(spark, path, types.record_schema(PRODUCT_FIELDS), "collection")
    return payload.item(good, "42").select("id", "title", "price")


@query
def extract_run(spark, sf_dir):
    path = _write_payload(_products(table(spark, sf_dir, "part")), _page(), spark)
    result = extraction.extract(spark, path, PRODUCT_FIELDS, scratch_path(spark, "extract"))
    typed = spark.read.parquet(result.parquet)
    flat_schema = "id bigint, title string, price double, description string, category string, image string, rating string"
    flat = files.read_files(spark, result.csv, "csv", flat_schema)
    return typed.join(flat.select("id", F.col("rating").alias("rating_text")), "id").select(
        "id", "title", "price", "image",
        F.get_json_object("rating_text", "$.count").cast("int").alias("rating_count"),
        F.col("rating.rate").alias("rate"),
    )


@query
def csv_roundtrip(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv")
    file_sinks.write_csv(part, path, part.columns)
    return files.read_files(spark, path, "csv", part.schema)


@query
def csv_text_roundtrip(spark, sf_dir):
    """Whole texts with quotes and line breaks survive."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "csv")
    file_sinks.write_csv(documents, path, documents.columns)
    return files.read_files(spark, path, "csv", documents.schema)


@query
def json_roundtrip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "json")
    customer.write.json(path)
    return files.read_files(spark, path, "json", customer.schema, lines=True)


@query
def parquet_typed(spark, sf_dir):
    """Rows fitted to a declared schema: a missing field is null, an extra one is dropped."""
    fields = {
        "p_partkey": "integer64",
        "p_name": "large_string",
        "p_size": "unsigned_integer16",
        "p_retailprice": "float64",
        "p_color": "string",
    }
    path = scratch_path(spark, "typed")
    file_sinks.write_parquet(table(spark, sf_dir, "part"), path, types.record_schema(fields))
    return files.read_files(spark, path, "parquet")


@query
def declared_types(spark, sf_dir):
    schema = {
        "columns": {
            "o_orderkey": {"type": "BigInteger"},
            "o_custkey": {"type": "Integer"},
            "o_orderstatus": {"type": "String", "length": 1},
            "o_totalprice": {"type": "Numeric", "precision": 12, "scale": 1},
            "o_orderdate": {"type": "DateTime"},
            "o_orderpriority": {"type": "Text"},
        }
    }
    typed = types.apply_types(table(spark, sf_dir, "orders"), types.table_types(schema))
    return _as_double(typed, "o_totalprice")


@query
def json_column(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query
def json_encode(spark, sf_dir):
    """A nested column on its way into a table column of type JSON, and back."""
    products = _products(table(spark, sf_dir, "part")).select("id", "rating")
    stored = types.apply_types(products, types.table_types({"columns": {"rating": {"type": "JSON"}}}))
    back = F.from_json("rating", "rate double, count int")
    return stored.select("id", back["rate"].alias("rate"), back["count"].alias("rating_count"))


@query
def silver_cleaning(spark, sf_dir):
    """Standardised text: trimmed, blank as null, brands in upper case, sizes typed."""
    part = table(spark, sf_dir, "part").withColumns(
        {
            "p_name": F.concat(F.lit("  "), "p_name", F.lit(" ")),
            "p_type": F.when(F.col("p_type") == "PROMO", "   ").otherwise(F.col("p_type")),
        }
    )
    rules = {"p_name": ["trim"], "p_type": ["trim", "blank_to_null"], "p_brand": ["upper"]}
    return cleaning.clean(part, rules, types.table_types({"columns": {"p_size": {"type": "BigInteger"}}}))


@query
def query_scan(spark, sf_dir):
    """SQL with bound values."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("sediment_orders")
    text = (
        "SELECT o_orderkey, o_totalprice FROM sediment_orders "
        "WHERE o_orderstatus = :status AND o_totalprice >= :floor"
    )
    return tables.read_query(spark, text, {"status": "F", "floor": 250000.0})


@query
def table_load_modes(spark, sf_dir):
    """Replace, append and fail on one table."""
    customer = table(spark, sf_dir, "customer")
    name = f"{medallion.BRONZE}.{_fresh_name(spark, 'customer')}"
    table_sinks.load_table(customer, name, "fail")
    table_sinks.load_table(customer.drop("c_acctbal"), name, "append")
    table_sinks.load_table(tables.read_table(spark, name).where("c_acctbal IS NOT NULL"), name, "replace")
    table_sinks.load_table(customer, name, "append")
    return (
        tables.read_table(spark, name)
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n"), F.count("c_acctbal").alias("n_balance"))
    )


@query
def transform_registry(spark, sf_dir):
    source = control.source(
        {
            "Source_Type": "parquet",
            "Source_Name": "supplier",
            "Connection": f"{sf_dir}/supplier.parquet",
            "Primary Key": ["s_suppkey"],
        }
    )
    registry = {
        "supplier": lambda df, source, floor: df.withColumn("in_credit", F.col("s_acctbal") >= floor).drop("s_acctbal")
    }
    rows = warehouse.extract_source(spark, source)
    return warehouse.transform(rows, source.source_name, source, registry, floor=0)


# --- streaming --------------------------------------------------------------------


@query
def staged_tree_scan(spark, sf_dir):
    """Two loads landed in the staged tree; path parts become columns."""
    customer = table(spark, sf_dir, "customer")
    root = scratch_path(spark, "staged")
    file_sinks.land(customer, root, "customer_api", FIRST, "csv")
    file_sinks.land(customer, root, "customer_api", SECOND, "csv")
    rows = files.read_staged(spark, root, "customer_api", "csv", customer.schema)
    return rows.groupBy("staged_source", "staged_state", "staged_at").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("key_sum")
    )


@query
def stream_ingest(spark, sf_dir):
    """Two landed loads, taken in as a stream of files: each file once."""
    orders = table(spark, sf_dir, "orders")
    root, out = scratch_path(spark, "staged"), scratch_path(spark, "stream")
    file_sinks.land(orders, root, "orders_api", FIRST, "json", max_records=100_000)
    checkpoint = scratch_path(spark, "offsets")

    def catch_up():
        stream = arrivals.read_arrivals(spark, root, "orders_api", "json", orders.schema, max_files=100)
        arrivals.on_arrival(stream, arrivals.replace_batch(out), checkpoint).awaitTermination()

    catch_up()
    file_sinks.land(later_orders(orders), root, "orders_api", SECOND, "json", max_records=100_000)
    catch_up()
    return spark.read.parquet(out).select("o_orderkey", *ORDER_COLUMNS, "staged_at")


@query
def stream_medallion(spark, sf_dir):
    """Each arriving load runs the layers; the stream's batch is the load."""
    customer = table(spark, sf_dir, "customer")
    root, checkpoint = scratch_path(spark, "staged"), scratch_path(spark, "offsets")
    layers = medallion.Medallion(spark, _fresh_name(spark, "customer"), ["c_custkey"], "customer_api", "0.1")

    def handle(rows, batch_id):
        layers.run(rows.drop("staged_source", "staged_state", "staged_at"), batch_id, FIRST)

    moved = F.when(F.col("c_mktsegment") == "BUILDING", "MACHINERY").otherwise(F.col("c_mktsegment"))
    for at, rows in ((FIRST, customer), (SECOND, customer.withColumn("c_mktsegment", moved))):
        file_sinks.land(rows, root, "customer_api", at, "json")
        stream = arrivals.read_arrivals(spark, root, "customer_api", "json", customer.schema)
        arrivals.on_arrival(stream, handle, checkpoint).awaitTermination()
    silver = tables.read_table(spark, layers.silver_table)
    return silver.groupBy("c_mktsegment", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_payload(spark, sf_dir):
    """Payload files as a stream: records go one way, unusable input the other."""
    products = _products(table(spark, sf_dir, "part"))
    whole = F.to_json(F.struct(*products.columns))
    text = F.when(F.col("description") == "PROMO", F.lit('{"id":"x"}')).otherwise(whole)
    root = scratch_path(spark, "staged")
    staged = files.staged_path(root, "part_api", FIRST, "json")
    (
        products.groupBy(_page().alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(text), ","), F.lit("]")).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(staged)
    )
    good, errored = scratch_path(spark, "good"), scratch_path(spark, "errored")
    stream = arrivals.read_payload_arrivals(spark, root, "part_api", types.record_schema(PRODUCT_FIELDS))
    handler = arrivals.split_payload(arrivals.replace_batch(good), arrivals.replace_batch(errored))
    arrivals.on_arrival(stream, handler, scratch_path(spark, "offsets")).awaitTermination()
    records = spark.read.parquet(good).groupBy("description").agg(F.count(F.lit(1)).alias("n"))
    rest = spark.read.parquet(errored).groupBy(F.col("outcome").alias("description")).agg(F.count(F.lit(1)).alias("n"))
    return records.unionByName(rest)
