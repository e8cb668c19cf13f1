"""Queries at the edges of the contracts: reruns, split loads, late members, broken records.

Like the others each reads whole tables and has SQL that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.functions import types
from sediment.functions.cleaning import one_per_key
from sediment.operators import history, model, quality
from sediment.plans import medallion, warehouse
from sediment.queries.oracle import CUSTOMER, CUSTOMER_KEYS, ORDER, T1, T2, columns
from sediment.queries.registry import _fresh_name, query
from sediment.queries.snapshots import FIRST, SECOND, LATER_ORDERS, later_orders, table
from sediment.session import scratch_path
from sediment.sinks import files as file_sinks
from sediment.sinks import tables as table_sinks
from sediment.sources import control, files, tables
from sediment.streaming import arrivals

ORACLE: dict[str, str] = {}
MOVED = "case when c_mktsegment = 'BUILDING' then 'MACHINERY' else c_mktsegment end"


def _moved(customer: DataFrame) -> DataFrame:
    """A later load: builders have become machinists, and furniture customers are gone."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "MACHINERY").otherwise(F.col("c_mktsegment"))
    return customer.where("c_mktsegment <> 'FURNITURE'").withColumn("c_mktsegment", segment)


def _source(spark, label: str, key: str, **more: object) -> control.Source:
    row = {"Source_Type": "table", "Source_Name": _fresh_name(spark, label), "Connection": "none", "Primary Key": key}
    return control.source(row | more)


# --- reruns -----------------------------------------------------------------------


@query
def medallion_rerun(spark, sf_dir):
    """A second load with wrong values, then again with the right ones, which change nothing."""
    customer = table(spark, sf_dir, "customer")
    layers = medallion.Medallion(spark, _fresh_name(spark, "customer"), ["c_custkey"], "customer_api", "0.1")
    layers.run(customer, 1, FIRST)
    layers.run(customer.withColumn("c_name", F.lit("WRONG")).where("c_mktsegment <> 'FURNITURE'"), 2, SECOND)
    layers.run(customer, 2, SECOND)
    silver = tables.read_table(spark, layers.silver_table).select(*CUSTOMER, "status", "batch_id")
    gold = tables.read_table(spark, layers.gold_table).select(*CUSTOMER, F.lit("gold").alias("status"))
    return silver.unionByName(gold, allowMissingColumns=True)


ORACLE["medallion_rerun"] = f"""
select {columns(CUSTOMER)}, 'new' as status, cast(1 as bigint) as batch_id from customer
union all select {columns(CUSTOMER)}, 'gold', null from customer"""


@query
def warehouse_rerun(spark, sf_dir):
    """The same for type 2 history: what the first attempt opened and closed is gone."""
    customer = table(spark, sf_dir, "customer")
    entry = _source(spark, "customer", "c_custkey")

    def load(batch, at, rows):
        run = warehouse.Warehouse(spark, batch, at)
        run.run([entry], data={entry.source_name: rows})
        return run

    load(1, FIRST, customer)
    load(2, SECOND, customer.withColumn("c_name", F.lit("WRONG")).where("c_mktsegment <> 'FURNITURE'"))
    return load(2, SECOND, customer).full_history(entry).select(*CUSTOMER, "valid_from", "valid_to", "is_current")


ORACLE["warehouse_rerun"] = f"""
select {columns(CUSTOMER)}, {T1} as valid_from, cast(null as timestamp) as valid_to, true as is_current from customer"""


@query
def history_status_column(spark, sf_dir):
    """Orders whose own column is named status, and nothing but it changes."""
    first = table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status")
    second = first.withColumn("status", F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("status")))
    entry = _source(spark, "orders", "o_orderkey")
    for batch, at, rows in ((1, FIRST, first), (2, SECOND, second)):
        run = warehouse.Warehouse(spark, batch, at)
        run.run([entry], data={entry.source_name: rows})
    return run.full_history(entry).select("o_orderkey", "status", "valid_from", "valid_to", "is_current")


ORACLE["history_status_column"] = f"""
select o_orderkey, o_orderstatus as status, {T1} as valid_from,
       case when o_orderpriority = '1-URGENT' and o_orderstatus <> 'X' then {T2} end as valid_to,
       not (o_orderpriority = '1-URGENT' and o_orderstatus <> 'X') as is_current from orders
union all
select o_orderkey, 'X', {T2}, null, true from orders where o_orderpriority = '1-URGENT' and o_orderstatus <> 'X'"""


@query
def silver_first_load_duplicates(spark, sf_dir):
    """A first load whose keys repeat is refused; the report tells which."""
    lines = table(spark, sf_dir, "lineitem")
    grain = ["l_orderkey", "l_linenumber"]
    layers = medallion.Medallion(spark, _fresh_name(spark, "lineitem"), grain)
    try:
        layers.run(lines, 1, FIRST)
    except Exception as error:
        if "Duplicate keys" not in str(error):
            raise
        return quality.primary_key_violations(lines, grain)
    raise AssertionError("repeated keys were loaded")


ORACLE["silver_first_load_duplicates"] = """
select l_orderkey, l_linenumber, count(*) as n, 'duplicate' as rule from lineitem
group by l_orderkey, l_linenumber having count(*) > 1"""


@query
def silver_one_per_key(spark, sf_dir):
    """Of lines with the same number the last shipped stays."""
    prefer = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey")]
    kept = one_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], prefer)
    return kept.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


ORACLE["silver_one_per_key"] = """
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc) as r from lineitem)
where r = 1"""


# --- times ------------------------------------------------------------------------


@query
def fact_point_in_time_ties(spark, sf_dir):
    """Observations by day, so that many versions begin and end at once; some lack a start."""
    events = table(spark, sf_dir, "events")
    daily = events.select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_id", "event_type")
    spans = history.versions(daily, "user_id", ["day", "event_id"], ["event_type"])
    started = F.when(F.col("event_type") != "purchase", F.col("valid_from"))
    spans = spans.withColumn("valid_from", started).withColumn("since", started).withColumnRenamed("event_type", "state")
    asked = events.select("event_id", "user_id", "ts")
    return model.point_in_time(asked, spans, "user_id", "ts", ["state", "since"])


ORACLE["fact_point_in_time_ties"] = """
with marked as (
  select event_id, user_id, date_trunc('day', ts) as day, event_type,
         lag(event_type) over (partition by user_id order by date_trunc('day', ts), event_id) as before,
         row_number() over (partition by user_id order by date_trunc('day', ts), event_id) as r from events),
 spans as (
  select event_id, user_id, event_type as state, day as since,
         lead(day) over (partition by user_id order by day, event_id) as until
  from marked where r = 1 or event_type is distinct from before),
 good as (select * from spans where state <> 'purchase')
select e.event_id, e.user_id, e.ts, g.state, cast(g.since as timestamp) as since
from events e left join good g on e.user_id = g.user_id and e.ts >= g.since and (g.until is null or e.ts < g.until)"""


# --- facts ------------------------------------------------------------------------


def _sales(spark, name: str, orders: control.Source, people: control.Source, **more) -> warehouse.Fact:
    keys = {"customer_key": (people.source_name, {"o_custkey": "c_custkey"})}
    return warehouse.Fact(_fresh_name(spark, name), orders.source_name, keys, ["o_orderkey", *ORDER, *more.pop("extra", ())], **more)


@query
def warehouse_delta_facts(spark, sf_dir):
    """A full load, then a delta of changed and new orders; the other orders stay."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    later = later_orders(orders).where("o_orderpriority in ('1-URGENT', '5-LOW')")
    people = _source(spark, "customer", "c_custkey")
    full = _source(spark, "orders", "o_orderkey")
    delta = control.Source(full.source_type, full.source_name, full.connection, full.primary_key, load_type="Delta")
    spec = _sales(spark, "sales", full, people)
    for batch, at, entry, rows in ((1, FIRST, full, orders), (2, SECOND, delta, later), (2, SECOND, delta, later)):
        run = warehouse.Warehouse(spark, batch, at)
        found = run.run([people, entry], [spec], data={people.source_name: customer, entry.source_name: rows})
    return found[spec.name]


ORACLE["warehouse_delta_facts"] = f"""
with later as (select * from ({LATER_ORDERS}) where o_orderpriority in ('1-URGENT', '5-LOW')),
 rows as (select * from later union all
          select * from orders o where not exists (select 1 from later l where l.o_orderkey = o.o_orderkey))
select coalesce(d.surrogate_key, -1) as customer_key, o_orderkey, {columns(ORDER)}
from rows left join {CUSTOMER_KEYS} d on o_custkey = c_custkey"""


@query
def warehouse_late_member(spark, sf_dir):
    """Orders of customers not known yet point to the unknown member, and the foreign key holds."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    people, sold = _source(spark, "customer", "c_custkey"), _source(spark, "orders", "o_orderkey")
    spec = _sales(spark, "sales", sold, people)
    rules = [
        quality.PrimaryKey(people.source_name, ("c_custkey",)),
        quality.ForeignKey(spec.name, people.source_name, (("customer_key", "surrogate_key"),)),
    ]
    data = {people.source_name: customer.where("c_mktsegment <> 'FURNITURE'"), sold.source_name: orders}
    found = warehouse.Warehouse(spark, 1, FIRST, unknown_member=True).run([people, sold], [spec], rules, data)
    members = found[people.source_name].select(F.col("surrogate_key").alias("customer_key"), "c_mktsegment")
    return found[spec.name].join(members, "customer_key").select("o_orderkey", "c_mktsegment")


ORACLE["warehouse_late_member"] = """
select o_orderkey, nullif(c_mktsegment, 'FURNITURE') as c_mktsegment from orders join customer on o_custkey = c_custkey"""


@query
def warehouse_as_of(spark, sf_dir):
    """Orders with the segment their customer had when they were loaded in the first or second run."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    people, sold = _source(spark, "customer", "c_custkey"), _source(spark, "orders", "o_orderkey")
    spec = _sales(
        spark, "sales", sold, people, extra=["segment"], as_of={"customer_key": ("asked", {"c_mktsegment": "segment"})}
    )
    asked = F.when(F.col("o_orderpriority") < "3", F.lit(FIRST.isoformat())).otherwise(F.lit(SECOND.isoformat()))
    step = {sold.source_name: lambda df, source: df.withColumn("asked", asked.cast("timestamp_ntz"))}
    for batch, at, rows in ((1, FIRST, customer), (2, SECOND, _moved(customer))):
        run = warehouse.Warehouse(spark, batch, at, step)
        found = run.run([people, sold], [spec], data={people.source_name: rows, sold.source_name: orders})
    return found[spec.name].select("o_orderkey", "segment")


ORACLE["warehouse_as_of"] = f"""
select o_orderkey, case when o_orderpriority < '3' then c_mktsegment
                        when c_mktsegment <> 'FURNITURE' then {MOVED} end as segment
from orders join customer on o_custkey = c_custkey"""


# --- records ----------------------------------------------------------------------


@query
def csv_quarantine(spark, sf_dir):
    """Balances of builders arrive as text: those records are set aside, whole."""
    customer = table(spark, sf_dir, "customer")
    balance = F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(F.col("c_acctbal").cast("string"))
    path = scratch_path(spark, "csv")
    file_sinks.write_csv(customer.withColumn("c_acctbal", balance), path, customer.columns)
    good, errored = files.read_records(spark, path, "csv", customer.schema)
    parts = F.split("record", ",")
    aside = errored.select(parts[0].cast("bigint").alias("c_custkey"), parts[1].alias("c_name"), F.lit("errored").alias("outcome"))
    kept = good.select("c_custkey", "c_name", "c_acctbal", F.lit("good").alias("outcome"))
    return kept.unionByName(aside, allowMissingColumns=True)


ORACLE["csv_quarantine"] = """
select c_custkey, c_name, case when c_mktsegment <> 'BUILDING' then c_acctbal end as c_acctbal,
       case when c_mktsegment <> 'BUILDING' then 'good' else 'errored' end as outcome from customer"""


@query
def json_lines_quarantine(spark, sf_dir):
    """Keys of urgent orders arrive as text, lines of low ones are cut off."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    whole = F.to_json(F.struct(*orders.columns))
    named = F.to_json(F.struct(F.concat(F.lit("no "), "o_orderkey").alias("o_orderkey"), "o_custkey"))
    text = F.when(F.col("o_orderpriority") == "1-URGENT", named).otherwise(whole)
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.substring(whole, 1, 12)).otherwise(text)
    path = scratch_path(spark, "json")
    orders.select(text.alias("value")).write.text(path)
    good, errored = files.read_records(spark, path, "json", orders.schema, lines=True)
    kept = good.select("o_orderkey", "o_totalprice", F.lit(None).cast("string").alias("record"))
    return kept.unionByName(errored.select("record"), allowMissingColumns=True)


ORACLE["json_lines_quarantine"] = """
select o_orderkey, o_totalprice, null as record from orders where o_orderpriority not in ('1-URGENT', '5-LOW')
union all select null, null, '{"o_orderkey":"no ' || o_orderkey || '","o_custkey":' || o_custkey || '}' from orders
where o_orderpriority = '1-URGENT'
union all select null, null, substr('{"o_orderkey":' || o_orderkey || ',"o_custkey":', 1, 12) from orders
where o_orderpriority = '5-LOW'"""


@query
def csv_reordered_header(spark, sf_dir):
    """Columns are found by their names."""
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv")
    file_sinks.write_csv(part, path, part.columns[::-1])
    return files.read_files(spark, path, "csv", part.schema)


ORACLE["csv_reordered_header"] = "select * from part"


@query
def staged_documents(spark, sf_dir):
    """Texts with line breaks, landed as csv and read back from the staged tree."""
    documents = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "staged")
    file_sinks.land(documents, root, "documents_api", FIRST, "csv")
    return files.read_staged(spark, root, "documents_api", "csv", documents.schema).drop("staged_source", "staged_state")


ORACLE["staged_documents"] = f"select *, {T1} as staged_at from documents"


@query
def object_scan(spark, sf_dir):
    """One object of a bucket."""
    supplier = table(spark, sf_dir, "supplier")
    root = scratch_path(spark, "objects")
    supplier.write.parquet(files.object_path(root, "landing", "2026/supplier.parquet"))
    return files.read_object(spark, "landing", "/2026/supplier.parquet", "parquet", root)


ORACLE["object_scan"] = "select * from supplier"


@query
def control_stored(spark, sf_dir):
    """A source extracted as a stored control row tells, staged and stamped."""
    entry = _source(spark, "supplier", "s_suppkey", Source_Type="parquet", Connection=f"{sf_dir}/supplier.parquet")
    definition = {
        "Source_Type": entry.source_type,
        "Source_Name": entry.source_name,
        "Connection": entry.connection,
        "Primary Key": "s_suppkey",
    }
    stored = warehouse.create_control_table(spark, f"staging.{_fresh_name(spark, 'control')}", [definition])
    plan = control.load_plan(stored)
    staged = warehouse.Warehouse(spark, 1, FIRST).stage(plan[0], warehouse.extract_source(spark, plan[0]))
    return staged.select("s_suppkey", "s_name", "ingestion_timestamp", F.lit(stored.first().load_type).alias("load_type"))


ORACLE["control_stored"] = f"select s_suppkey, s_name, {T1} as ingestion_timestamp, 'Full' as load_type from supplier"


@query
def json_variant(spark, sf_dir):
    """A JSON column kept parsed, in a table and back."""
    events = table(spark, sf_dir, "events").select("event_id", "props")
    name = f"{medallion.BRONZE}.{_fresh_name(spark, 'events')}"
    declared = types.table_types({"columns": {"props": {"type": "JSON"}}}, variant=True)
    table_sinks.load_table(events, name, types=declared)
    return tables.read_table(spark, name).select("event_id", F.try_variant_get("props", "$.k", "int").alias("k"))


ORACLE["json_variant"] = "select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k from events"


# --- arriving loads ---------------------------------------------------------------


def _layers_over_loads(spark, sf_dir, catch_ups, **landing):
    """Silver and gold of customers after two landed loads."""
    customer = table(spark, sf_dir, "customer")
    root, checkpoint = scratch_path(spark, "staged"), scratch_path(spark, "offsets")
    layers = medallion.Medallion(spark, _fresh_name(spark, "customer"), ["c_custkey"], "customer_api", "0.1")
    max_files = landing.pop("max_files", None)

    def handle(rows, load, at):
        layers.spark = rows.sparkSession
        layers.run(rows, load, at)

    def catch_up():
        stream = arrivals.read_arrivals(spark, root, "customer_api", "json", customer.schema, max_files=max_files)
        handler = arrivals.per_load(root, "customer_api", "json", customer.schema, handle)
        arrivals.on_arrival(stream, handler, checkpoint).awaitTermination()

    for at, rows in ((FIRST, customer), (SECOND, _moved(customer))):
        file_sinks.land(rows.repartition(3), root, "customer_api", at, "json", **landing)
        if catch_ups == 2:
            catch_up()
    if catch_ups == 1:
        catch_up()
    silver = tables.read_table(spark, layers.silver_table).select("c_custkey", "c_mktsegment", "status", "ingestion_timestamp")
    gold = tables.read_table(spark, layers.gold_table).select("c_custkey", "c_mktsegment", F.lit("gold").alias("status"))
    return silver.unionByName(gold, allowMissingColumns=True)


_LAYERS = f"""
select c_custkey, c_mktsegment, 'new' as status, {T1} as ingestion_timestamp from customer
union all select c_custkey, 'MACHINERY', 'changed', {T2} from customer where c_mktsegment = 'BUILDING'
union all select c_custkey, null, 'deleted', {T2} from customer where c_mktsegment = 'FURNITURE'
union all select c_custkey, {MOVED}, 'gold', null from customer where c_mktsegment <> 'FURNITURE'"""


@query
def stream_two_loads_one_catch_up(spark, sf_dir):
    """Two loads wait when the stream starts; each runs the layers on its own."""
    return _layers_over_loads(spark, sf_dir, 1)


@query
def stream_split_load(spark, sf_dir):
    """Loads of several files, one file per micro-batch."""
    return _layers_over_loads(spark, sf_dir, 2, max_files=1)


ORACLE["stream_two_loads_one_catch_up"] = ORACLE["stream_split_load"] = _LAYERS


@query
def stream_failed_batch(spark, sf_dir):
    """A handler fails after it has written; the batch comes again and is stored once."""
    supplier = table(spark, sf_dir, "supplier")
    root, out, checkpoint = scratch_path(spark, "staged"), scratch_path(spark, "stream"), scratch_path(spark, "offsets")
    file_sinks.land(supplier, root, "supplier_api", FIRST, "json")
    store, failures = arrivals.replace_batch(out), [True]

    def handle(rows, batch_id):
        store(rows, batch_id)
        if failures and failures.pop():
            raise RuntimeError("the first attempt stops here")

    for _ in range(2):
        stream = arrivals.read_arrivals(spark, root, "supplier_api", "json", supplier.schema)
        try:
            arrivals.on_arrival(stream, handle, checkpoint).awaitTermination()
        except Exception as error:
            if "the first attempt stops here" not in str(error):
                raise
    return spark.read.parquet(out).select(*supplier.columns, "batch_id")


ORACLE["stream_failed_batch"] = "select *, cast(0 as bigint) as batch_id from supplier"


@query
def stream_quarantine(spark, sf_dir):
    """Lines that do not fit go one way, records the other, from one parse of each batch."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    root = scratch_path(spark, "staged")
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.substring("c_name", 1, 9)).otherwise(F.to_json(F.struct(*customer.columns)))
    customer.select(text.alias("value")).write.text(files.staged_path(root, "customer_api", FIRST, "json"))
    good, errored = scratch_path(spark, "good"), scratch_path(spark, "errored")
    stream = arrivals.read_arrivals(spark, root, "customer_api", "json", customer.schema, keep_corrupt=True)
    handler = arrivals.split_records(arrivals.replace_batch(good), arrivals.replace_batch(errored))
    arrivals.on_arrival(stream, handler, scratch_path(spark, "offsets")).awaitTermination()
    kept = spark.read.parquet(good).select("c_custkey", "c_mktsegment", "staged_at")
    return kept.unionByName(spark.read.parquet(errored).select("record", "staged_at"), allowMissingColumns=True)


ORACLE["stream_quarantine"] = f"""
select c_custkey, c_mktsegment, null as record, {T1} as staged_at from customer where c_mktsegment <> 'BUILDING'
union all select null, null, substr(c_name, 1, 9), {T1} from customer where c_mktsegment = 'BUILDING'"""

