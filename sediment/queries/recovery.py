"""Queries about what goes wrong and is put right: faults, repeated older runs, misplaced files.

Like the others each reads whole tables and has SQL that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sediment.plans import warehouse
from sediment.queries.edges import MOVED, _moved, _source
from sediment.queries.oracle import CUSTOMER, T1, T2, T3, columns
from sediment.queries.registry import _fresh_name, query
from sediment.queries.snapshots import FIRST, SECOND, THIRD, table
from sediment.session import materialise, scratch_path
from sediment.sinks import files as file_sinks
from sediment.sinks.publication import read_published
from sediment.sources import arrays, files, payload, tables
from sediment.streaming import arrivals, ledger

ORACLE: dict[str, str] = {}


@query
def warehouse_publish_fault(spark, sf_dir):
    """The second of two names fails while it is published: both are as before. Then the run is repeated."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    people, firms = _source(spark, "customer", "c_custkey"), _source(spark, "supplier", "s_suppkey")

    def load(batch, at, moved, announce=None):
        rows = {people.source_name: customer, firms.source_name: supplier}
        if moved:
            rows = {people.source_name: _moved(customer), firms.source_name: supplier.withColumn("s_acctbal", F.lit(0.0))}
        warehouse.Warehouse(spark, batch, at, announce=announce).run([people, firms], data=rows)

    def state(name):
        a = tables.read_table(spark, f"dim.{people.source_name}")
        b = tables.read_table(spark, f"dim.{firms.source_name}")
        a = a.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), "valid_from")
        b = b.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), "valid_from")
        return materialise(a.unionByName(b, allowMissingColumns=True).withColumn("state", F.lit(name)), "state")

    def broken(entry):
        if entry.table.endswith(firms.source_name):
            raise RuntimeError("the second name fails")

    load(1, FIRST, False)
    try:
        load(2, SECOND, True, broken)
    except RuntimeError as error:
        if "the second name fails" not in str(error):
            raise
    held = state("after the fault")
    load(2, SECOND, True)
    return held.unionByName(state("repeated"))


ORACLE["warehouse_publish_fault"] = f"""
select c_custkey as id, c_mktsegment as segment, {T1} as valid_from, cast(null as double) as balance, 'after the fault' as state
from customer
union all select s_suppkey, null, {T1}, s_acctbal, 'after the fault' from supplier
union all select c_custkey, {MOVED}, case when c_mktsegment = 'BUILDING' then {T2} else {T1} end, null, 'repeated'
from customer where c_mktsegment <> 'FURNITURE'
union all select s_suppkey, null, case when s_acctbal <> 0 then {T2} else {T1} end, 0, 'repeated' from supplier"""


@query
def warehouse_state_before(spark, sf_dir):
    """After two runs the state before stays readable, beside the one that names stand for."""
    customer, people = table(spark, sf_dir, "customer"), _source(spark, "customer", "c_custkey")
    for batch, at, rows in ((1, FIRST, customer), (2, SECOND, _moved(customer))):
        warehouse.Warehouse(spark, batch, at).run([people], data={people.source_name: rows})
    name = f"dim.{people.source_name}"
    return (
        tables.read_table(spark, name).select(*CUSTOMER, F.lit("now").alias("state"))
        .unionByName(read_published(spark, name, age=1).select(*CUSTOMER, F.lit("before").alias("state")))
    )


ORACLE["warehouse_state_before"] = f"""
select {columns(CUSTOMER)}, 'before' as state from customer
union all select * replace ({MOVED} as c_mktsegment) from
 (select {columns(CUSTOMER)}, 'now' as state from customer where c_mktsegment <> 'FURNITURE')"""


def _replayed(spark, sf_dir):
    """Runs 1, 2 and 3, then run 2 again with other rows: the source, and the run that did it."""
    customer, people = table(spark, sf_dir, "customer"), _source(spark, "customer", "c_custkey")
    wrong = customer.withColumn("c_name", F.lit("WRONG")).where("c_mktsegment <> 'MACHINERY'")
    loads = [(1, FIRST, customer), (2, SECOND, wrong), (3, THIRD, customer), (2, SECOND, _moved(customer))]
    for batch, at, rows in loads:
        run = warehouse.Warehouse(spark, batch, at)
        found = run.run([people], data={people.source_name: rows})
    return people, warehouse.Warehouse(spark, 3, THIRD), found[people.source_name]


@query
def warehouse_replay_older(spark, sf_dir):
    """An older run repeated: the history is that of its new rows, with the later run done again."""
    people, newest, _ = _replayed(spark, sf_dir)
    return newest.full_history(people).select(*CUSTOMER, "valid_from", "valid_to", "is_current")


ORACLE["warehouse_replay_older"] = f"""
with c as (select {columns(CUSTOMER)} from customer), b as (select * from c where c_mktsegment = 'BUILDING')
select *, {T1} as valid_from, case when c_mktsegment in ('BUILDING', 'FURNITURE') then {T2} end as valid_to,
       c_mktsegment not in ('BUILDING', 'FURNITURE') as is_current from c
union all select * replace ('MACHINERY' as c_mktsegment), {T2}, {T3}, false from b
union all select *, {T3}, null, true from c where c_mktsegment in ('BUILDING', 'FURNITURE')"""


@query
def warehouse_replay_older_dimension(spark, sf_dir):
    """What readers see after it is the newest run's state, under the surrogate keys given before."""
    people, _, _ = _replayed(spark, sf_dir)
    return tables.read_table(spark, f"dim.{people.source_name}").select("surrogate_key", *CUSTOMER, "valid_from")


ORACLE["warehouse_replay_older_dimension"] = f"""
select row_number() over (order by c_custkey) as surrogate_key, {columns(CUSTOMER)},
       case when c_mktsegment in ('BUILDING', 'FURNITURE') then {T3} else {T1} end as valid_from from customer"""


def _arrivals(spark, sf_dir):
    """A landed load, a file whose name tells no load, and a csv file among the JSON ones."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    root = scratch_path(spark, "staged")
    file_sinks.land(customer.where("c_mktsegment NOT IN ('BUILDING', 'FURNITURE')"), root, "customer_api", FIRST, "json")
    folder = f"{root}/customer_api/{files.STAGED}"
    customer.where("c_mktsegment = 'BUILDING'").write.json(f"{folder}/api_export.json")
    customer.where("c_mktsegment = 'FURNITURE'").write.csv(files.staged_path(root, "customer_api", SECOND, "csv"))
    good, aside = scratch_path(spark, "good"), scratch_path(spark, "errored")
    arrived = ledger.Ledger(root, "customer_api", "json", customer.schema, _fresh_name(spark, "customer_api"), move=True)
    handler = arrived.handler(lambda rows, load, at: arrivals.replace_batch(good)(rows, load), arrivals.replace_batch(aside))
    for _ in range(2):  # the second finds nothing to do
        stream = arrivals.read_arrivals(spark, root, "customer_api", "json", customer.schema)
        arrivals.on_arrival(stream, handler, scratch_path(spark, "offsets")).awaitTermination()
    return root, customer.schema, arrived, spark.read.parquet(good), spark.read.parquet(aside)


@query
def stream_misnamed_file(spark, sf_dir):
    """Records of files that belong to no load are set aside, whole; those of the load are handled."""
    _, _, _, good, aside = _arrivals(spark, sf_dir)
    key = F.coalesce(F.get_json_object("record", "$.c_custkey"), F.substring_index("record", ",", 1)).cast("bigint")
    kept = good.select("c_custkey", "c_mktsegment", F.lit("handled").alias("outcome"), "batch_id")
    return kept.unionByName(aside.select(key.alias("c_custkey"), F.lit("set aside").alias("outcome"), "batch_id"), allowMissingColumns=True)


_STRAY = "c_mktsegment in ('BUILDING', 'FURNITURE')"
ORACLE["stream_misnamed_file"] = f"""
select c_custkey, case when not {_STRAY} then c_mktsegment end as c_mktsegment,
       case when {_STRAY} then 'set aside' else 'handled' end as outcome,
       cast(case when {_STRAY} then 0 else 20260101000000 end as bigint) as batch_id from customer"""


@query
def stream_files_moved(spark, sf_dir):
    """Afterwards each file is in the folder that its outcome tells, as the ledger has it."""
    root, schema, arrived, _, _ = _arrivals(spark, sf_dir)
    loaded = files.read_staged(spark, root, "customer_api", "json", schema, files.LOADED).select("c_custkey", "staged_state")
    errored = spark.read.option("recursiveFileLookup", True).text(f"{root}/customer_api/{files.ERRORED}")
    key = F.coalesce(F.get_json_object("value", "$.c_custkey"), F.substring_index("value", ",", 1)).cast("bigint")
    there = loaded.unionByName(errored.select(key.alias("c_custkey"), F.lit(files.ERRORED).alias("staged_state")))
    left = files.staged_files(spark, root, "customer_api", "json").count()
    noted = arrived.files(spark).groupBy("outcome").agg(F.count_distinct("staged_at").alias("loads"))
    noted = noted.withColumn("staged_state", F.when(F.col("outcome") == "loaded", files.LOADED).otherwise(files.ERRORED))
    return there.join(noted, "staged_state").withColumn("left", F.lit(left).cast("bigint"))


ORACLE["stream_files_moved"] = f"""
select c_custkey, case when {_STRAY} then '00_errored_files' else '01_loaded_files' end as staged_state,
       case when {_STRAY} then 'errored' else 'loaded' end as outcome,
       cast(case when {_STRAY} then 0 else 1 end as bigint) as loads, cast(0 as bigint) as "left" from customer"""


@query
def json_array_split(spark, sf_dir):
    """One file with one array of all customers, read in blocks that end at any byte; some records do not fit."""
    customer = table(spark, sf_dir, "customer")
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit('"},{"'), "c_name", F.lit("\\"))).otherwise(F.col("c_name"))
    key = F.when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("no "), "c_custkey")).otherwise(F.col("c_custkey").cast("string"))
    key = F.when(F.col("c_mktsegment") == "FURNITURE", F.to_json(F.struct(key.alias("c_custkey")))).otherwise(
        F.to_json(F.struct("c_custkey", name.alias("c_name"), "c_mktsegment"))
    )
    path = scratch_path(spark, "array")
    lines = customer.select(key.alias("value")).withColumn("closing", F.lit(False))
    lines = lines.unionByName(spark.range(1).select(F.lit("").alias("value"), F.lit(True).alias("closing")))
    # One task writes the one file, line by line, and holds none of it.
    lines = lines.repartition(1).sortWithinPartitions("closing")
    mark = F.concat(F.when(F.monotonically_increasing_id() == 0, "[").otherwise(""), F.when(F.col("closing"), "]").otherwise(""))
    comma = F.when((F.monotonically_increasing_id() > 0) & ~F.col("closing"), ",").otherwise("")
    lines.select(F.concat(comma, mark, "value").alias("value")).write.text(path)
    found = arrays.parse_arrays(spark, path, customer.select("c_custkey", "c_name", "c_mktsegment").schema, 8 << 10)
    good = payload.good_records(found).withColumn("outcome", F.lit("record"))
    return good.unionByName(payload.errored_records(found).select("outcome", "element"), allowMissingColumns=True)


ORACLE["json_array_split"] = """
select c_custkey, case when c_mktsegment = 'BUILDING' then '"},{"' || c_name || chr(92) else c_name end as c_name, c_mktsegment,
       'record' as outcome, null as element from customer where c_mktsegment <> 'FURNITURE'
union all select null, null, null, 'corrupt_record', '{"c_custkey":"no ' || c_custkey || '"}' from customer
where c_mktsegment = 'FURNITURE'"""
