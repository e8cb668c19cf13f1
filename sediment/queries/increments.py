"""Queries about layers that are kept up to date by what each load changes, row by row.

Like the others each reads whole tables and has SQL that gives the same rows.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from sediment.plans import medallion, warehouse
from sediment.queries.edges import _sales, _source
from sediment.queries.oracle import CUSTOMER, CUSTOMER_KEYS, ORDER, T1, T2, columns
from sediment.queries.registry import _fresh_name, query
from sediment.queries.snapshots import FIRST, LATER_ORDERS, SECOND, later_orders, table
from sediment.sources import tables

ORACLE: dict[str, str] = {}
URGENT = "o_orderpriority in ('1-URGENT', '5-LOW')"
RULES = {
    "group_by": ["o_orderpriority", "o_orderstatus"],
    "measures": {
        "n": ("count", "*"),
        "revenue": ("sum", "price"),
        "customers": ("count_distinct", "o_custkey"),
        "largest": ("max", "o_totalprice"),
        "mean_key": ("avg", "o_orderkey"),
    },
}
_TOTALS = """
select o_orderpriority, o_orderstatus, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue,
       count(distinct o_custkey) as customers, max(o_totalprice) as largest, avg(o_orderkey) as mean_key
from rows group by o_orderpriority, o_orderstatus"""


def _priced(orders):
    return orders.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))


def _totals(spark, sf_dir, delta):
    orders = table(spark, sf_dir, "orders")
    layers = medallion.Medallion(spark, _fresh_name(spark, "orders"), ["o_orderkey"], "orders_file", "0.1")
    later = later_orders(orders).where(URGENT) if delta else later_orders(orders)
    for batch, at, rows in ((1, FIRST, orders), (2, SECOND, later), (2, SECOND, later)):
        layers.load_bronze(_priced(rows), at)
        layers.load_silver(batch, at, delta=delta and batch > 1)
        layers.load_gold(at, RULES)
    found = tables.read_table(spark, layers.gold_table).withColumn("revenue", F.col("revenue").cast("double"))
    return found.select(*RULES["group_by"], *RULES["measures"])


@query
def gold_increment(spark, sf_dir):
    """Totals after a second full load, run twice, from what it changed."""
    return _totals(spark, sf_dir, False)


@query
def gold_increment_delta(spark, sf_dir):
    """The same for a delta load, which reads only the buckets of its keys."""
    return _totals(spark, sf_dir, True)


ORACLE["gold_increment"] = f"with rows as ({LATER_ORDERS}) {_TOTALS}"
ORACLE["gold_increment_delta"] = f"""
with later as (select * from ({LATER_ORDERS}) where {URGENT}),
 rows as (select * from later union all
          select * from orders o where not exists (select 1 from later l where l.o_orderkey = o.o_orderkey))
{_TOTALS}"""


@query
def medallion_rows(spark, sf_dir):
    """Every row of silver and gold after two loads, the second a delta run twice."""
    orders = table(spark, sf_dir, "orders")
    layers = medallion.Medallion(spark, _fresh_name(spark, "orders"), ["o_orderkey"], "orders_file", "0.1")
    later = later_orders(orders).where(URGENT)
    layers.run(orders, 1, FIRST)
    layers.run(later, 2, SECOND, delta=True)
    layers.run(later, 2, SECOND, delta=True)
    shown = ["o_orderkey", *ORDER, "ingestion_timestamp"]
    silver = tables.read_table(spark, layers.silver_table).select(*shown, "status", F.col("batch_id").alias("load"))
    gold = tables.read_table(spark, layers.gold_table).select(*shown, F.lit("gold").alias("status"))
    return silver.unionByName(gold, allowMissingColumns=True)


_ALIKE = " and ".join(f"l.{c} is not distinct from o.{c}" for c in ORDER)
ORACLE["medallion_rows"] = f"""
with later as (select * from ({LATER_ORDERS}) where {URGENT}),
 delta as (select l.o_orderkey, {", ".join(f"l.{c}" for c in ORDER)}, case when o.o_orderkey is null then 'new' else 'changed' end as status
           from later l left join orders o on l.o_orderkey = o.o_orderkey
           where o.o_orderkey is null or not ({_ALIKE}))
select o_orderkey, {columns(ORDER)}, {T1} as ingestion_timestamp, 'new' as status, cast(1 as bigint) as load from orders
union all select o_orderkey, {columns(ORDER)}, {T2}, status, 2 from delta
union all select o_orderkey, {columns(ORDER)}, {T2}, 'gold', null from later
union all select o_orderkey, {columns(ORDER)}, {T2}, 'gold', null from orders o
where not exists (select 1 from later l where l.o_orderkey = o.o_orderkey)"""


def _carried_on(spark, sf_dir):
    """Two runs, of which the second closes and moves a few customers and brings the urgent orders anew."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    people, full = _source(spark, "customer", "c_custkey"), _source(spark, "orders", "o_orderkey")
    spec = _sales(spark, "sales", full, people)
    segment = F.when(F.col("c_acctbal") > 9500, "MOVED").otherwise(F.col("c_mktsegment"))
    moved = customer.where("c_acctbal >= -900").withColumn("c_mktsegment", segment)
    urgent = later_orders(orders).where("o_orderpriority = '1-URGENT'")
    delta = replace(full, load_type="Delta")
    for batch, at, entry, members, sold in ((1, FIRST, full, customer, orders), (2, SECOND, delta, moved, urgent)):
        data = {people.source_name: members, entry.source_name: sold}
        warehouse.Warehouse(spark, batch, at).run([people, entry], [spec], data=data)
    return f"dim.{people.source_name}", f"fact.{spec.name}"


@query
def warehouse_increment_dimension(spark, sf_dir):
    """A dimension carried on by the members that a run changed; the others are not written again."""
    return tables.read_table(spark, _carried_on(spark, sf_dir)[0]).select("surrogate_key", *CUSTOMER, "valid_from")


ORACLE["warehouse_increment_dimension"] = f"""
select surrogate_key, {columns(CUSTOMER)}, {T1} as valid_from from {CUSTOMER_KEYS} where c_acctbal between -900 and 9500
union all select * replace ('MOVED' as c_mktsegment) from
 (select surrogate_key, {columns(CUSTOMER)}, {T2} from {CUSTOMER_KEYS} where c_acctbal > 9500)"""


@query
def warehouse_increment_fact(spark, sf_dir):
    """A fact carried on by the rows of a delta load, and by those whose member is no more."""
    return tables.read_table(spark, _carried_on(spark, sf_dir)[1])


ORACLE["warehouse_increment_fact"] = f"""
with rows as (select * replace (case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus) from orders)
select coalesce(surrogate_key, -1) as customer_key, o_orderkey, {columns(ORDER)}
from rows left join (select * from {CUSTOMER_KEYS} where c_acctbal >= -900) d on o_custkey = c_custkey"""
