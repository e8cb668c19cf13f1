"""The same queries as SQL over views of the test tables."""

from __future__ import annotations

from sediment.queries.snapshots import LATER_DOCUMENTS, LATER_LINEITEM, LATER_ORDERS

T1, T2, T3 = "timestamp '2026-01-01 00:00:00'", "timestamp '2026-01-02 00:00:00'", "timestamp '2026-01-03 00:00:00'"
STAMP = "'orders_file' as source, '0.1' as version"

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def sha(columns: list[str]) -> str:
    texts = ", ".join(f"coalesce(cast({c} as varchar), 'NULL')" for c in columns)
    return f"sha256(concat_ws('|', {texts}))"


def columns(names: list[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{name}" for name in names)


STATUS = """case when c.hit is null then 'new' when n.hit is null then 'deleted'
     when c.h = n.h then 'unchanged' else 'changed' end"""

DIFF = f"""
with cur as (select *, 1 as hit, {sha(ORDER)} as h from orders),
     inc as (select *, 1 as hit, {sha(ORDER)} as h from ({LATER_ORDERS})),
     diff as (
  select coalesce(c.o_orderkey, n.o_orderkey) as o_orderkey, {columns(ORDER, "n.")},
         c.h as hash_column_current, n.h as hash_column_new, {STATUS} as status
  from cur c full outer join inc n on c.o_orderkey = n.o_orderkey)
"""

SILVER = f"""{DIFF}, silver as (
  select o_orderkey, {columns(ORDER)}, 'new' as status, {STAMP}, {T1} as ingestion_timestamp from orders
  union all
  select o_orderkey, {columns(ORDER)}, status, {STAMP}, {T2} as ingestion_timestamp from diff where status <> 'unchanged'),
 ranked as (select *, row_number() over (partition by o_orderkey order by ingestion_timestamp desc) as r from silver),
 latest as (select * exclude (r) from ranked where r = 1 and status <> 'deleted')
"""

VERSIONS = """
with marked as (
  select event_id, user_id, ts, event_type,
         lag(event_type) over (partition by user_id order by ts, event_id) as before,
         row_number() over (partition by user_id order by ts, event_id) as r
  from events),
 points as (select event_id, user_id, ts, event_type from marked where r = 1 or event_type is distinct from before),
 spans as (
  select user_id, event_type, ts as valid_from,
         lead(ts) over (partition by user_id order by ts, event_id) as valid_to,
         lead(ts) over (partition by user_id order by ts, event_id) is null as is_current
  from points)
"""

CUSTOMER_KEYS = "(select *, row_number() over (order by c_custkey) as surrogate_key from customer)"
MONEY = "cast(sum(cast(o_totalprice as decimal(18,2))) as double)"
OTHER_CUSTOMERS = "(select * from customer where c_mktsegment <> 'FURNITURE')"
PRODUCT = """p_partkey as id, p_name as title, p_retailprice as price, p_type as description, p_brand as category,
  'img/' || cast(p_partkey as varchar) || '.png' as image"""

ORACLE: dict[str, str] = {
    "row_hash": f"select *, {sha(CUSTOMER)} as hash_column from customer",
    "row_hash_lineitem": f"select {columns(LINE_KEYS)}, {sha(LINE)} as hash_column from lineitem",
    "row_hash_subset": f"select o_orderkey, {sha(['o_orderstatus', 'o_totalprice', 'o_orderdate'])} as hash_column from orders",
    "row_hash_strict": """select c_custkey, sha256(cast(to_json({'c_custkey': c_custkey, 'c_name': c_name,
        'c_nationkey': c_nationkey, 'c_mktsegment': c_mktsegment}) as varchar)) as hash_column from customer""",
    "row_hash_text": f"select doc_id, {sha(['text', 'lang', 'source'])} as hash_column from documents",
    "add_metadata": f"select *, 'supplier_file' as source, '0.1' as version, {T1} as ingestion_timestamp from supplier",
    "snapshot_diff_keyed": f"{DIFF} select status, count(*) as n from diff group by status",
    "snapshot_diff_rows": f"{DIFF} select o_orderkey, {columns(ORDER)}, status from diff where status <> 'unchanged'",
    "snapshot_diff_full": f"{DIFF} select * from diff",
    "snapshot_diff_composite_key": f"""
with cur as (select *, 1 as hit, {sha(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])} as h from lineitem),
     inc as (select *, 1 as hit, {sha(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])} as h from ({LATER_LINEITEM}))
select {STATUS} as status, count(*) as n
from cur c full outer join inc n on {" and ".join(f"c.{k} = n.{k}" for k in LINE_KEYS)} group by 1""",
    "snapshot_diff_null_keys": f"""
with cur as (select nullif(o_orderkey, 42) as k, *, 1 as hit, {sha(ORDER)} as h from orders),
     inc as (select nullif(o_orderkey, 42) as k, *, 1 as hit, {sha(ORDER)} as h from ({LATER_ORDERS}))
select coalesce(c.k, n.k) as o_orderkey, n.o_custkey, {STATUS} as status
from cur c full outer join inc n on c.k is not distinct from n.k""",
    "snapshot_diff_keyless": f"""
with cur as (select distinct sha256(text) as h, 1 as hit from documents),
     inc as (select *, sha256(text) as h, 1 as hit from ({LATER_DOCUMENTS}))
select coalesce(c.h, n.h) as hash_column, n.doc_id, n.lang,
  case when c.hit is null then 'new' when n.hit is null then 'removed_or_changed' else 'unchanged' end as status
from cur c full outer join inc n on c.h = n.h""",
    "diff_flags": f"""{DIFF} select o_orderkey, status,
  case status when 'unchanged' then 'I' when 'changed' then 'C' when 'new' then 'N' end as flag from diff""",
    "delta_load_no_delete": f"""{DIFF} select o_orderkey, {columns(ORDER)}, status from diff
  where status not in ('unchanged', 'deleted')""",
    "silver_first_load": f"select *, 'new' as status, {STAMP}, {T1} as ingestion_timestamp from orders",
    "silver_increment": f"{SILVER} select * from silver",
    "silver_reappearing_keys": f"""{SILVER},
 live as (select *, 1 as hit, {sha(ORDER)} as h from latest),
 again as (select *, 1 as hit, {sha(ORDER)} as h from orders)
select coalesce(c.o_orderkey, n.o_orderkey) as o_orderkey, n.o_orderstatus, {STATUS} as status, {T3} as ingestion_timestamp
from live c full outer join again n on c.o_orderkey = n.o_orderkey
where c.hit is null or n.hit is null or c.h <> n.h""",
    "gold_latest": f"{SILVER} select * from latest",
    "gold_aggregate": f"""{SILVER} select o_orderstatus, count(*) as n_orders, {MONEY} as revenue,
  max(o_orderdate) as last_order, count(distinct o_custkey) as n_customers from latest group by o_orderstatus""",
    "medallion_run": f"""{DIFF}
select 'silver' as layer, cast(1 as bigint) as batch_id, 'new' as status, count(*) as n from orders
union all select 'silver', 2, status, count(*) from diff where status <> 'unchanged' group by status
union all select 'gold', 0, 'live', count(*) from diff where status <> 'deleted'""",
    "latest_version": """select * exclude (r) from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1""",
    "change_points": f"{VERSIONS} select * from points",
    "history_scd2": f"{VERSIONS} select * from spans",
    "history_scd1": f"""{DIFF}
select o_orderkey, {columns(ORDER)}, {STAMP}, case when status = 'unchanged' then {T1} else {T2} end as ingestion_timestamp
from diff where status <> 'deleted'""",
    "history_scd1_delta": f"""
select o_orderkey, {columns(ORDER)} from ({LATER_ORDERS})
union all
select o_orderkey, {columns(ORDER)} from orders where o_orderkey not in (select o_orderkey from ({LATER_ORDERS}))""",
    "history_scd2_merge": f"""{DIFF}
select o.o_orderkey, {columns(ORDER, "o.")}, {T1} as valid_from,
       case when d.status = 'unchanged' then null else {T2} end as valid_to, d.status = 'unchanged' as is_current
from orders o join diff d on o.o_orderkey = d.o_orderkey
union all
select o_orderkey, {columns(ORDER)}, {T2}, null, true from diff where status in ('new', 'changed')""",
    "history_scd2_merge_delta": f"""{DIFF}
select o.o_orderkey, o.o_orderstatus, {T1} as valid_from,
       case when d.status = 'changed' then {T2} end as valid_to, d.status <> 'changed' as is_current
from orders o join diff d on o.o_orderkey = d.o_orderkey
union all
select o_orderkey, o_orderstatus, {T2}, null, true from diff where status in ('new', 'changed')""",
    "surrogate_keys": "select c_custkey, row_number() over (order by c_custkey) as surrogate_key from customer",
    "surrogate_keys_composite": """select l_partkey, l_suppkey,
  row_number() over (order by l_partkey, l_suppkey) as surrogate_key
  from (select distinct l_partkey, l_suppkey from lineitem)""",
    "surrogate_keys_increment": """select c_custkey, row_number() over (
  order by case when c_mktsegment = 'BUILDING' then 0 else 1 end, c_custkey) as surrogate_key from customer""",
    "dim_customer": f"select * from {CUSTOMER_KEYS}",
    "fact_orders": f"""select coalesce(d.surrogate_key, -1) as customer_key, o_orderkey, o_totalprice, o_orderdate
  from orders left join {CUSTOMER_KEYS} d on o_custkey = c_custkey and c_mktsegment <> 'FURNITURE'""",
    "fact_lineitem": """select coalesce(p.k, -1) as part_key, coalesce(s.k, -1) as supplier_key,
  l_orderkey, l_linenumber, l_extendedprice from lineitem
  left join (select p_partkey, row_number() over (order by p_partkey) as k from part) p on l_partkey = p_partkey
  left join (select s_suppkey, row_number() over (order by s_suppkey) as k from supplier) s on l_suppkey = s_suppkey""",
    "fact_orders_monthly": f"""select c_mktsegment, o_orderpriority, strftime(o_orderdate, '%Y-%m') as order_month,
  count(*) as n_orders, {MONEY} as revenue
  from orders left join customer on o_custkey = c_custkey group by all""",
    "fact_point_in_time": f"""{VERSIONS}
select e.event_id, e.user_id, e.ts, e.value, s.event_type as state, s.valid_from as since
from events e left join spans s on e.user_id = s.user_id and e.ts >= s.valid_from
  and (s.valid_to is null or e.ts < s.valid_to)""",
    "warehouse_run": f"""select case when c_mktsegment = 'BUILDING' then 'MACHINERY' else c_mktsegment end as c_mktsegment,
  case when c_mktsegment = 'BUILDING' then {T2} else {T1} end as valid_from,
  cast(year(o_orderdate) as integer) as order_year, count(*) as n_orders, {MONEY} as revenue
  from orders join customer on o_custkey = c_custkey group by all""",
    "duplicate_keys": """select l_orderkey, l_linenumber, count(*) as n from lineitem
  group by l_orderkey, l_linenumber having count(*) > 1""",
    "pk_check": """select l_orderkey, ln as l_linenumber, count(*) as n,
  case when ln is null then 'null' else 'duplicate' end as rule
  from (select l_orderkey, case when l_returnflag <> 'R' then l_linenumber end as ln from lineitem)
  group by l_orderkey, ln having count(*) > 1 or ln is null""",
    "fk_check": f"""select o_custkey, count(*) as n from orders
  where not exists (select 1 from {OTHER_CUSTOMERS} where c_custkey = o_custkey) group by o_custkey""",
    "fk_orphans": f"select * from orders where not exists (select 1 from {OTHER_CUSTOMERS} where c_custkey = o_custkey)",
    "constraint_report": f"""
select 'lineitem' as table_name, 'primary key: duplicate' as rule, count(*) as n_keys, cast(sum(n) as bigint) as n_rows
from (select count(*) as n from lineitem group by l_orderkey having count(*) > 1) having count(*) > 0
union all
select 'lineitem', 'foreign key: orders', count(*), cast(sum(n) as bigint)
from (select count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders) group by l_orderkey)
having count(*) > 0
union all
select 'orders', 'foreign key: customer', count(*), cast(sum(n) as bigint)
from (select count(*) as n from orders
      where not exists (select 1 from {OTHER_CUSTOMERS} where c_custkey = o_custkey) group by o_custkey)
having count(*) > 0
union all
select 'customer', 'foreign key: nation', count(*), cast(sum(n) as bigint)
from (select count(*) as n from {OTHER_CUSTOMERS} where c_nationkey not in (select n_nationkey from nation) group by c_nationkey)
having count(*) > 0""",
    "json_payload_ingest": f"select {PRODUCT}, p_size / 10.0::double as rate, p_size as rating_count from part",
    "payload_quarantine": """select case when p_type = 'PROMO' then 'corrupt_record' else 'record' end as outcome,
  p_type as description, count(*) as n from part group by all""",
    "field_drift": """select 'colour' as field, 'undeclared' as drift, count(*) as n from part
  union all select 'image', 'missing', 0""",
    "item_lookup": "select p_partkey as id, p_name as title, p_retailprice as price from part where p_partkey = 42",
    "extract_run": """select p_partkey as id, p_name as title, p_retailprice as price,
  'img/' || cast(p_partkey as varchar) || '.png' as image, p_size as rating_count, p_size / 10.0::double as rate from part""",
    "csv_roundtrip": "select * from part",
    "csv_text_roundtrip": "select doc_id, text, lang from documents",
    "json_roundtrip": "select * from customer",
    "parquet_typed": """select p_partkey, p_name, cast(p_size as integer) as p_size, p_retailprice,
  cast(null as varchar) as p_color from part""",
    "declared_types": """select o_orderkey, cast(o_custkey as integer) as o_custkey, o_orderstatus,
  cast(cast(o_totalprice as decimal(12,1)) as double) as o_totalprice, o_orderdate, o_orderpriority from orders""",
    "json_column": "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "json_encode": "select p_partkey as id, p_size / 10.0::double as rate, p_size as rating_count from part",
    "silver_cleaning": """select p_partkey, p_name, upper(p_brand) as p_brand,
  case when p_type <> 'PROMO' then p_type end as p_type, cast(p_size as bigint) as p_size, p_retailprice from part""",
    "query_scan": """select o_orderkey, o_totalprice from orders
  where o_orderstatus = 'F' and o_totalprice >= 250000.0""",
    "table_load_modes": "select c_mktsegment, 2 * count(*) as n, 2 * count(*) as n_balance from customer group by c_mktsegment",
    "transform_registry": "select s_suppkey, s_name, s_nationkey, s_acctbal >= 0 as in_credit from supplier",
    "staged_tree_scan": f"""select 'customer_api' as staged_source, '00_staged_files' as staged_state, t.staged_at,
  count(*) as n, cast(sum(c_custkey) as bigint) as key_sum
  from customer, (select {T1} as staged_at union all select {T2}) t group by all""",
    "stream_ingest": f"""select o_orderkey, {columns(ORDER)}, {T1} as staged_at from orders
  union all select o_orderkey, {columns(ORDER)}, {T2} from ({LATER_ORDERS})""",
    "stream_medallion": """select c_mktsegment, 'new' as status, count(*) as n from customer group by c_mktsegment
  union all select 'MACHINERY', 'changed', count(*) from customer where c_mktsegment = 'BUILDING'""",
    "stream_payload": """select case when p_type = 'PROMO' then 'corrupt_record' else p_type end as description,
  count(*) as n from part group by all""",
}
