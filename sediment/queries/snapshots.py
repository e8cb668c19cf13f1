"""Two snapshots of a table: as it is, and as a later extract would bring it.

Both cover the whole table. The later one gives some rows a new key (their old key is
then gone) and alters others. The SQL texts say the same.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST = datetime(2026, 1, 1)
SECOND = datetime(2026, 1, 2)
THIRD = datetime(2026, 1, 3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def later_orders(orders: DataFrame) -> DataFrame:
    moved = F.when(F.col("o_orderpriority") == "5-LOW", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus"))
    return orders.withColumns({"o_orderkey": moved, "o_orderstatus": status})


LATER_ORDERS = """
select case when o_orderpriority = '5-LOW' then -1 - o_orderkey else o_orderkey end as o_orderkey,
       o_custkey,
       case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
from orders
"""


def later_lineitem(lineitem: DataFrame) -> DataFrame:
    moved = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber") + 100).otherwise(F.col("l_linenumber"))
    quantity = F.when(F.col("l_returnflag") == "A", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return lineitem.withColumns({"l_linenumber": moved, "l_quantity": quantity})


LATER_LINEITEM = """
select * replace (
    case when l_returnflag = 'R' then l_linenumber + 100 else l_linenumber end as l_linenumber,
    case when l_returnflag = 'A' then l_quantity + 1 else l_quantity end as l_quantity)
from lineitem
"""


def later_documents(documents: DataFrame) -> DataFrame:
    text = F.when(F.col("lang") == "de", F.concat("text", F.lit(" (neu)"))).otherwise(F.col("text"))
    return documents.withColumn("text", text)


LATER_DOCUMENTS = """
select * replace (case when lang = 'de' then text || ' (neu)' else text end as text) from documents
"""


def null_key(orders: DataFrame) -> DataFrame:
    """The same orders with one key turned to null."""
    return orders.withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(42).cast("bigint")))
