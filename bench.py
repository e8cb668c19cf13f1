"""Time the headline queries and print one JSON line.

All queries run once cold; then each runs ``BENCH_RUNS`` times warm. Its figure is the
warm median, planning and all files it writes included. Results go to a sink that
discards rows, so every row is computed. As a yardstick the SQL of each query is timed on
another engine over the same files, into a table in memory; it shares the cores and writes
none of the files that a load writes.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

import pyspark

from sediment.queries import ORACLE, QUERIES
from sediment.session import build_session

HEADLINE = [
    "row_hash_lineitem",
    "row_hash_text",
    "snapshot_diff_keyed",
    "snapshot_diff_rows",
    "snapshot_diff_composite_key",
    "snapshot_diff_null_keys",
    "snapshot_diff_keyless",
    "silver_increment",
    "gold_latest",
    "gold_aggregate",
    "latest_version",
    "history_scd1",
    "history_scd2",
    "history_scd2_merge",
    "surrogate_keys",
    "surrogate_keys_composite",
    "dim_customer",
    "fact_orders",
    "fact_lineitem",
    "fact_orders_monthly",
    "fact_point_in_time",
    "duplicate_keys",
    "pk_check",
    "fk_check",
    "json_payload_ingest",
    "csv_text_roundtrip",
    "stream_ingest",
    "medallion_run",
    "warehouse_run",
]


def yardstick(sf_dir: str, names: list[str], cpus: int, runs: int) -> dict[str, float]:
    """Warm median seconds of each query's SQL."""
    import duckdb

    connection = duckdb.connect(config={"threads": cpus})
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"create view {name} as select * from '{files}'")
    taken = {}
    for name in names:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            connection.execute(f"create or replace temp table result as {ORACLE[name]}")
            seconds.append(time.perf_counter() - start)
        taken[name] = round(statistics.median(seconds), 3)
    return taken


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "sediment-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sediment-bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    cold = {name: round(timed(name), 3) for name in only}
    warm = {}
    for name in only:
        warm[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        print(f"{name}: {cold[name]} cold, {warm[name]} warm", file=sys.stderr, flush=True)
    spark.stop()
    duckdb = yardstick(sf_dir, only, int(cpus), runs)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "duckdb": duckdb,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": pyspark.__version__,
            }
        )
    )


if __name__ == "__main__":
    main()
