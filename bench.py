"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from pyspark.sql import SparkSession

from ledgerline import queries as engine
from ledgerline.operators import checks, transfer
from ledgerline.queries import corrupted, load

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WAREHOUSE = tempfile.mkdtemp(prefix="bench-")


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", WAREHOUSE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def copied(spark: SparkSession) -> None:
    """The transfer operator, from a catalog table into another schema."""
    found = transfer.transfer_table(spark, "bench_src", "lineitem", "bench_tgt")
    if not found.ok:
        raise RuntimeError(found.error)


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    orders, lines = load(spark, SF_DIR, "orders"), load(spark, SF_DIR, "lineitem")
    target = corrupted(orders)
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    steps = {
        "transfer_lineitem": lambda: copied(spark),
        "row_count_orders": lambda: checks.row_count(orders, target).collect(),
        "partition_counts_orders": lambda: checks.partition_counts(orders, target, "o_orderdate").collect(),
        "null_counts_orders": lambda: checks.null_counts(orders, target, orders.columns).collect(),
        "min_max_orders": lambda: checks.min_max(orders, target, ["o_totalprice", "o_custkey"]).collect(),
        "sums_orders": lambda: checks.aggregate_fingerprint(orders, target, "o_orderdate", ["o_totalprice"]).collect(),
        "row_sample_orders": lambda: checks.row_sample(orders, target, ["o_orderkey"], 1000).collect(),
        "partition_counts_lineitem": lambda: checks.partition_counts(lines, lines, "l_shipdate").collect(),
        "null_counts_lineitem": lambda: checks.null_counts(lines, lines, lines.columns).collect(),
        "sums_lineitem": lambda: checks.aggregate_fingerprint(lines, lines, "l_shipdate", numbers).collect(),
        "reconcile_orders": lambda: checks.reconcile(orders, target, "orders", ["o_orderkey"], 1000),
        "reconcile_lineitem": lambda: checks.reconcile(lines, lines, "lineitem"),
        "fk_orphans": lambda: engine.fk_orphans(spark, SF_DIR).collect(),
        "pk_duplicates": lambda: engine.pk_duplicates(spark, SF_DIR).collect(),
    }
    # the source of the transfer: an external table over the given file
    spark.sql("CREATE SCHEMA bench_src")
    spark.sql("CREATE SCHEMA bench_tgt")
    spark.catalog.createTable("bench_src.lineitem", f"{SF_DIR}/lineitem.parquet", "parquet")
    # the catalog and the writer are started by a table of five rows, which does not count
    spark.catalog.createTable("bench_src.region", f"{SF_DIR}/region.parquet", "parquet")
    transfer.transfer_table(spark, "bench_src", "region", "bench_tgt")
    found = {}
    for name, step in steps.items():
        began = time.time()
        step()
        found[name] = round(time.time() - began, 3)
    rows = lines.count()
    shutil.rmtree(WAREHOUSE, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of transfer and validation",
                "value": round(sum(found.values()), 3),
                "unit": "sec",
                "queries": found,
                "sf": SF_DIR.rstrip("/").rpartition("sf")[2],
                "transfer_rows_per_second": round(rows / found["transfer_lineitem"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
