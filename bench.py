"""Time the headline queries: one JSON line.

Queries up to silver start from the star-schema tables; gold tables and key figures start from a stored silver, as they
do in a run. Each query is run to its last row (no-op sink). ``layered_run`` is the whole batch: CSV files to bronze,
silver, gold and key figures, all written; its CSV input is made beforehand. ``layered_run_small`` is the same over
the smallest tables. Times are medians of BENCH_REPEATS runs (default 5) in a warm session; every other run goes
through the queries backwards, so that none always follows the same one. ``notes`` holds what plans are chosen by:
shuffled megabytes of the customer core as it is and pre-aggregated, and seconds and files of writing silver by month
and in one piece.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import money
from remitlake.operators import cleaning, customers, merchants, months
from remitlake.plans import registry
from remitlake.plans.layers import gold_tables, run_layers
from remitlake.plans.summary import pipeline_summary
from remitlake.sources.landing import write_transactions_csv
from remitlake.sources.layers import gathered_by_month, write_by_month, write_table
from remitlake.sources.sample_tables import raw_transactions
from remitlake.sources.shared import fresh_path

SMALL = "/root/testdata/sf0.001"
FROM_TABLES = ("raw_fixture", "raw_profile", "silver_dedup", "silver", "silver_roundtrip", "silver_quality_report")
FROM_SILVER = {
    "customer_core": customers.customer_core,
    "customer_preferred_category": lambda silver: customers.preferred_value(silver, "merchant_category", "preferred_category"),
    "customer_summary": customers.customer_summary,
    "merchant_core": merchants.merchant_core,
    "merchant_analytics": merchants.merchant_analytics,
    "monthly_core": months.monthly_core,
    "monthly_trends": months.monthly_trends,
    "kpi_summary": lambda silver: pipeline_summary(gold_tables(silver)),
}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def to_the_last_row(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffled_mb(spark: SparkSession, df: DataFrame) -> float:
    """Megabytes that the stages of one run write for shuffles, from the event log."""
    log = Path(spark.conf.get("spark.eventLog.dir").removeprefix("file://"))
    written = lambda: sum(
        json.loads(line)["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
        for f in log.iterdir()
        for line in f.open()
        if '"SparkListenerTaskEnd"' in line and '"Task Metrics"' in line
    )
    before = written()
    to_the_last_row(df)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return round((written() - before) / 1e6, 2)


def pre_aggregated_core(silver: DataFrame) -> DataFrame:
    """The customer core from rows that are first summed by customer, merchant and month."""
    fine = silver.groupBy("customer_id", "merchant_id", "transaction_month").agg(
        F.count(F.lit(1)).alias("n"), money.total(F.col("amount")).alias("total"), F.max("amount").alias("most"), F.min("amount").alias("least")
    )
    return fine.groupBy("customer_id").agg(
        F.sum("n"), F.sum("total"), F.max("most"), F.min("least"), F.count_distinct("merchant_id"), F.count_distinct("transaction_month")
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    memory_gb = max(2, os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (2 << 30))
    logs = os.path.abspath(f"spark-warehouse/events-{os.getpid()}")
    os.makedirs(logs)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("remitlake bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", f"{memory_gb}g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{logs}")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    landing, landing_small = fresh_path(spark, "landing"), fresh_path(spark, "landing")
    write_transactions_csv(raw_transactions(spark, sf_dir), landing)
    write_transactions_csv(raw_transactions(spark, SMALL), landing_small)
    made = cleaning.to_silver(registry.bronze_rows(spark, sf_dir))
    silver = write_by_month(gathered_by_month(made), silver_path := fresh_path(spark, "silver"))

    queries = registry.queries()
    actions = {name: (lambda q=queries[name]: to_the_last_row(q(spark, sf_dir))) for name in FROM_TABLES}
    actions |= {name: (lambda build=build: to_the_last_row(build(silver))) for name, build in FROM_SILVER.items()}
    actions["layered_run"] = lambda: run_layers(spark, landing, fresh_path(spark, "run")).kpis.collect()
    actions["layered_run_small"] = lambda: run_layers(spark, landing_small, fresh_path(spark, "run")).kpis.collect()

    for action in actions.values():  # warm up
        action()
    runs: dict[str, list[float]] = {name: [] for name in actions}
    for turn in range(repeats):
        for name in list(actions) if turn % 2 == 0 else reversed(list(actions)):
            runs[name].append(timed(actions[name]))
    seconds = {name: round(statistics.median(times), 3) for name, times in runs.items()}
    notes = {
        "customer_core_shuffle_mb": shuffled_mb(spark, customers.customer_core(silver)),
        "customer_core_pre_aggregated_shuffle_mb": shuffled_mb(spark, pre_aggregated_core(silver)),
        "silver_by_month_files": len(glob.glob(f"{silver_path.removeprefix('file:')}/*/*.parquet")),
        "silver_by_month_sec": round(timed(lambda: write_by_month(gathered_by_month(silver), fresh_path(spark, "by_month"))), 3),
        "silver_in_one_piece_sec": round(timed(lambda: write_table(silver, fresh_path(spark, "whole"))), 3),
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "notes": notes,
            }
        )
    )


if __name__ == "__main__":
    main()
