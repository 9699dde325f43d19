"""Run the layers. Each one is written, and the next one starts from what was written."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from remitlake import contract as C
from remitlake.operators import cleaning
from remitlake.operators.customers import customer_summary
from remitlake.operators.ingest import BRONZE_METADATA, actual_file, with_ingestion_metadata
from remitlake.operators.merchants import merchant_analytics
from remitlake.operators.months import monthly_trends
from remitlake.plans.summary import pipeline_summary
from remitlake.sources.landing import read_transactions_csv
from remitlake.sources.layers import LayerPaths, gathered_by_month, write_by_month, write_table
from remitlake.sources.shared import shuffles_released, small_splits


@dataclass(frozen=True)
class Layers:
    bronze: DataFrame
    silver: DataFrame
    quality_report: DataFrame
    gold: dict[str, DataFrame]
    kpis: DataFrame


# A column for corrupt records stays in bronze.
BRONZE_COLUMNS = (*C.RAW_COLUMNS, *BRONZE_METADATA)

GOLD = {
    "customer_summary": customer_summary,
    "merchant_analytics": merchant_analytics,
    "monthly_trends": monthly_trends,
}


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return {name: build(silver) for name, build in GOLD.items()}


def run_bronze(
    spark: SparkSession,
    source: str,
    paths: LayerPaths,
    *,
    strict_header: bool = False,
    corrupt_column: str | None = None,
    each_file: bool = False,
) -> DataFrame:
    """Write bronze. ``each_file`` records the file that a row came from in place of the path that was asked for."""
    raw = read_transactions_csv(spark, source, strict_header=strict_header, corrupt_column=corrupt_column)
    with small_splits(spark), shuffles_released(spark):
        return write_table(with_ingestion_metadata(raw, actual_file() if each_file else source), paths.bronze)


def run_silver(
    bronze: DataFrame,
    paths: LayerPaths,
    *,
    on_bad_timestamp: str = "reject",
) -> tuple[DataFrame, DataFrame]:
    """Write silver from stored bronze, by month; return it and the quality report, counted by the same job.

    The counts are taken after the last shuffle, in the tasks that write: a task that is run again because an
    executor was lost is counted once. What rows are judged by and get is made after the shuffles: only columns as received
    pass through them, without the layer's name, which silver replaces.
    """
    fates = Observation()
    silver = silver_by_month(bronze, fates, on_bad_timestamp)
    spark = bronze.sparkSession
    with small_splits(spark), shuffles_released(spark):
        stored = write_by_month(silver, paths.silver)
    counted = fates.get
    # Bronze is stored: counting it reads file footers.
    duplicates = bronze.count() - sum(counted.values())
    report = [(C.DUPLICATE, duplicates), *counted.items()]
    return stored, spark.createDataFrame(report, "reason string, rows bigint")


def silver_by_month(bronze: DataFrame, fates: Observation, on_bad_timestamp: str = "reject") -> DataFrame:
    """Silver gathered by month; ``fates`` has the counts when it has been written."""
    received = bronze.select(*[c for c in bronze.columns if c in BRONZE_COLUMNS and c != "pipeline_layer"])
    copies = received.transform(cleaning.one_copy_each, pack=True).transform(cleaning.with_transaction_time)
    return (
        copies.drop("transaction_timestamp", "day_of_week")
        .transform(gathered_by_month)
        .transform(cleaning.judged)
        .observe(fates, *cleaning.fate_counts())
        .transform(_kept, on_bad_timestamp)
        .transform(cleaning.with_silver_metadata)
    )


def _kept(fates: DataFrame, on_bad_timestamp: str) -> DataFrame:
    wanted = [C.KEPT] if on_bad_timestamp == "reject" else [C.KEPT, C.BAD_TIMESTAMP]
    kept = fates.filter(F.col("fate").isin(wanted)).drop("fate")
    return cleaning.require_transaction_time(kept, on_bad_timestamp)


def run_gold(silver: DataFrame, paths: LayerPaths) -> dict[str, DataFrame]:
    """The tables do not depend on each other: they are submitted together, so that one fills the slots another
    leaves idle."""

    def build(name: str) -> DataFrame:
        return write_table(GOLD[name](silver), paths.gold(name))

    spark = silver.sparkSession
    with small_splits(spark), shuffles_released(spark), ThreadPoolExecutor(len(GOLD)) as pool:
        return dict(zip(GOLD, pool.map(inheritable_thread_target(spark)(build), GOLD)))


def run_layers(
    spark: SparkSession,
    source: str,
    base_path: str,
    *,
    on_bad_timestamp: str = "reject",
    taken_in: Callable[[], None] = lambda: None,
    **landing_options,
) -> Layers:
    """All layers from a CSV path, each replaced whole; ``landing_options`` are those of ``run_bronze``.

    ``taken_in`` is called when bronze is stored: the files of the path are not read again.
    """
    paths = LayerPaths(base_path)
    bronze = run_bronze(spark, source, paths, **landing_options)
    taken_in()
    silver, report = run_silver(bronze, paths, on_bad_timestamp=on_bad_timestamp)
    gold = run_gold(silver, paths)
    return Layers(bronze, silver, report, gold, pipeline_summary(gold))
