"""Every query by name, over the star-schema tables in a directory.

Each starts from the raw transactions derived from the whole tables. Processing times differ from run to run, so
they are left out of results; timestamps are shown without a zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from remitlake.contract import KEPT, RAW_COLUMNS
from remitlake.operators import checks, cleaning, customers, merchants, months, profile, series
from remitlake.operators.ingest import with_ingestion_metadata
from remitlake.plans import layers, summary
from remitlake.plans.lake import Lake
from remitlake.sources.clustered import write_clustered
from remitlake.sources.landing import read_transactions_csv, write_transactions_csv
from remitlake.sources.layers import LayerPaths, write_by_month, write_table
from remitlake.sources.sample_tables import raw_transactions
from remitlake.sources.shared import discard, few_folders_at_once, folder, fresh_path, remove, shuffles_released, small_splits, stored

Query = Callable[[SparkSession, str], DataFrame]

SOURCE = "landing/transactions.csv"
A_MONTH = "1998-06"

_PROCESSING_TIMES = ("ingestion_timestamp", "silver_processed_timestamp")


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ingestion_metadata(raw_transactions(spark, sf_dir), SOURCE)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.to_silver(bronze_rows(spark, sf_dir))


def _shown(df: DataFrame) -> DataFrame:
    times = [c for c, kind in df.dtypes if kind == "timestamp" and c not in _PROCESSING_TIMES]
    return df.drop(*_PROCESSING_TIMES).withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


# --- layers that are written and read back -----------------------------------------------------------------------


def _paths(spark: SparkSession) -> LayerPaths:
    return LayerPaths(fresh_path(spark, "layers"))


def _stored_bronze(spark: SparkSession, sf_dir: str, paths: LayerPaths) -> DataFrame:
    return write_table(bronze_rows(spark, sf_dir), paths.bronze)


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = layers.silver_by_month(bronze_rows(spark, sf_dir), Observation())
    return write_by_month(silver.select(*_silver(spark, sf_dir).columns), _paths(spark).silver)


def _stored_layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    paths = _paths(spark)
    bronze = _stored_bronze(spark, sf_dir, paths)
    silver, _ = layers.run_silver(bronze, paths)
    return bronze, silver, layers.run_gold(silver, paths)


def silver_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stored_bronze(spark, sf_dir, _paths(spark))
    with small_splits(spark):
        return stored(cleaning.quality_report(bronze), "quality")


def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fresh_path(spark, "landing")
    write_transactions_csv(raw_transactions(spark, sf_dir), landing)
    return read_transactions_csv(spark, landing)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_stored_bronze(spark, sf_dir, _paths(spark)))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_stored_silver(spark, sf_dir))


def silver_month_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_roundtrip(spark, sf_dir).filter(F.col("transaction_month") == A_MONTH)


def _gold_roundtrip(table: str) -> Query:
    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = _stored_silver(spark, sf_dir)
        with small_splits(spark):
            return _shown(write_table(layers.GOLD[table](silver), _paths(spark).gold(table)))

    return read_back


def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run: CSV files to bronze, silver, gold and the key figures of what was delivered."""
    landing = fresh_path(spark, "landing")
    with shuffles_released(spark):
        write_transactions_csv(raw_transactions(spark, sf_dir), landing)
    run = layers.run_layers(spark, landing, fresh_path(spark, "layers"), taken_in=lambda: discard(spark, landing))
    return run.kpis


def _received_as_silver(kept: DataFrame) -> DataFrame:
    return cleaning.received_as_silver(with_ingestion_metadata(kept, SOURCE))


def _clustered(key: str, step: Callable[[DataFrame], DataFrame]) -> Query:
    """A grouping over silver that is stored by the key of the grouping."""

    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Only columns as received pass through the shuffles; what is the same in all rows or made of others comes after.
        copies = cleaning.one_copy_each(raw_transactions(spark, sf_dir))
        kept = cleaning.with_fate_as_received(copies).filter(F.col("fate") == KEPT).drop("fate", "transaction_month")
        path = fresh_path(spark, "clustered")
        return _shown(step(write_clustered(kept, path, key, buckets, then=_received_as_silver)))

    return read_back


# --- deliveries one after the other ------------------------------------------------------------------------------


def _delivered(table: str, deliveries: int = 2) -> Query:
    """A table after all rows have come in several deliveries; copies of a transaction may come in different ones."""

    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The rows are derived once, each into the folder of its delivery.
        landing = fresh_path(spark, "landing")
        drawn = F.pmod(F.xxhash64(*RAW_COLUMNS), F.lit(deliveries))
        with shuffles_released(spark), few_folders_at_once(spark):
            write_transactions_csv(raw_transactions(spark, sf_dir).withColumn("delivery", drawn), landing, by="delivery")
        lake = Lake(spark, fresh_path(spark, "lake"), gold=[table.removeprefix("gold/")] if table.startswith("gold/") else [])
        for n in range(deliveries):
            delivery = folder(spark, f"{landing}/delivery={n}")
            lake.load(delivery)
            remove(spark, delivery)  # bronze has its rows now
        return _shown(lake.read(table))

    return read_back


def _with_malformed(spark: SparkSession, sf_dir: str) -> str:
    """Landing files of which some records cannot be read: by order and line a field too few or too many, or no number or flag."""
    raw = raw_transactions(spark, sf_dir)
    place = F.split("transaction_id", "-")
    drawn = raw.withColumn("_drawn", F.pmod(place[1].cast("long") + 3 * place[2].cast("long"), F.lit(40)))
    bent = drawn.withColumns(
        {
            "amount": F.when(F.col("_drawn") == 3, F.lit("12.5 EUR")).otherwise(F.col("amount").cast("string")),
            "is_flagged": F.when(F.col("_drawn") == 4, F.lit("maybe")).otherwise(F.col("is_flagged").cast("string")),
        }
    )
    landing = fresh_path(spark, "landing")
    write_transactions_csv(bent.where("_drawn = 1").drop("is_flagged", "_drawn"), f"{landing}/narrow")
    write_transactions_csv(bent.where("_drawn = 2").withColumn("_drawn", F.lit("a, b")), f"{landing}/wide")
    write_transactions_csv(bent.where("_drawn not in (1, 2)").drop("_drawn"), f"{landing}/usual")
    return f"{landing}/*"


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(transaction_id, reason, rows) of the records that could not be read."""
    lake = Lake(spark, fresh_path(spark, "lake"), gold=[])
    lake.load(_with_malformed(spark, sf_dir))
    rejects = lake.read("bronze/rejects").withColumn("transaction_id", F.split("text", ",")[0])
    return rejects.groupBy("transaction_id", "reason").agg(F.count(F.lit(1)).alias("rows"))


# --- queries over one derived frame ------------------------------------------------------------------------------


def _of_raw(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(raw_transactions(spark, sf_dir))


def _of_bronze(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _shown(step(bronze_rows(spark, sf_dir)))


def _of_silver(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _shown(step(_silver(spark, sf_dir)))


def _of_stored_silver(step: Callable[[DataFrame], DataFrame]) -> Query:
    """For tables that read silver several times: it is made once, and so is the table."""

    def made(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = _stored_silver(spark, sf_dir)
        with small_splits(spark):
            return _shown(stored(step(silver), "gold"))

    return made


def _of_months(step: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_silver(lambda silver: step(months.monthly_trends(silver)))


def _of_layers(step: Callable[[DataFrame, DataFrame, dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(*_stored_layers(spark, sf_dir))


def _has_ingestion_timestamp(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("has_ingestion_timestamp", F.col("ingestion_timestamp").isNotNull())


def _required(raw: DataFrame) -> DataFrame:
    return raw.transform(cleaning.one_copy_each).transform(cleaning.require_columns)


def _positive(raw: DataFrame) -> DataFrame:
    return _required(raw).transform(cleaning.require_valid_amount)


def _standard(raw: DataFrame) -> DataFrame:
    return _positive(raw).transform(cleaning.standardise_domains)


def _timed(raw: DataFrame) -> DataFrame:
    timed = _standard(raw).transform(cleaning.with_transaction_time)
    return timed.transform(cleaning.require_transaction_time)


def queries() -> dict[str, Query]:
    key = list(merchants.MERCHANT_KEY)
    growth = ["prev_month_volume", "mom_volume_growth_pct", "prev_month_transactions", "mom_transaction_growth_pct"]
    return {
        # raw and bronze
        "raw_fixture": raw_transactions,
        "raw_profile": _of_raw(profile.raw_profile),
        "bronze_csv_scan": bronze_csv_scan,
        "bronze_metadata": _of_bronze(_has_ingestion_timestamp),
        "bronze_roundtrip": bronze_roundtrip,
        # silver, step by step
        "silver_dedup": _of_raw(cleaning.one_copy_each),
        "silver_drop_nulls": _of_raw(_required),
        "silver_valid_amounts": _of_raw(_positive),
        "silver_categoricals": _of_raw(
            lambda raw: _standard(raw).select("transaction_id", "currency", "channel", "status")
        ),
        "silver_timestamps": _of_bronze(
            lambda bronze: _timed(bronze.select(*RAW_COLUMNS)).select(
                "transaction_id", "transaction_timestamp", "transaction_month", "day_of_week"
            )
        ),
        "silver_metadata": _of_bronze(lambda bronze: _timed(bronze).transform(cleaning.with_silver_metadata)),
        "silver": _of_bronze(cleaning.to_silver),
        "silver_roundtrip": silver_roundtrip,
        "silver_month_pruned_scan": silver_month_pruned_scan,
        "silver_quality_report": silver_quality_report,
        "silver_domains": _of_silver(profile.value_domains),
        # gold: customers
        "customer_core": _of_silver(customers.customer_core),
        "customer_channel_counts": _of_silver(lambda silver: customers.value_counts(silver, "channel")),
        "customer_category_counts": _of_silver(lambda silver: customers.value_counts(silver, "merchant_category")),
        "customer_preferred_channel": _of_silver(
            lambda silver: customers.preferred_value(silver, "channel", "preferred_channel")
        ),
        "customer_preferred_category": _of_silver(
            lambda silver: customers.preferred_value(silver, "merchant_category", "preferred_category")
        ),
        "customer_fraud_score": _of_silver(
            lambda silver: customers.fraud_score(customers.customer_core(silver)).select(
                "customer_id", "fraud_risk_score"
            )
        ),
        "customer_segment": _of_silver(
            lambda silver: customers.segment(customers.customer_core(silver)).select("customer_id", "customer_segment")
        ),
        "customer_summary": _of_stored_silver(customers.customer_summary),
        # gold: merchants
        "merchant_core": _of_silver(merchants.merchant_core),
        "merchant_rank": _of_stored_silver(
            lambda silver: merchants.rank_in_category(merchants.merchant_core(silver)).select(
                *key, "rank_in_category"
            )
        ),
        "merchant_risk": _of_silver(
            lambda silver: merchants.risk_flag(merchants.merchant_core(silver)).select(*key, "merchant_risk_flag")
        ),
        "merchant_analytics": _of_stored_silver(merchants.merchant_analytics),
        # gold: months
        "monthly_core": _of_silver(months.monthly_core),
        "monthly_mom_growth": _of_silver(
            lambda silver: months.with_growth(months.monthly_core(silver)).select("transaction_month", *growth)
        ),
        "monthly_running_total": _of_silver(
            lambda silver: months.with_running_total(months.monthly_core(silver)).select(
                "transaction_month", "running_total_volume"
            )
        ),
        "monthly_trends": _of_silver(months.monthly_trends),
        "gold_roundtrip": _gold_roundtrip("monthly_trends"),
        "gold_customers_roundtrip": _gold_roundtrip("customer_summary"),
        "gold_merchants_roundtrip": _gold_roundtrip("merchant_analytics"),
        # summary and samples
        "pipeline_summary": pipeline_summary,
        "kpi_summary": _of_layers(lambda bronze, silver, gold: summary.pipeline_summary(gold)),
        "sample_customers": _of_stored_silver(lambda silver: summary.sample_customers(customers.customer_summary(silver))),
        "sample_merchants": _of_stored_silver(lambda silver: summary.sample_merchants(merchants.merchant_analytics(silver))),
        "sample_months": _of_months(summary.sample_months),
        # quality and reconciliation
        "dq_key_uniqueness": _of_layers(lambda bronze, silver, gold: checks.key_uniqueness(silver, gold)),
        "dq_null_counts": _of_layers(checks.null_counts),
        "dq_domains": _of_layers(checks.domains),
        "dq_ranges": _of_layers(lambda bronze, silver, gold: checks.ranges(silver, gold)),
        "dq_business_rules": _of_layers(lambda bronze, silver, gold: checks.business_rules(gold)),
        "dq_running_total": _of_months(checks.running_total),
        "dq_first_month": _of_months(checks.first_month),
        "recon_orphans": _of_layers(checks.orphans),
        "recon_totals": _of_layers(
            lambda bronze, silver, gold: checks.totals(silver, gold["customer_summary"], gold["monthly_trends"])
        ),
        "recon_row_accounting": recon_row_accounting,
        # other ways of storing, finer series
        "clustered_customers": _clustered("customer_id", customers.customer_summary_by_key),
        "clustered_merchants": _clustered("merchant_id", merchants.merchant_core),
        "hourly_trends": _of_silver(lambda silver: series.period_trends(silver, "hour")),
        # several deliveries
        "bronze_rejects": bronze_rejects,
        "merged_silver": lambda spark, sf_dir: _delivered("silver/transactions")(spark, sf_dir).drop("source_file"),
        "merged_customers": _delivered("gold/customer_summary"),
        "merged_merchants": _delivered("gold/merchant_analytics"),
        "merged_months": _delivered("gold/monthly_trends"),
    }


def recon_row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _paths(spark)
    bronze = _stored_bronze(spark, sf_dir, paths)
    silver, report = layers.run_silver(bronze, paths)
    return checks.row_accounting(bronze, silver, report)
