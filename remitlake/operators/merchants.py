"""Gold: one row per merchant id, name and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import labels, money
from remitlake.operators.ranking import with_rank_desc

MERCHANT_KEY = ("merchant_id", "merchant_name", "merchant_category")


def merchant_core(silver: DataFrame) -> DataFrame:
    return finished_core(
        silver.filter(F.col("merchant_category").isNotNull())
        .groupBy(*MERCHANT_KEY)
        .agg(*merchant_sums(), F.count_distinct("customer_id").alias("unique_customers"))
    )


def merchant_sums() -> list[Column]:
    """Aggregates that add up over parts of silver."""
    return [
        F.count("transaction_id").alias("total_transactions"),
        money.total(F.col("amount")).alias("_total"),
        F.count("amount").alias("_amounts"),
        F.count_if(labels.flagged()).alias("flagged_transactions"),
        F.count_if(labels.equals("status", "completed")).alias("completed_transactions"),
        F.count_if(labels.equals("currency", "GBP")).alias("gbp_transactions"),
        F.count_if(labels.equals("channel", "online")).alias("online_transactions"),
    ]


def finished_core(sums: DataFrame) -> DataFrame:
    """The core from exact sums per merchant."""
    return sums.select(
        *MERCHANT_KEY,
        "total_transactions",
        money.as_amount(F.col("_total")).alias("total_revenue"),
        money.mean_of(F.col("_total"), F.col("_amounts")).alias("avg_transaction_value"),
        "unique_customers",
        "flagged_transactions",
        "completed_transactions",
        "gbp_transactions",
        "online_transactions",
    )


def rank_in_category(core: DataFrame) -> DataFrame:
    return with_rank_desc(core, "merchant_category", "total_revenue", "rank_in_category")


def risk_flag(core: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.col("flagged_transactions"), F.col("total_transactions"))
    return core.withColumn("merchant_risk_flag", labels.risk_of(ratio))


def analysed(core: DataFrame) -> DataFrame:
    return core.transform(rank_in_category).transform(risk_flag)


def merchant_analytics(silver: DataFrame) -> DataFrame:
    return analysed(merchant_core(silver))
