"""Gold: one row per month that has transactions.

The windows here have no partition. They run after the aggregation, over one row per calendar month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlake.functions import labels, money

_MONTH = "transaction_month"


def monthly_core(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(_MONTH)
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            money.total(F.col("amount")).alias("_total"),
            F.count("amount").alias("_amounts"),
            F.count_distinct("customer_id").alias("active_customers"),
            F.count_distinct("merchant_id").alias("active_merchants"),
            F.count_if(labels.flagged()).alias("flagged_transactions"),
            F.count_if(labels.equals("status", "failed")).alias("failed_transactions"),
        )
        .select(
            _MONTH,
            "total_transactions",
            money.as_amount(F.col("_total")).alias("total_volume"),
            money.mean_of(F.col("_total"), F.col("_amounts")).alias("avg_transaction_value"),
            "active_customers",
            "active_merchants",
            "flagged_transactions",
            "failed_transactions",
        )
    )


def with_growth(core: DataFrame) -> DataFrame:
    """Change against the previous month present; null for the first month."""
    volume, rows = F.col("total_volume"), F.col("total_transactions")
    by_month = Window.orderBy(_MONTH)
    return core.withColumns(
        {
            "prev_month_volume": F.lag(volume).over(by_month),
            "prev_month_transactions": F.lag(rows).over(by_month),
        }
    ).withColumns(
        {
            "mom_volume_growth_pct": labels.percent_change(volume, F.col("prev_month_volume")),
            "mom_transaction_growth_pct": labels.percent_change(rows, F.col("prev_month_transactions")),
        }
    )


def with_running_total(core: DataFrame) -> DataFrame:
    so_far = Window.orderBy(_MONTH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = money.total(F.col("total_volume"), so_far)
    return core.withColumn("running_total_volume", money.as_amount(running))


def monthly_trends(silver: DataFrame) -> DataFrame:
    return trends(monthly_core(silver))


def trends(core: DataFrame) -> DataFrame:
    return (
        core.transform(with_growth)
        .transform(with_running_total)
        .select(
            _MONTH,
            "total_transactions",
            "total_volume",
            "avg_transaction_value",
            "active_customers",
            "active_merchants",
            "flagged_transactions",
            "failed_transactions",
            "prev_month_volume",
            "mom_volume_growth_pct",
            "prev_month_transactions",
            "mom_transaction_growth_pct",
            "running_total_volume",
        )
        .orderBy(_MONTH)
    )
