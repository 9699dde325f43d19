"""Headline figures and sample rows of the gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake import contract as C
from remitlake.functions import labels, money


def pipeline_summary(gold: Mapping[str, DataFrame]) -> DataFrame:
    """One row of key figures over the three gold tables.

    Each table gives one partial row; the partial rows are united and folded, which needs no join.
    """
    customers = gold["customer_summary"].agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(labels.equals("customer_segment", "Premium")).alias("premium_customers"),
    )
    merchants = gold["merchant_analytics"].agg(
        F.count(F.lit(1)).alias("merchants"),
        F.count_if(labels.equals("merchant_risk_flag", "High Risk")).alias("high_risk_merchants"),
    )
    months = gold["monthly_trends"].agg(
        F.count(F.lit(1)).alias("months"),
        money.as_amount(money.total(F.col("total_volume"))).alias("total_volume"),
    )
    partial = customers.unionByName(merchants, True).unionByName(months, True)
    figures = ("customers", "merchants", "months", "high_risk_merchants", "premium_customers", "total_volume")
    return partial.agg(*(F.max(c).alias(c) for c in figures)).withColumn(
        "total_volume_display", F.concat(F.lit("£"), F.format_number("total_volume", 2))
    )


def sample_customers(customer_summary: DataFrame, rows: int = 5) -> DataFrame:
    return customer_summary.select(*C.SAMPLE_CUSTOMERS).orderBy("customer_id").limit(rows)


def sample_merchants(merchant_analytics: DataFrame, rows: int = 5) -> DataFrame:
    """The first merchants by id, name and category."""
    first = merchant_analytics.orderBy("merchant_id", "merchant_name", "merchant_category").limit(rows)
    return first.select(*C.SAMPLE_MERCHANTS)


def sample_months(monthly_trends: DataFrame, rows: int = 12) -> DataFrame:
    return monthly_trends.select(*C.SAMPLE_MONTHS).orderBy("transaction_month").limit(rows)
