"""Gold: one row per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import labels, money

_CUSTOMER = "customer_id"


def customer_core(silver: DataFrame) -> DataFrame:
    """Counts, amounts and activity span per customer."""
    sums = silver.groupBy(_CUSTOMER).agg(*core_sums(), _merchants_used(), _active_months())
    return finished_core(sums)


def customer_core_by_key(silver: DataFrame) -> DataFrame:
    """The same for rows that are stored by customer: two distinct counts in one grouping would deal the rows out anew."""
    sums = silver.groupBy(_CUSTOMER).agg(*core_sums(), _merchants_used())
    return finished_core(sums.join(silver.groupBy(_CUSTOMER).agg(_active_months()), _CUSTOMER))


def core_sums() -> list[Column]:
    """Aggregates that add up over parts of silver."""
    return [
        F.count("transaction_id").alias("total_transactions"),
        money.total(F.col("amount")).alias("_total"),
        F.count("amount").alias("_amounts"),
        F.max("amount").alias("_max"),
        F.min("amount").alias("_min"),
        F.count_if(labels.flagged()).alias("flagged_transaction_count"),
        F.count_if(labels.equals("status", "completed")).alias("completed_transactions"),
        F.count_if(labels.equals("status", "failed")).alias("failed_transactions"),
        F.max("transaction_timestamp").alias("last_transaction_date"),
        F.min("transaction_timestamp").alias("first_transaction_date"),
    ]


def _merchants_used() -> Column:
    return F.count_distinct("merchant_id").alias("unique_merchants_used")


def _active_months() -> Column:
    return F.count_distinct("transaction_month").alias("active_months")


def finished_core(sums: DataFrame) -> DataFrame:
    """The core from exact sums per customer."""
    return sums.select(
        _CUSTOMER,
        "total_transactions",
        money.as_amount(F.col("_total")).alias("total_spend"),
        money.mean_of(F.col("_total"), F.col("_amounts")).alias("avg_transaction_value"),
        F.round("_max", 2).alias("max_transaction_value"),
        F.round("_min", 2).alias("min_transaction_value"),
        "unique_merchants_used",
        "active_months",
        "flagged_transaction_count",
        "completed_transactions",
        "failed_transactions",
        "last_transaction_date",
        "first_transaction_date",
    )


def value_counts(silver: DataFrame, column: str) -> DataFrame:
    """Rows per customer and value of a column; null is a value."""
    return silver.groupBy(_CUSTOMER, column).agg(F.count(F.lit(1)).alias("n"))


def preferred_value(silver: DataFrame, column: str, alias: str) -> DataFrame:
    """Each customer's most frequent value; ties go to the smallest, null last."""
    return value_counts(silver, column).groupBy(_CUSTOMER).agg(_most_frequent(column).alias(alias))


def preferences(silver: DataFrame) -> DataFrame:
    """Preferred channel and category from one pass: both columns are counted as (facet, value) rows."""
    return preferred(facet_counts(silver, _CUSTOMER))


def facet_counts(silver: DataFrame, *by: str) -> DataFrame:
    """Rows per group and value of either facet."""
    values = silver.unpivot(list(by), ["channel", "merchant_category"], "facet", "value")
    return values.groupBy(*by, "facet", "value").agg(F.count(F.lit(1)).alias("n"))


def preferred(counts: DataFrame) -> DataFrame:
    """Each customer's favourites from counts(customer_id, facet, value, n)."""
    return counts.groupBy(_CUSTOMER).agg(
        _most_frequent("value", F.col("facet") == "channel").alias("preferred_channel"),
        _most_frequent("value", F.col("facet") == "merchant_category").alias("preferred_category"),
    )


def _most_frequent(value: str, where: Column | None = None) -> Column:
    # The smallest (-n, is null, value). Being a plain min, it is partly computed before the shuffle.
    entry = F.struct(-F.col("n"), F.col(value).isNull(), F.col(value).alias("value"))
    return F.min(entry if where is None else F.when(where, entry))["value"]


def fraud_score(core: DataFrame) -> DataFrame:
    score = labels.percent_of(F.col("flagged_transaction_count"), F.col("total_transactions"))
    return core.withColumn("fraud_risk_score", score)


def segment(core: DataFrame) -> DataFrame:
    return core.withColumn("customer_segment", labels.segment_of(F.col("total_spend")))


def summarised(core: DataFrame, favourites: DataFrame) -> DataFrame:
    return core.join(favourites, _CUSTOMER, "left").transform(fraud_score).transform(segment)


def customer_summary(silver: DataFrame) -> DataFrame:
    return summarised(customer_core(silver), preferences(silver))


def customer_summary_by_key(silver: DataFrame) -> DataFrame:
    """The same for rows that are stored by customer: no rows are dealt out anew."""
    return summarised(customer_core_by_key(silver), preferences_by_key(silver))


def preferences_by_key(silver: DataFrame) -> DataFrame:
    """Both favourites from a pass each: (facet, value) rows would not be known to be stored by customer."""
    channel = preferred_value(silver, "channel", "preferred_channel")
    return channel.join(preferred_value(silver, "merchant_category", "preferred_category"), _CUSTOMER)
