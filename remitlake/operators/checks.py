"""Data-quality checks and reconciliation as rows (check_name, expected, actual, passed).

Every check of one table is part of one aggregation over it. Checks that compare tables bring their one-row
aggregates together with a union, so nothing is collected and nothing is cross joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake import contract as C
from remitlake.functions import labels, money
from remitlake.operators.merchants import MERCHANT_KEY


# --- building blocks ---------------------------------------------------------------------------------------------


def _verdict(df: DataFrame) -> DataFrame:
    return df.select(
        "check_name",
        F.col("expected").cast("double").alias("expected"),
        F.col("actual").cast("double").alias("actual"),
        F.col("expected").cast("double").eqNullSafe(F.col("actual").cast("double")).alias("passed"),
    )


def _long(one_row: DataFrame, value: str) -> DataFrame:
    doubles = one_row.select(*(F.col(c).cast("double").alias(c) for c in one_row.columns))
    return doubles.unpivot([], doubles.columns, "check_name", value)


def _none_expected(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """Checks named by their violation: each counts the rows for which its condition holds, and expects none."""
    counted = df.agg(*(F.count_if(condition).alias(name) for name, condition in violations.items()))
    return _verdict(_long(counted, "actual").withColumn("expected", F.lit(0)))


def _matching(expected: Iterable[DataFrame], actual: Iterable[DataFrame]) -> DataFrame:
    """Pair one-row frames by column name: the same name on both sides is one check."""
    sides = [_long(df, "value").withColumn("side", F.lit("expected")) for df in expected]
    sides += [_long(df, "value").withColumn("side", F.lit("actual")) for df in actual]
    paired = _union(sides).groupBy("check_name")
    return _verdict(
        paired.agg(*(F.max(F.when(F.col("side") == s, F.col("value"))).alias(s) for s in ("expected", "actual")))
    )


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _outside(column: str, allowed: Iterable[str]) -> Column:
    return ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))


# --- checks within a table ---------------------------------------------------------------------------------------


def key_uniqueness(silver: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of their key, per table."""
    keyed = (
        ("silver_transaction_id", silver, ("transaction_id",)),
        ("customer_summary_customer_id", gold["customer_summary"], ("customer_id",)),
        ("merchant_analytics_key", gold["merchant_analytics"], MERCHANT_KEY),
        ("monthly_trends_month", gold["monthly_trends"], ("transaction_month",)),
    )

    def repeated(name: str, df: DataFrame, key: tuple[str, ...]) -> DataFrame:
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))

    return _verdict(_union(_long(repeated(*k), "actual") for k in keyed).withColumn("expected", F.lit(0)))


def null_counts(bronze: DataFrame, silver: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    required = (
        ("bronze", bronze, ("ingestion_timestamp",)),
        ("silver", silver, (*C.CRITICAL_COLUMNS, "transaction_timestamp", "transaction_month")),
        ("merchant_analytics", gold["merchant_analytics"], ("merchant_category",)),
    )
    return _union(
        _none_expected(df, {f"{table}_{c}_null": F.col(c).isNull() for c in columns})
        for table, df, columns in required
    )


def domains(bronze: DataFrame, silver: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    segments = [name for name, _ in C.SEGMENT_FLOORS] + [C.BASE_SEGMENT]
    risks = [name for name, _ in C.RISK_FLOORS] + [C.BASE_RISK]
    silver_domains = {c: (*allowed, C.UNKNOWN) for c, allowed in C.DOMAINS.items()} | {"pipeline_layer": ["silver"]}
    expected = (
        ("bronze", bronze, {"pipeline_layer": ["bronze"]}),
        ("silver", silver, silver_domains),
        ("customer_summary", gold["customer_summary"], {"customer_segment": segments}),
        ("merchant_analytics", gold["merchant_analytics"], {"merchant_risk_flag": risks}),
    )
    return _union(
        _none_expected(df, {f"{table}_{c}_outside": _outside(c, allowed) for c, allowed in columns.items()})
        for table, df, columns in expected
    )


def ranges(silver: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    score = F.col("fraud_risk_score")
    best_ranks = gold["merchant_analytics"].groupBy("merchant_category").agg(F.min("rank_in_category").alias("best"))
    return _union(
        (
            _none_expected(silver, {"silver_amount_not_positive": ~F.coalesce(F.col("amount") > 0, F.lit(False))}),
            _none_expected(gold["customer_summary"], {"fraud_risk_score_outside_0_100": ~score.between(0, 100)}),
            _none_expected(best_ranks, {"category_without_rank_1": F.col("best") != 1}),
        )
    )


def business_rules(gold: Mapping[str, DataFrame]) -> DataFrame:
    floors = dict(C.SEGMENT_FLOORS) | dict(C.RISK_FLOORS)
    ratio = F.try_divide(F.col("flagged_transactions"), F.col("total_transactions"))
    return _union(
        (
            _none_expected(
                gold["customer_summary"],
                {
                    "premium_below_floor": labels.equals("customer_segment", "Premium")
                    & (F.col("total_spend") < floors["Premium"])
                },
            ),
            _none_expected(
                gold["merchant_analytics"],
                {
                    "high_risk_at_or_below_floor": labels.equals("merchant_risk_flag", "High Risk")
                    & (ratio <= floors["High Risk"])
                },
            ),
        )
    )


def running_total(months: DataFrame) -> DataFrame:
    """The running total never falls and ends at the total volume."""
    before = F.lag("running_total_volume").over(Window.orderBy("transaction_month"))
    falls = months.select((F.col("running_total_volume") < before).alias("fell"))
    return _union((_none_expected(falls, {"running_total_falls": F.col("fell")}), _final_running_total(months)))


def _final_running_total(months: DataFrame) -> DataFrame:
    name = "final_running_total"
    total = money.as_amount(money.total(F.col("total_volume")))
    last = F.max_by("running_total_volume", "transaction_month")
    return _matching([months.agg(total.alias(name))], [months.agg(last.alias(name))])


def first_month(months: DataFrame) -> DataFrame:
    """Only the first month lacks a predecessor, and every other month is compared with the one right before it."""
    by_month = Window.orderBy("transaction_month")
    seen = months.select(
        "transaction_month",
        "prev_month_volume",
        "mom_volume_growth_pct",
        "mom_transaction_growth_pct",
        F.row_number().over(by_month).alias("position"),
        F.lag("total_volume").over(by_month).alias("before"),
    )
    is_first = F.col("position") == 1
    has_growth = F.col("mom_volume_growth_pct").isNotNull() | F.col("mom_transaction_growth_pct").isNotNull()
    return _none_expected(
        seen,
        {
            "first_month_with_growth": is_first & has_growth,
            "month_without_its_predecessor": ~is_first & ~F.col("prev_month_volume").eqNullSafe(F.col("before")),
        },
    )


# --- checks across tables ----------------------------------------------------------------------------------------


def orphans(bronze: DataFrame, silver: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of a layer that the layer below does not have."""
    links = (
        ("silver_transactions_not_in_bronze", silver, bronze, "transaction_id"),
        ("customers_not_in_silver", gold["customer_summary"], silver, "customer_id"),
        ("merchants_not_in_silver", gold["merchant_analytics"], silver, "merchant_id"),
        ("months_not_in_silver", gold["monthly_trends"], silver, "transaction_month"),
    )

    def orphaned(upper: DataFrame, lower: DataFrame, key: str) -> DataFrame:
        # Distinct on both sides first: a key with very many rows is then one row in the join.
        return upper.select(key).distinct().join(lower.select(key).distinct(), key, "left_anti")

    return _union(
        _none_expected(orphaned(upper, lower, key), {name: F.lit(True)}) for name, upper, lower, key in links
    )


def totals(silver: DataFrame, customers: DataFrame, months: DataFrame) -> DataFrame:
    """Volumes and counts that must survive from silver to gold."""

    def volume(column: str) -> Column:
        return money.as_amount(money.total(F.col(column)))

    in_silver = silver.agg(
        volume("amount").alias("volume_in_months"),
        volume("amount").alias("volume_in_customers"),
        F.count(F.lit(1)).alias("transactions_in_months"),
        F.count_if(labels.flagged()).alias("flagged_in_customers"),
        F.count_if(labels.equals("status", "completed")).alias("completed_in_customers"),
    )
    in_months = months.agg(
        volume("total_volume").alias("volume_in_months"),
        F.sum("total_transactions").alias("transactions_in_months"),
    )
    in_customers = customers.agg(
        volume("total_spend").alias("volume_in_customers"),
        F.sum("flagged_transaction_count").alias("flagged_in_customers"),
        F.sum("completed_transactions").alias("completed_in_customers"),
    )
    return _matching([in_silver], [in_months, in_customers]).unionByName(_final_running_total(months))


def row_accounting(bronze: DataFrame, silver: DataFrame, report: DataFrame) -> DataFrame:
    """The quality report explains every bronze row, and what it calls kept is silver."""
    explained = report.agg(
        F.sum("rows").alias("bronze_rows_explained"),
        F.sum(F.when(F.col("reason") == C.KEPT, F.col("rows"))).alias("rows_kept"),
    )
    return _matching(
        [
            bronze.agg(F.count(F.lit(1)).alias("bronze_rows_explained")),
            silver.agg(F.count(F.lit(1)).alias("rows_kept")),
        ],
        [explained],
    )
