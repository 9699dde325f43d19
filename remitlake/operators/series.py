"""A time series of any grain: figures per period, change against the period before, running total.

Months are few and their windows may run in one task (``operators.months``). Days, hours or minutes over years are many:
here the values that run over periods are taken by ranges of them (``operators.running``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.functions import labels, money
from remitlake.operators.running import in_ranges, with_previous, with_running_totals

GRAINS = ("year", "month", "day", "hour", "minute", "second")


def period_core(silver: DataFrame, grain: str) -> DataFrame:
    """One row per period that has transactions."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    return (
        silver.groupBy(F.date_trunc(grain, "transaction_timestamp").alias("period"))
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            money.total(F.col("amount")).alias("_total"),
            F.count_if(labels.flagged()).alias("flagged_transactions"),
        )
        .select("period", "total_transactions", money.as_amount(F.col("_total")).alias("total_volume"), "flagged_transactions")
    )


def period_trends(silver: DataFrame, grain: str = "hour") -> DataFrame:
    """Per period: figures, those of the period present before it, changes in percent, the total volume up to it.

    Rows without a time have no period and are left out. No silver, no rows.
    """
    cut = in_ranges(period_core(silver.filter(F.col("transaction_timestamp").isNotNull()), grain), "period")
    figures = {"prev_volume": "total_volume", "prev_transactions": "total_transactions"}
    # Both work on the same ranges and are put side by side by period, which both sides know once.
    before = with_previous(cut, ["period"], figures)
    running = with_running_totals(cut, ["period"], {"_running": "total_volume"}).select("period", "_running")
    return before.join(running, "period").select(
        "period",
        "total_transactions",
        "total_volume",
        "flagged_transactions",
        "prev_volume",
        labels.percent_change(F.col("total_volume"), F.col("prev_volume")).alias("volume_growth_pct"),
        "prev_transactions",
        labels.percent_change(F.col("total_transactions"), F.col("prev_transactions")).alias("transaction_growth_pct"),
        money.as_amount(F.col("_running")).alias("running_total_volume"),
    )
