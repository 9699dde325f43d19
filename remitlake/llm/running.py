"""Running sums over a whole table in a given order, no task of which sees more than its slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.sources.shared import stored

_BEFORE = (Window.unboundedPreceding, -1)


def with_running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Add, for each ``new: column`` of ``sums``, the sum of that column over all rows before this one.

    Rows are cut into ranges of the order and stored, so the ranges stay what they are when an executor is lost. Each
    range is summed on its own; the totals of the ranges, one row for each, give what to add. The order should leave
    no ties but between rows that are alike: rows that tie are all in one range.
    """
    cut = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    across = Window.orderBy("_range").rowsBetween(*_BEFORE)
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(*_BEFORE)
    totals = (
        cut.groupBy("_range")
        .agg(*[F.sum(c).alias(f"_{new}") for new, c in sums.items()])
        .select("_range", *[F.coalesce(F.sum(f"_{new}").over(across), F.lit(0)).alias(f"_{new}") for new in sums])
    )
    inside = cut.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(new) for new, c in sums.items()])
    return inside.join(totals, "_range").select(
        *df.columns, *[(F.col(new) + F.col(f"_{new}")).cast("long").alias(new) for new in sums]
    )
