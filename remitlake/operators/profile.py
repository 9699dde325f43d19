"""What a table looks like, in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import labels


def row_digest(columns: list[tuple[str, str]]) -> Column:
    """SHA-256 of a row of (name, type) columns: equal rows, and no others, have equal digests.

    Each value is led by its length, a null is a sign of its own; a negative zero counts as zero, as it does in groups.
    """

    def encoded(name: str, kind: str) -> Column:
        value = (F.col(name) + F.lit(0.0) if kind in ("double", "float") else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[encoded(*c) for c in columns]).cast("binary"), 256))


def raw_profile(raw: DataFrame) -> DataFrame:
    """One row: rows, null values over all columns, fully repeated rows, flagged rows.

    Rows meet by a digest of 32 bytes; their columns are not shuffled.
    """
    nulls = reduce(Column.__add__, (F.col(c).isNull().cast("long") for c in raw.columns))
    return (
        raw.select(row_digest(raw.dtypes).alias("digest"), nulls.alias("nulls"), labels.flagged().cast("long").alias("flagged"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("nulls").alias("nulls"), F.sum("flagged").alias("flagged"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
            F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
            F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_transactions"),
        )
    )


def value_domains(silver: DataFrame, columns=("currency", "channel", "status")) -> DataFrame:
    """(column, value, rows): every value the categorical columns take."""
    return (
        silver.unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
