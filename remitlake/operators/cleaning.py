"""Silver: one valid, standardised row per transaction.

The order of the steps matters. Copies are resolved first, so when the surviving copy is bad the transaction is
rejected even though a good copy existed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake import contract as C
from remitlake.functions import labels
from remitlake.operators.packing import packed


def one_copy_each(df: DataFrame, key: str = "transaction_id", order: Iterable[str] = C.COPY_ORDER, *, pack: bool = False) -> DataFrame:
    """Keep the smallest copy per key (by ``order``, nulls first, then by the other columns).

    Catalyst turns "row number 1" into a group limit before the shuffle as well: each task sends at most one row per
    key, so a key with very many copies does not pile up anywhere. ``pack`` sorts and shuffles rows with their texts
    packed, for steps that filter by none of these afterwards: such a filter would unpack them once more.
    """
    first = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in first]
    rows, by, unpacked = packed(df, first + rest) if pack else (df, first + rest, lambda rows: rows)
    place = Window.partitionBy(key).orderBy(*(F.asc_nulls_first(c) for c in by))
    return rows.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") == 1).drop("_place").transform(unpacked)


def require_columns(df: DataFrame, columns: Iterable[str] = C.CRITICAL_COLUMNS) -> DataFrame:
    return df.filter(labels.has_all(columns))


def require_valid_amount(df: DataFrame) -> DataFrame:
    return df.filter(labels.is_valid_amount())


def standardise_domains(df: DataFrame, domains: Mapping[str, Iterable[str]] = C.DOMAINS) -> DataFrame:
    return df.withColumns({c: labels.in_domain_or_unknown(c, allowed) for c, allowed in domains.items()})


def with_transaction_time(df: DataFrame) -> DataFrame:
    """Timestamp, month and day of week (1 = Sunday); null where date and time cannot be read."""
    timed = df.withColumn("transaction_timestamp", labels.parsed_timestamp(labels.date_time_text()))
    return timed.withColumns(
        {
            "transaction_month": F.date_format("transaction_timestamp", C.MONTH_PATTERN),
            "day_of_week": F.dayofweek("transaction_timestamp"),
        }
    )


def require_transaction_time(df: DataFrame, on_bad_timestamp: str = "reject") -> DataFrame:
    """Drop rows whose time could not be read, or ``fail`` the job at the first one."""
    if on_bad_timestamp == "reject":
        return df.filter(F.col("transaction_timestamp").isNotNull())
    if on_bad_timestamp != "fail":
        raise ValueError(f"on_bad_timestamp must be 'reject' or 'fail', not {on_bad_timestamp!r}")
    stop = F.raise_error(F.concat(F.lit("unreadable transaction time: "), labels.date_time_text()))
    checked = F.when(F.col("transaction_timestamp").isNull(), stop.cast("timestamp")).otherwise(
        F.col("transaction_timestamp")
    )
    return df.withColumn("transaction_timestamp", checked)


def with_silver_metadata(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"silver_processed_timestamp": F.current_timestamp(), "pipeline_layer": F.lit("silver")}
    )


def to_silver(bronze: DataFrame, *, on_bad_timestamp: str = "reject") -> DataFrame:
    return (
        bronze.transform(one_copy_each)
        .transform(require_columns)
        .transform(require_valid_amount)
        .transform(standardise_domains)
        .transform(with_transaction_time)
        .transform(require_transaction_time, on_bad_timestamp)
        .transform(with_silver_metadata)
    )


def with_fate(bronze: DataFrame) -> DataFrame:
    """Every transaction once, rejected or not, with the ``fate`` the rules give it.

    Its rows whose fate is KEPT are those of ``to_silver``.
    """
    return bronze.transform(one_copy_each).transform(judged)


def judged(copies: DataFrame) -> DataFrame:
    """The rows of ``one_copy_each`` standardised and timed, with their ``fate``."""
    return copies.transform(standardise_domains).transform(with_transaction_time).withColumn("fate", fate())


def fate() -> Column:
    """The first rule that a timed row fails, or KEPT."""
    return (
        F.when(~labels.has_all(C.CRITICAL_COLUMNS), C.CRITICAL_NULL)
        .when(~labels.is_valid_amount(), C.INVALID_AMOUNT)
        .when(F.col("transaction_timestamp").isNull(), C.BAD_TIMESTAMP)
        .otherwise(C.KEPT)
    )


def with_fate_as_received(copies: DataFrame) -> DataFrame:
    """One copy each, its columns as received, with month and fate; ``kept_as_silver`` makes silver of it."""
    timed = copies.transform(with_transaction_time).withColumn("fate", fate())
    return timed.drop("transaction_timestamp", "day_of_week")


def kept_as_silver(judged: DataFrame) -> DataFrame:
    """Silver from the rows of ``with_fate_as_received``."""
    return judged.filter(F.col("fate") == C.KEPT).drop("fate", "transaction_month").transform(received_as_silver)


def received_as_silver(kept: DataFrame) -> DataFrame:
    """Silver from one copy each, as received, of rows that all are kept."""
    return kept.transform(standardise_domains).transform(with_transaction_time).transform(with_silver_metadata)


FATES = (C.CRITICAL_NULL, C.INVALID_AMOUNT, C.BAD_TIMESTAMP, C.KEPT)


def fate_counts() -> list[Column]:
    """Aggregates over ``with_fate``: transactions per fate."""
    return [F.count_if(F.col("fate") == fate).alias(fate) for fate in FATES]


def quality_report(bronze: DataFrame) -> DataFrame:
    """(reason, rows): what became of the bronze rows, each charged to the first rule it failed.

    Rows that met no fate were duplicates. Bronze is read a second time just to count it, which on Parquet takes no
    column data.
    """
    counts = bronze.select(*C.RAW_COLUMNS).transform(one_copy_each, pack=True).transform(judged).agg(*fate_counts()).unpivot([], list(FATES), "reason", "rows")
    signed = F.when(F.col("reason").isNull(), F.col("rows")).otherwise(-F.col("rows"))
    everything = bronze.agg(F.lit(None).cast("string").alias("reason"), F.count(F.lit(1)).alias("rows"))
    duplicates = everything.unionByName(counts).agg(F.lit(C.DUPLICATE).alias("reason"), F.sum(signed).alias("rows"))
    return duplicates.unionByName(counts)
