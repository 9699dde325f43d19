import math
import random

import pytest
from pyspark.sql import functions as F

from remitlake import contract as C
from remitlake.operators import cleaning
from remitlake.operators.ingest import with_ingestion_metadata
from rows import column, raw


def one_fault_after_another(spark):
    """For every rule several ways to break it, and rows that only look as if they did."""
    return raw(
        spark,
        *({"transaction_id": "thrice", "customer_location": place} for place in ("Lille", "Ghent", "Lille")),
        *({"transaction_id": f"lacks {c}", c: None} for c in C.CRITICAL_COLUMNS if c != "transaction_id"),
        {"transaction_id": "free", "amount": 0.0},
        {"transaction_id": "refund", "amount": -120.75},
        {"transaction_id": "tiny", "amount": 1e-9},
        {"transaction_id": "huge", "amount": 4e19},
        {"transaction_id": "odd money", "currency": "doubloon"},
        {"transaction_id": "odd shop", "merchant_name": None, "channel": "", "is_flagged": None},
    )


def test_each_step_takes_away_its_own_rows(spark):
    ids = lambda df: {r.transaction_id for r in df.collect()}
    one = cleaning.one_copy_each(one_fault_after_another(spark))
    assert one.count() == len(ids(one)) == 11
    assert one.columns == one_fault_after_another(spark).columns
    required = cleaning.require_columns(one)
    assert ids(one) - ids(required) == {"lacks customer_id", "lacks merchant_id", "lacks amount", "lacks transaction_date"}
    positive = cleaning.require_valid_amount(required)
    assert ids(required) - ids(positive) == {"free", "refund"}
    assert ids(cleaning.to_silver(one_fault_after_another(spark))) == {"thrice", "tiny", "huge", "odd money", "odd shop"}


def test_the_earliest_copy_survives_however_rows_are_spread(spark):
    copies = [{"transaction_id": "T", "transaction_date": f"2025-06-{d:02d}", "amount": float(d)} for d in range(1, 29)]
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(copies)
        for parts in (1, 4, 17):
            kept = cleaning.one_copy_each(raw(spark, *copies).repartition(parts)).collect()
            assert [r.amount for r in kept] == [1.0]


def test_null_sorts_first_and_null_ids_are_one_key(spark):
    df = raw(
        spark,
        {"transaction_id": "T", "transaction_time": "01:00:00"},
        {"transaction_id": "T", "transaction_time": None},
        {"transaction_id": None, "merchant_id": "M2"},
        {"transaction_id": None, "merchant_id": "M1"},
    )
    kept = column(cleaning.one_copy_each(df), "transaction_time", "transaction_id")
    assert kept == {"T": None, None: "23:59:58"}
    assert column(cleaning.one_copy_each(df), "merchant_id", "transaction_id")[None] == "M1"


def test_copies_that_differ_only_outside_the_order_still_resolve(spark):
    df = raw(spark, {"transaction_id": "T"}, {"transaction_id": "T"}).withColumn(
        "source_file", F.when(F.rand(3) < 2, F.concat(F.lit("f"), F.monotonically_increasing_id().cast("string")))
    )
    smallest = df.agg(F.min("source_file")).first()[0]
    assert cleaning.one_copy_each(df).first().source_file == smallest


def test_a_bad_copy_that_sorts_first_rejects_the_transaction(spark):
    df = raw(
        spark,
        {"transaction_id": "T", "transaction_date": "2025-06-01", "amount": -1.0},
        {"transaction_id": "T", "transaction_date": "2025-06-02", "amount": 1.0},
    )
    assert cleaning.to_silver(df).isEmpty()


@pytest.mark.parametrize("missing", C.CRITICAL_COLUMNS)
def test_each_critical_column_is_required(spark, missing):
    assert cleaning.require_columns(raw(spark, {missing: None}, {})).count() == 1


def test_other_nulls_stay(spark):
    other = {c: None for c in ("merchant_name", "merchant_category", "customer_location", "is_flagged")}
    assert cleaning.to_silver(raw(spark, other)).count() == 1


@pytest.mark.parametrize(
    "amount, valid",
    [(0.01, True), (9e15, True), (0.0, False), (-0.0, False), (-5.0, False), (None, False)]
    + [(math.nan, False), (math.inf, False), (-math.inf, False), (1e16, True), (2e20, True), (5e-324, True)],
)
def test_valid_amounts(spark, amount, valid):
    assert (cleaning.require_valid_amount(raw(spark, {"amount": amount})).count() == 1) is valid


def test_values_outside_a_domain_and_nulls_become_unknown(spark):
    df = cleaning.standardise_domains(
        raw(
            spark,
            {"currency": "JPY", "channel": "Online", "status": " completed"},
            {"currency": None, "channel": None, "status": None},
            {"currency": "EUR", "channel": "ATM", "status": "reversed"},
        )
    )
    assert column(df, "currency", "transaction_id") == {"T1": "unknown", "T2": "unknown", "T3": "EUR"}
    assert column(df, "channel", "transaction_id") == {"T1": "unknown", "T2": "unknown", "T3": "ATM"}
    assert column(df, "status", "transaction_id") == {"T1": "unknown", "T2": "unknown", "T3": "reversed"}


def test_time_month_and_day_of_week(spark):
    row = cleaning.with_transaction_time(raw(spark, {})).first()
    assert str(row.transaction_timestamp) == "2024-02-29 23:59:58"
    assert row.transaction_month == "2024-02"
    assert row.day_of_week == 5  # a Thursday


BAD_TIMES = [
    {"transaction_time": None},
    {"transaction_time": "n/a"},
    {"transaction_date": "01/06/2025"},
    {"transaction_date": "2025-02-30"},
    {"transaction_time": "25:00:00"},
]


@pytest.mark.parametrize("bad", BAD_TIMES)
def test_unreadable_times_are_rejected_or_fail(spark, bad):
    df = raw(spark, bad, {})
    assert [r.transaction_id for r in cleaning.to_silver(df).collect()] == ["T2"]
    with pytest.raises(Exception, match="unreadable transaction time"):
        cleaning.to_silver(df, on_bad_timestamp="fail").collect()


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        cleaning.to_silver(raw(spark, {}), on_bad_timestamp="guess")


def test_silver_metadata_replaces_the_layer(spark):
    silver = cleaning.to_silver(with_ingestion_metadata(raw(spark, {}), "f.csv"))
    assert len(silver.columns) == 20
    row = silver.first()
    assert row.pipeline_layer == "silver"
    assert row.silver_processed_timestamp is not None


def faults(spark):
    return raw(
        spark,
        {"transaction_id": "A"},
        {"transaction_id": "A"},
        {"transaction_id": "A", "amount": -1.0},  # the copy that survives
        {"transaction_id": "B", "customer_id": None, "amount": -1.0, "transaction_time": None},
        {"transaction_id": "C", "amount": 0.0, "transaction_time": None},
        {"transaction_id": "D", "transaction_time": "n/a"},
        {"transaction_id": "E"},
    )


def test_quality_report_charges_each_row_to_its_first_rule(spark):
    report = column(cleaning.quality_report(faults(spark)), "rows", "reason")
    assert report == {"duplicate": 2, "critical_null": 1, "invalid_amount": 2, "bad_timestamp": 1, "kept": 1}
    assert sum(report.values()) == 7


def test_quality_report_of_nothing(spark):
    report = column(cleaning.quality_report(raw(spark, {}).limit(0)), "rows", "reason")
    assert set(report.values()) == {0} and len(report) == 5


def test_kept_rows_are_silver(spark):
    kept = cleaning.with_fate(faults(spark)).filter(F.col("fate") == C.KEPT)
    assert [r.transaction_id for r in kept.collect()] == [
        r.transaction_id for r in cleaning.to_silver(faults(spark)).collect()
    ]
