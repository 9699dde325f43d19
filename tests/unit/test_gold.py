import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from remitlake.functions import labels, money
from remitlake.operators import customers, merchants, months
from rows import column, silver

FERRY = {"merchant_id": "ferry-2", "merchant_name": "Night Ferry", "merchant_category": "Travel", "channel": "online"}
CLINIC = {"merchant_id": "clinic", "merchant_name": "Clinic", "merchant_category": "Healthcare", "currency": "GBP"}


@pytest.fixture(scope="module")
def spring(spark):
    """Five customers at three merchants over four months of 2024, one of them without any payment in between."""
    return silver(
        spark,
        {"amount": 4.2},
        {"amount": 6.3, "transaction_date": "2024-03-01", "is_flagged": None},
        {**FERRY, "amount": 310.05, "transaction_date": "2024-05-12", "transaction_time": "04:05:06"},
        {"customer_id": "bo", "amount": 9.99, "channel": "ATM", "status": "failed"},
        {**FERRY, "customer_id": "bo", "amount": 24000.0, "transaction_date": "2024-03-15", "is_flagged": True},
        {**CLINIC, "customer_id": "cem", "amount": 71.5, "transaction_date": "2024-03-15", "status": "pending"},
        {**CLINIC, "customer_id": "cem", "amount": 71.5, "transaction_date": "2024-05-15", "status": "reversed"},
        {**CLINIC, "customer_id": "dee", "amount": 0.335, "transaction_date": "2024-05-31", "transaction_time": "00:00:00"},
        {**FERRY, "customer_id": "eli", "amount": 88.0, "transaction_date": "2024-05-31"},
    )


# --- customers ---------------------------------------------------------------------------------------------------


def test_customer_summary(spring):
    df = customers.customer_summary(spring)
    assert df.columns == [
        "customer_id",
        "total_transactions",
        "total_spend",
        "avg_transaction_value",
        "max_transaction_value",
        "min_transaction_value",
        "unique_merchants_used",
        "active_months",
        "flagged_transaction_count",
        "completed_transactions",
        "failed_transactions",
        "last_transaction_date",
        "first_transaction_date",
        "preferred_channel",
        "preferred_category",
        "fraud_risk_score",
        "customer_segment",
    ]
    by_id = {r.customer_id: tuple(r)[1:] for r in df.collect()}
    assert by_id == {
        "ann": (3, 320.55, 106.85, 310.05, 4.2, 2, 3, 0, 3, 0)
        + ("2024-05-12 04:05:06", "2024-02-29 23:59:58", "mobile", "Dining", 0.0, "Standard"),
        "bo": (2, 24009.99, 12005.0, 24000.0, 9.99, 2, 2, 1, 1, 1)
        + ("2024-03-15 23:59:58", "2024-02-29 23:59:58", "ATM", "Dining", 50.0, "High Value"),
        "cem": (2, 143.0, 71.5, 71.5, 71.5, 1, 2, 0, 0, 0)
        + ("2024-05-15 23:59:58", "2024-03-15 23:59:58", "mobile", "Healthcare", 0.0, "Standard"),
        "dee": (1, 0.34, 0.34, 0.34, 0.34, 1, 1, 0, 1, 0)
        + ("2024-05-31 00:00:00", "2024-05-31 00:00:00", "mobile", "Healthcare", 0.0, "Standard"),
        "eli": (1, 88.0, 88.0, 88.0, 88.0, 1, 1, 0, 1, 0)
        + ("2024-05-31 23:59:58", "2024-05-31 23:59:58", "online", "Travel", 0.0, "Standard"),
    }


def test_ties_go_to_the_smallest_value_and_null_last(spark):
    df = silver(
        spark,
        {"channel": "online", "merchant_category": None},
        {"channel": "mobile", "merchant_category": "Travel"},
        {"customer_id": "bo", "merchant_category": None},
        {"customer_id": "bo", "merchant_category": None},
        {"customer_id": "bo", "merchant_category": "Travel"},
    )
    summary = customers.customer_summary(df)
    assert column(summary, "preferred_channel", "customer_id") == {"ann": "mobile", "bo": "mobile"}
    assert column(summary, "preferred_category", "customer_id") == {"ann": "Travel", "bo": None}
    for name, alias in (("channel", "preferred_channel"), ("merchant_category", "preferred_category")):
        alone = customers.preferred_value(df, name, alias)
        assert column(alone, alias, "customer_id") == column(summary, alias, "customer_id")


def test_a_null_customer_has_no_preferences(spark):
    row = customers.customer_summary(silver(spark, {"customer_id": None})).first()
    assert (row.total_transactions, row.preferred_channel, row.preferred_category) == (1, None, None)


def test_value_counts_keep_null(spark):
    df = silver(spark, {}, {}, {"merchant_category": None})
    counts = customers.value_counts(df, "merchant_category")
    assert column(counts, "n", "merchant_category") == {"Dining": 2, None: 1}


@pytest.mark.parametrize(
    "spend, segment",
    [(50000.0, "Premium"), (49999.99, "High Value"), (20000.0, "High Value"), (19999.99, "Mid Tier")]
    + [(5000.0, "Mid Tier"), (4999.99, "Standard"), (49999.995, "Premium")],
)
def test_segment_bounds_are_inclusive_on_the_rounded_total(spark, spend, segment):
    assert customers.customer_summary(silver(spark, {"amount": spend})).first().customer_segment == segment


def test_flags_may_be_null(spark):
    row = customers.customer_summary(silver(spark, {"is_flagged": None}, {"is_flagged": True})).first()
    assert (row.flagged_transaction_count, row.fraud_risk_score) == (1, 50.0)


# --- merchants ---------------------------------------------------------------------------------------------------


def test_merchant_analytics(spring):
    df = merchants.merchant_analytics(spring)
    assert df.columns == [
        "merchant_id",
        "merchant_name",
        "merchant_category",
        "total_transactions",
        "total_revenue",
        "avg_transaction_value",
        "unique_customers",
        "flagged_transactions",
        "completed_transactions",
        "gbp_transactions",
        "online_transactions",
        "rank_in_category",
        "merchant_risk_flag",
    ]
    assert {tuple(r) for r in df.collect()} == {
        ("kiosk-9", "Harbour Kiosk", "Dining", 3, 20.49, 6.83, 2, 0, 2, 0, 0, 1, "Low Risk"),
        ("ferry-2", "Night Ferry", "Travel", 3, 24398.05, 8132.68, 3, 1, 3, 0, 3, 1, "High Risk"),
        ("clinic", "Clinic", "Healthcare", 3, 143.34, 47.78, 2, 0, 1, 3, 0, 1, "Low Risk"),
    }


def test_a_merchant_with_two_names_is_two_rows_and_no_category_is_none(spark):
    df = silver(spark, {}, {"merchant_name": "Renamed"}, {"merchant_category": None})
    rows = merchants.merchant_analytics(df)
    assert column(rows, "rank_in_category", "merchant_name") == {"Harbour Kiosk": 1, "Renamed": 1}


@pytest.mark.parametrize(
    "flagged, total, risk",
    [(1, 20, "Medium Risk"), (2, 39, "High Risk"), (1, 50, "Low Risk"), (1, 49, "Medium Risk"), (0, 1, "Low Risk")],
)
def test_risk_bounds_are_exclusive_on_the_exact_ratio(spark, flagged, total, risk):
    df = silver(spark, *({"is_flagged": i < flagged} for i in range(total)))
    assert merchants.risk_flag(merchants.merchant_core(df)).first().merchant_risk_flag == risk


# --- months ------------------------------------------------------------------------------------------------------


def test_monthly_trends(spring):
    df = months.monthly_trends(spring)
    assert df.columns == [
        "transaction_month",
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
    ]
    assert [tuple(r) for r in df.collect()] == [
        ("2024-02", 2, 14.19, 7.1, 2, 1, 0, 1, None, None, None, None, 14.19),
        ("2024-03", 3, 24077.8, 8025.93, 3, 3, 1, 0, 14.19, 169581.47, 2, 50.0, 24091.99),
        ("2024-05", 4, 469.89, 117.47, 4, 2, 0, 0, 24077.8, -98.05, 3, 33.33, 24561.88),
    ]


def test_a_missing_month_is_not_filled_in(spark):
    df = months.monthly_trends(
        silver(spark, {"transaction_date": "2025-01-01"}, {"transaction_date": "2025-04-01", "amount": 12.6})
    )
    assert [(r.transaction_month, r.mom_volume_growth_pct) for r in df.collect()] == [
        ("2025-01", None),
        ("2025-04", 50.0),
    ]


def test_growth_from_a_month_that_rounds_to_nothing_is_null(spark):
    df = months.monthly_trends(
        silver(spark, {"transaction_date": "2025-01-01", "amount": 0.001}, {"transaction_date": "2025-02-01"})
    )
    assert [r.mom_volume_growth_pct for r in df.collect()] == [None, None]


# --- money -------------------------------------------------------------------------------------------------------


def half_up(x: Decimal) -> float:
    return float(x.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_sums_and_means_are_exact(spark):
    rng = random.Random(5)
    cases = [round(rng.uniform(0.01, 90000), rng.choice([0, 1, 2, 2, 2, 3, 5])) for _ in range(4000)]
    cases += [0.005, 0.015, 1.005, 2.675, 1.115, 9e15, 123456789012.34]
    groups = defaultdict(list)
    for i, amount in enumerate(cases):
        groups[i % 37].append(amount)
    df = spark.createDataFrame([(g, a) for g, v in groups.items() for a in v], "g int, amount double")
    total = money.total(F.col("amount"))
    got = df.groupBy("g").agg(
        money.as_amount(total).alias("total"), money.mean_of(total, F.count("amount")).alias("mean")
    )
    for row in got.collect():
        exact = [Decimal(repr(a)) for a in groups[row.g]]
        assert row.total == half_up(sum(exact)), row
        assert row.mean == half_up(sum(exact) / len(exact)), row


def test_fractions_of_a_cent_are_not_rounded_before_adding(spark):
    df = spark.createDataFrame([(10.125,), (10.125,)], "amount double")
    assert df.agg(money.as_amount(money.total(F.col("amount")))).first()[0] == 20.25


def test_amounts_far_below_a_cent_add_up(spark):
    assert spark.range(100_000).select(F.lit(4e-7).alias("a")).agg(money.as_amount(money.total(F.col("a")))).first()[0] == 0.04


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_totals_are_exact_and_too_large_ones_fail(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        trends = months.monthly_trends(
            silver(
                spark,
                {"amount": 9e15, "transaction_date": "2025-01-01"},
                {"amount": 9e15, "transaction_date": "2025-01-02"},
                {"amount": 1e16, "transaction_date": "2025-02-01"},
                {"amount": 2e20, "transaction_date": "2025-03-01"},
                {"amount": 10.0, "transaction_date": "2025-04-01"},
            )
        ).collect()
        assert [r.total_volume for r in trends] == [1.8e16, 1e16, 2e20, 10.0]
        assert [r.avg_transaction_value for r in trends] == [9e15, 1e16, 2e20, 10.0]
        assert [r.running_total_volume for r in trends] == [1.8e16, 2.8e16, 200028e15, 200028e15 + 10]
        for amounts in ([1e28], [9e27, 9e27]):
            df = spark.createDataFrame([(a,) for a in amounts], "a double")
            with pytest.raises(Exception):
                df.agg(money.total(F.col("a"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_mean_of_no_rows_is_null_and_of_negative_rounds_away_from_zero(spark):
    one = spark.range(1)
    mean = lambda total, n: one.select(money.mean_of(F.lit(total).cast("decimal(38,10)"), F.lit(n).cast("bigint"))).first()[0]
    assert mean("1.00", 0) is None
    assert mean("-0.01", 2) == -0.01
    assert mean("0.01", 2) == 0.01


def test_percentages_do_not_divide_by_zero(spark):
    one = spark.range(1)
    assert one.select(labels.percent_of(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(labels.percent_change(F.lit(1.0), F.lit(0.0))).first()[0] is None


# --- against plain Python ----------------------------------------------------------------------------------------


def test_customers_and_months_against_brute_force(spark):
    rng = random.Random(11)
    rows = [
        {
            "customer_id": "hot" if rng.random() < 0.4 else f"C{rng.randrange(30)}",
            "merchant_id": f"M{rng.randrange(12)}",
            "merchant_category": rng.choice(["Dining", "Travel", "Retail", None]),
            "channel": rng.choice(["online", "mobile", "ATM", "unknown"]),
            "status": rng.choice(["completed", "failed", "pending"]),
            "amount": round(rng.uniform(1, 9000), 2),
            "transaction_date": f"2025-{rng.randrange(1, 10):02d}-{rng.randrange(1, 28):02d}",
        }
        for _ in range(3000)
    ]
    df = silver(spark, *rows)
    summary = {r.customer_id: r for r in customers.customer_summary(df).collect()}
    grouped = defaultdict(list)
    for r in rows:
        grouped[r["customer_id"]].append(r)
    assert summary.keys() == grouped.keys()

    def favourite(values):
        return min(Counter(values).items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[0]

    for customer, mine in grouped.items():
        got = summary[customer]
        assert got.total_transactions == len(mine)
        assert got.total_spend == half_up(sum(Decimal(repr(r["amount"])) for r in mine))
        assert got.unique_merchants_used == len({r["merchant_id"] for r in mine})
        assert got.active_months == len({r["transaction_date"][:7] for r in mine})
        assert got.completed_transactions == sum(r["status"] == "completed" for r in mine)
        assert got.preferred_channel == favourite(r["channel"] for r in mine)
        assert got.preferred_category == favourite(r["merchant_category"] for r in mine)

    for got in months.monthly_trends(df).collect():
        mine = [r for r in rows if r["transaction_date"].startswith(got.transaction_month)]
        until = [r for r in rows if r["transaction_date"][:7] <= got.transaction_month]
        assert got.active_customers == len({r["customer_id"] for r in mine})
        assert got.active_merchants == len({r["merchant_id"] for r in mine})
        assert got.running_total_volume == half_up(sum(Decimal(repr(r["amount"])) for r in until))
