"""Names, types and thresholds every layer agrees on."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

# The layer contract. Changing one changes results.

RAW_SCHEMA = StructType(
    [
        StructField(name, kind())
        for name, kind in (
            ("transaction_id", StringType),
            ("customer_id", StringType),
            ("merchant_id", StringType),
            ("merchant_name", StringType),
            ("merchant_category", StringType),
            ("amount", DoubleType),
            ("currency", StringType),
            ("channel", StringType),
            ("status", StringType),
            ("transaction_date", StringType),
            ("transaction_time", StringType),
            ("customer_location", StringType),
            ("is_flagged", BooleanType),
        )
    ]
)
RAW_COLUMNS = RAW_SCHEMA.names

CURRENCIES = ("GBP", "USD", "EUR")
CHANNELS = ("online", "in-store", "mobile", "ATM")
STATUSES = ("completed", "pending", "failed", "reversed")
UNKNOWN = "unknown"
DOMAINS = {"currency": CURRENCIES, "channel": CHANNELS, "status": STATUSES}

CRITICAL_COLUMNS = ("transaction_id", "customer_id", "merchant_id", "amount", "transaction_date")

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
MONTH_PATTERN = "yyyy-MM"

# A segment applies from this total spend upwards; below the last bound it is BASE_SEGMENT.
SEGMENT_FLOORS = (("Premium", 50000), ("High Value", 20000), ("Mid Tier", 5000))
BASE_SEGMENT = "Standard"

# A risk label applies above this flagged ratio; otherwise it is BASE_RISK.
RISK_FLOORS = (("High Risk", 0.05), ("Medium Risk", 0.02))
BASE_RISK = "Low Risk"

# What the samples of the gold tables show.
SAMPLE_CUSTOMERS = (
    "customer_id",
    "total_transactions",
    "total_spend",
    "customer_segment",
    "fraud_risk_score",
    "preferred_channel",
    "preferred_category",
)
SAMPLE_MERCHANTS = (
    "merchant_name",
    "merchant_category",
    "total_transactions",
    "total_revenue",
    "unique_customers",
    "merchant_risk_flag",
    "rank_in_category",
)
SAMPLE_MONTHS = (
    "transaction_month",
    "total_transactions",
    "total_volume",
    "active_customers",
    "mom_volume_growth_pct",
    "running_total_volume",
)

# Our own choices.

# Which copy of a transaction survives: the smallest by these columns, nulls first.
COPY_ORDER = (
    "transaction_date",
    "transaction_time",
    "merchant_id",
    "merchant_name",
    "customer_id",
    "merchant_category",
    "amount",
    "currency",
    "channel",
    "status",
    "customer_location",
    "is_flagged",
)

# Why a row does not reach silver, in the order the rules are applied.
DUPLICATE = "duplicate"
CRITICAL_NULL = "critical_null"
INVALID_AMOUNT = "invalid_amount"
BAD_TIMESTAMP = "bad_timestamp"
KEPT = "kept"
