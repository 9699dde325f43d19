"""Hand-made transactions."""

from __future__ import annotations

from remitlake.contract import RAW_SCHEMA

BASE = {
    "transaction_id": "T1",
    "customer_id": "ann",
    "merchant_id": "kiosk-9",
    "merchant_name": "Harbour Kiosk",
    "merchant_category": "Dining",
    "amount": 8.4,
    "currency": "EUR",
    "channel": "mobile",
    "status": "completed",
    "transaction_date": "2024-02-29",
    "transaction_time": "23:59:58",
    "customer_location": "Ghent",
    "is_flagged": False,
}

SILVER_DDL = (
    "transaction_id string, customer_id string, merchant_id string, merchant_name string, merchant_category string, "
    "amount double, currency string, channel string, status string, is_flagged boolean, "
    "transaction_timestamp string, transaction_month string"
)


def raw(spark, *changes):
    """One row per dict of changes to BASE; ids T1, T2, ... unless given."""
    rows = [{**BASE, "transaction_id": f"T{i}", **change} for i, change in enumerate(changes, 1)]
    return spark.createDataFrame([tuple(r[c] for c in RAW_SCHEMA.names) for r in rows], RAW_SCHEMA)


def silver(spark, *changes):
    """Rows as the gold builders need them, with timestamps as text, which they accept too."""
    names = [part.split()[0] for part in SILVER_DDL.split(",")]
    rows = []
    for i, change in enumerate(changes, 1):
        row = {**BASE, "transaction_id": f"T{i}", **change}
        row.setdefault("transaction_timestamp", f"{row['transaction_date']} {row['transaction_time']}")
        row.setdefault("transaction_month", row["transaction_date"][:7])
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, SILVER_DDL)


def column(df, name, by):
    """{key: value} of one column; ``by`` may be several key columns."""
    keys = [by] if isinstance(by, str) else list(by)
    return {(r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys)): r[name] for r in df.collect()}
