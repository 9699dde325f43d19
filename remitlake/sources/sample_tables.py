"""Raw transactions derived from an order/line-item star schema.

Gives the engine a realistic input of any size: each line item becomes a payment. The faults a payment feed has
(missing ids and categories, values outside a domain, unreadable times, negative amounts, outliers) are placed by
key, so any engine derives the same rows; line items that repeat their key supply conflicting copies, and about one row
in a hundred occurs twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Category by supplier key modulo 9.
CATEGORIES = (
    "Groceries",
    "Transport",
    "Dining",
    "Entertainment",
    "Healthcare",
    "Utilities",
    "Retail",
    "Travel",
    "ATM Withdrawal",
)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # The smaller tables meet first, by whatever join their sizes allow. Line items and orders both grow with the data,
    # so neither is broadcast: they meet in one shuffle by order key, whose skewed keys AQE may split.
    placed = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table("lineitem")
        .hint("merge")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )

    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    fault = part % 50
    outlier = F.col("l_quantity") > 50 - supplier % 5
    decimal_price = price.cast("decimal(18,2)")
    unsigned = F.round(
        F.when(outlier, decimal_price * F.lit("0.50").cast("decimal(2,2)"))
        .otherwise(decimal_price * F.lit("0.01").cast("decimal(2,2)"))
        .cast("decimal(18,4)"),
        2,
    )

    # One hundredth of the rows twice, without a second scan.
    twice = F.when((7 * order + line) % 100 == 42, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = lines.select(
        F.explode(twice).alias("_copy"),
        F.concat(F.lit("TXN-"), order.cast("string"), F.lit("-"), line.cast("string")).alias("transaction_id"),
        F.when(order % 50 != 7, _numbered("CUST-", F.col("o_custkey"), 6)).alias("customer_id"),
        _numbered("MERCH-", supplier, 4).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.when(fault != 3, _pick(CATEGORIES, supplier % 9)).alias("merchant_category"),
        (F.when((order + line) % 200 == 5, -1).otherwise(1) * unsigned).cast("double").alias("amount"),
        F.when(fault == 9, None)
        .when(fault == 10, "XXX")
        .otherwise(_pick(("GBP", "USD", "EUR"), part % 3))
        .alias("currency"),
        F.when(fault == 11, None)
        .when(fault == 12, "INVALID")
        .otherwise(_pick(("online", "in-store", "mobile", "ATM"), line % 4))
        .alias("channel"),
        F.when(fault == 13, "INVALID")
        .when(F.col("o_orderstatus") == "O", "pending")
        .when(F.col("o_orderstatus") == "P", "failed")
        .when(F.col("l_returnflag") == "R", "reversed")
        .otherwise("completed")
        .alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("transaction_date"),
        F.when(part % 100 == 21, None)
        .when(part % 100 == 22, "n/a")
        .otherwise(F.concat_ws(":", *(F.lpad(n.cast("string"), 2, "0") for n in (part % 24, order % 60, supplier % 60))))
        .alias("transaction_time"),
        F.when(fault != 14, F.col("n_name")).alias("customer_location"),
        (F.abs(F.when(outlier, price * 0.5).otherwise(price * 0.01)) > 5000).alias("is_flagged"),
    )
    return rows.drop("_copy")


def _numbered(prefix: str, key: Column, width: int) -> Column:
    """Zero-padded to a width, longer keys whole."""
    text = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))
