"""Layers as Parquet directories under one base path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from remitlake.operators.packing import packed

MONTH = "transaction_month"
#: Layers are written once and read several times.
CODEC = "zstd"
#: A group of rows is read by one task, however small the splits: of the usual 128 MB it has more rows than a task can sort in memory.
WRITE_OPTIONS = {"compression": CODEC, "parquet.block.size": str(16 << 20)}


@dataclass(frozen=True)
class LayerPaths:
    """<base>/bronze/transactions, <base>/silver/transactions, <base>/gold/<table>."""

    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/transactions"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/transactions"

    def gold(self, table: str) -> str:
        return f"{self.base}/gold/{table}"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the whole directory; returns what was written."""
    df.write.mode("overwrite").options(**WRITE_OPTIONS).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def gathered_by_month(df: DataFrame) -> DataFrame:
    """Bring a month's rows together so that a write makes few files per month.

    A rebalance, unlike a repartition, may be split by AQE: a month that holds a third of the rows is still
    written by many tasks, and small months share one. Rows pass with their texts packed.
    """
    rows, _, unpacked = packed(df, [c for c in df.columns if c != MONTH])
    return unpacked(rows.hint("rebalance", MONTH))


def write_by_month(df: DataFrame, path: str, *, only_months_present: bool = False) -> DataFrame:
    """One directory per month; returns the table as it then is.

    Replaces everything, or with ``only_months_present`` just the months in df.
    """
    mode = "dynamic" if only_months_present else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).options(**WRITE_OPTIONS).partitionBy(MONTH).parquet(path)
    return read_table(df.sparkSession, path, df.schema)
