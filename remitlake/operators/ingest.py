"""Bronze: rows as received, plus where and when they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BRONZE_METADATA = ("ingestion_timestamp", "source_file", "pipeline_layer")


def actual_file() -> Column:
    """For ``with_ingestion_metadata``: the file each row was read from, when one path covers many files."""
    return F.col("_metadata.file_path")


def with_ingestion_metadata(df: DataFrame, source_file: str | Column) -> DataFrame:
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        source.alias("source_file"),
        F.lit("bronze").alias("pipeline_layer"),
    )
