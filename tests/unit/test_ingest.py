from pyspark.sql import types as T

from remitlake.contract import RAW_COLUMNS, RAW_SCHEMA
from remitlake.operators.ingest import with_ingestion_metadata
from rows import raw


def test_metadata_is_added_and_rows_kept(spark):
    df = raw(spark, {}, {}, {})
    bronze = with_ingestion_metadata(df, "landing/file.csv")
    assert bronze.columns == [*RAW_COLUMNS, "ingestion_timestamp", "source_file", "pipeline_layer"]
    assert bronze.count() == 3
    assert bronze.select("source_file", "pipeline_layer").distinct().collect() == [("landing/file.csv", "bronze")]
    assert bronze.filter("ingestion_timestamp is null").isEmpty()


def test_schema_is_thirteen_nullable_columns(spark):
    assert len(RAW_SCHEMA) == 13
    assert all(f.nullable for f in RAW_SCHEMA)
    assert RAW_SCHEMA["amount"].dataType == T.DoubleType()
    assert RAW_SCHEMA["is_flagged"].dataType == T.BooleanType()
