"""The same rows in any order and any partitioning give the same tables."""

import pytest

from remitlake.operators import cleaning
from remitlake.plans.layers import gold_tables
from remitlake.sources.sample_tables import raw_transactions


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    cached = raw_transactions(spark, sf_dir).cache()
    yield cached
    cached.unpersist()


def tables(raw):
    silver = cleaning.to_silver(raw).drop("silver_processed_timestamp")
    found = {"silver": silver, **gold_tables(silver)}
    return {name: sorted(map(repr, t.collect())) for name, t in found.items()}


@pytest.fixture(scope="module")
def expected(raw):
    return tables(raw)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_same_tables(spark, raw, expected, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shuffled = raw.repartition(partitions + 2, "merchant_name").sortWithinPartitions("customer_location", "amount")
        assert tables(shuffled) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
