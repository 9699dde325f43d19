"""A third of all rows on one transaction, customer, merchant and month: results stay whole."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from remitlake.operators import checks, cleaning, merchants
from remitlake.operators.ingest import with_ingestion_metadata
from remitlake.plans.layers import gold_tables, run_silver
from remitlake.sources.layers import LayerPaths, read_table, write_table
from remitlake.sources.sample_tables import raw_transactions


@pytest.fixture(scope="module")
def layers(spark, sf_dir, tmp_path_factory):
    paths = LayerPaths(str(tmp_path_factory.mktemp("skew")))
    raw = raw_transactions(spark, sf_dir)
    hot_payments = raw.withColumns(
        {
            "transaction_id": F.concat(F.lit("hot-"), "transaction_id"),
            "customer_id": F.lit("hot customer"),
            "merchant_id": F.lit("hot merchant"),
            "merchant_name": F.lit("hot"),
            "merchant_category": F.lit("Retail"),
            "transaction_date": F.lit("1999-01-05"),
        }
    )
    copies = raw.withColumn("transaction_id", F.lit("one transaction"))
    write_table(with_ingestion_metadata(raw.union(hot_payments).union(copies), "f"), paths.bronze)
    bronze = read_table(spark, paths.bronze)
    silver, report = run_silver(bronze, paths)
    gold = {n: t.cache() for n, t in gold_tables(silver).items()}
    yield bronze, silver, report, gold
    for table in gold.values():
        table.unpersist()


def test_nothing_is_lost(layers):
    bronze, silver, report, gold = layers
    for result in (
        checks.row_accounting(bronze, silver, report),
        checks.totals(silver, gold["customer_summary"], gold["monthly_trends"]),
        checks.orphans(bronze, silver, gold),
        checks.key_uniqueness(silver, gold),
    ):
        assert result.filter(~F.col("passed")).collect() == []


def test_the_hot_transaction_is_its_smallest_copy(layers):
    bronze, silver, *_ = layers
    copies = bronze.filter("transaction_id = 'one transaction'")
    survivor = cleaning.one_copy_each(copies).first()
    assert survivor.transaction_date == copies.agg(F.min("transaction_date")).first()[0]
    assert silver.filter("transaction_id = 'one transaction'").count() <= 1


def test_ranks_equal_those_of_a_window(layers):
    core = merchants.merchant_core(layers[1])
    by_window = F.rank().over(Window.partitionBy("merchant_category").orderBy(F.desc("total_revenue")))
    expected = core.withColumn("rank_in_category", by_window)
    assert sorted(merchants.rank_in_category(core).collect()) == sorted(expected.collect())
