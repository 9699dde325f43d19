"""What the plans must look like to hold at scale."""

import re

import pytest

from remitlake.contract import RAW_COLUMNS
from remitlake.operators import checks, cleaning, customers, merchants, months, profile, series
from remitlake.operators.ingest import with_ingestion_metadata
from remitlake.plans import registry
from remitlake.plans.layers import gold_tables
from remitlake.sources.clustered import read_clustered, write_clustered
from remitlake.sources.layers import LayerPaths, gathered_by_month, read_table, write_by_month, write_table
from remitlake.sources.sample_tables import raw_transactions


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scanned(text):
    """Column sets of the Parquet scans."""
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    paths = LayerPaths(str(tmp_path_factory.mktemp("plans")))
    write_table(with_ingestion_metadata(raw_transactions(spark, sf_dir), "f"), paths.bronze)
    bronze = read_table(spark, paths.bronze)
    write_by_month(cleaning.to_silver(bronze), paths.silver)
    return bronze, read_table(spark, paths.silver)


def test_copies_are_reduced_before_the_shuffle(stored):
    text = plan(cleaning.to_silver(stored[0]))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(transaction_id)]" in text


def test_silver_is_written_after_a_rebalance(stored):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(gathered_by_month(stored[1]))


def test_a_month_reads_one_directory(stored):
    silver = stored[1].filter("transaction_month = '1998-06'")
    assert "PartitionFilters: [isnotnull(transaction_month" in plan(silver)
    assert silver.select("_metadata.file_path").distinct().count() == 1


def test_gold_reads_only_its_columns(stored):
    silver = stored[1]
    assert scanned(plan(months.monthly_core(silver))) == [
        {"transaction_id", "customer_id", "merchant_id", "amount", "status", "is_flagged"}
    ]
    assert scanned(plan(customers.preferences(silver))) == [{"customer_id", "merchant_category", "channel"}]
    text = plan(merchants.merchant_core(silver))
    assert "PushedFilters: [IsNotNull(merchant_category)]" in text
    assert all("transaction_timestamp" not in s for s in scanned(text))


def test_hot_keys_are_spread_over_their_distinct_values_first(stored):
    silver = stored[1]
    exchanges = [
        re.findall(r"Arguments: hashpartitioning\((.*?), \d+\)", plan(df))
        for df in (merchants.merchant_core(silver), customers.customer_core(silver), months.monthly_core(silver))
    ]
    for found, spread_by in zip(exchanges, ("customer_id", "merchant_id", "customer_id")):
        assert len(found) == 2 and any(spread_by in keys and "," in keys for keys in found)


@pytest.mark.parametrize("name, scans", [("customer_summary", 2), ("merchant_analytics", 3)])
def test_gold_starts_from_stored_silver(spark, sf_dir, name, scans):
    """Parquet with pruned columns; copies are resolved before, not again for each side of a join."""
    df = registry.queries()[name](spark, sf_dir)
    text = plan(df)
    assert 1 <= len(scanned(text)) <= scans and all("transaction_date" not in s and "customer_location" not in s for s in scanned(text))
    assert "WindowGroupLimit" not in text


def test_counting_bronze_reads_no_column(stored):
    assert "ReadSchema: struct<>" in plan(stored[0].groupBy().count())


def test_single_task_windows_see_only_aggregated_months(stored):
    tree = plan(months.monthly_trends(stored[1])).split("\n\n")[0]
    single, aggregates = tree.index("Window"), tree.index("HashAggregate")
    assert single < aggregates  # printed top down: the windows run last
    assert "Window" not in tree[aggregates:]
    assert "rangepartitioning" not in tree  # the windows already leave the months in order


def test_no_cross_joins_and_no_python(spark, sf_dir, stored):
    bronze, silver = stored
    gold = gold_tables(silver)
    frames = [
        raw_transactions(spark, sf_dir),
        cleaning.quality_report(bronze),
        *gold.values(),
        checks.orphans(bronze, silver, gold),
        checks.totals(silver, gold["customer_summary"], gold["monthly_trends"]),
        checks.domains(bronze, silver, gold),
        registry.queries()["monthly_trends"](spark, sf_dir),
    ]
    for df in frames:
        text = plan(df)
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert node not in text


def test_line_items_and_orders_are_not_broadcast(spark, sf_dir):
    text = plan(raw_transactions(spark, sf_dir))
    assert "SortMergeJoin Inner" in text


def test_rows_stored_by_a_key_are_grouped_by_it_without_an_exchange(spark, stored, tmp_path):
    silver = stored[1]
    by_customer = write_clustered(silver, str(tmp_path / "by_customer"), "customer_id", 4)
    by_merchant = write_clustered(silver, str(tmp_path / "by_merchant"), "merchant_id", 4)
    for df in (customers.customer_core_by_key(by_customer), customers.preferences_by_key(by_customer), merchants.merchant_core(by_merchant)):
        assert "hashpartitioning" not in plan(df)  # small results may still be sent to a join
    assert "hashpartitioning" in plan(customers.customer_core_by_key(silver))
    by_key, usual = customers.customer_summary_by_key(by_customer), customers.customer_summary(silver)
    assert sorted(map(str, by_key.collect())) == sorted(map(str, usual.select(*by_key.columns).collect()))
    # Another session declares the table anew from its description.
    for table in spark.catalog.listTables():
        spark.sql(f"drop table {table.name}")
    again = read_clustered(spark, str(tmp_path / "by_customer"))
    assert again.count() == silver.count() and "hashpartitioning" not in plan(customers.customer_core_by_key(again))
    with pytest.raises(FileExistsError):
        write_clustered(silver, str(tmp_path / "by_customer"), "customer_id", 4)


def test_profile_shuffles_digests_in_place_of_rows(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    exchange = [line for line in plan(profile.raw_profile(raw)).split("\n") if "hashpartitioning(digest" in line]
    assert exchange


def test_hours_pass_through_no_single_task(stored):
    text = plan(series.period_trends(stored[1], "hour"))
    windows = [line for line in text.split("\n") if "SinglePartition" in line]
    assert len(windows) <= 2  # totals and last rows of the ranges


def test_only_columns_as_received_are_dealt_out_by_key(spark, sf_dir, monkeypatch):
    dealt = []

    def watched(df, *args, **options):
        dealt.append(df.columns)
        return write_clustered(df, *args, **options)

    monkeypatch.setattr(registry, "write_clustered", watched)
    found = registry.queries()["clustered_merchants"](spark, sf_dir).collect()
    assert dealt == [list(RAW_COLUMNS)]
    assert sorted(found) == sorted(registry.queries()["merchant_core"](spark, sf_dir).collect())


def test_what_is_made_after_the_rows_are_dealt_out_is_stored(spark, tmp_path):
    rows = spark.range(100).selectExpr("id % 7 as k", "id as x")
    stored = write_clustered(rows, str(tmp_path / "by_k"), "k", 4, then=lambda dealt: dealt.withColumn("y", dealt.x * 2))
    assert stored.columns == ["k", "x", "y"] and stored.where("y = 2 * x").count() == 100
    assert read_clustered(spark, str(tmp_path / "by_k")).columns == ["k", "x", "y"]
