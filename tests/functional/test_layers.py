"""The whole run, from CSV files to key figures."""

import os

import pytest
from pyspark.sql import functions as F

from remitlake.contract import RAW_COLUMNS
from remitlake.operators import checks, cleaning
from remitlake.plans import summary
from remitlake.plans.layers import run_layers, run_silver
from remitlake.sources.landing import write_transactions_csv
from remitlake.sources.layers import LayerPaths, read_table, write_by_month, write_table
from remitlake.sources.shared import small_splits
from remitlake.sources.sample_tables import raw_transactions
from rows import column, raw


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    return str(tmp_path_factory.mktemp("base"))


@pytest.fixture(scope="module")
def run(spark, sf_dir, base):
    write_transactions_csv(raw_transactions(spark, sf_dir), f"{base}/landing")
    return run_layers(spark, f"{base}/landing", base)


def test_row_counts_of_the_small_tables(run):
    assert run.bronze.count() == 6064
    assert run.silver.count() == 4389
    assert run.gold["customer_summary"].count() == 150
    assert run.gold["monthly_trends"].count() == 83
    assert column(run.quality_report, "rows", "reason") == {
        "duplicate": 6064 - 4599,
        "critical_null": 4599 - 4513,
        "invalid_amount": 4513 - 4481,
        "bad_timestamp": 4481 - 4389,
        "kept": 4389,
    }


def test_segments_and_unknowns_of_the_small_tables(run):
    segments = run.gold["customer_summary"].groupBy("customer_segment").count()
    assert column(segments, "count", "customer_segment") == {
        "Premium": 55,
        "High Value": 40,
        "Mid Tier": 53,
        "Standard": 2,
    }
    unknown = [run.silver.filter(F.col(c) == "unknown").count() for c in ("currency", "channel", "status")]
    assert unknown == [206, 183, 97]


def test_the_report_equals_the_one_computed_on_its_own(run):
    alone = cleaning.quality_report(run.bronze)
    assert column(alone, "rows", "reason") == column(run.quality_report, "rows", "reason")


def test_layers_have_their_columns(run):
    assert len(run.bronze.columns) == 16 and len(run.silver.columns) == 20
    assert run.bronze.select("source_file").distinct().count() == 1
    assert run.silver.select("pipeline_layer").distinct().collect() == [("silver",)]
    types = dict(run.silver.dtypes)
    assert (types["transaction_month"], types["transaction_timestamp"], types["day_of_week"]) == (
        "string",
        "timestamp",
        "int",
    )


def test_directories(run, base):
    paths = LayerPaths(base)
    assert len([d for d in os.listdir(paths.silver) if d.startswith("transaction_month=")]) == 83
    for path in (paths.bronze, *(paths.gold(t) for t in run.gold)):
        assert any(f.endswith(".parquet") for f in os.listdir(path))


def test_a_month_is_one_file_here(run, base):
    for month in os.listdir(LayerPaths(base).silver):
        if month.startswith("transaction_month="):
            files = os.listdir(f"{LayerPaths(base).silver}/{month}")
            assert sum(f.endswith(".parquet") for f in files) == 1


def test_key_figures(run):
    kpis = run.kpis.collect()
    assert len(kpis) == 1
    figures = kpis[0].asDict()
    volume = figures.pop("total_volume")
    assert figures.pop("total_volume_display") == f"£{volume:,.2f}"
    merchants = run.gold["merchant_analytics"]
    assert figures == {
        "customers": 150,
        "merchants": merchants.count(),
        "months": 83,
        "high_risk_merchants": merchants.filter("merchant_risk_flag = 'High Risk'").count(),
        "premium_customers": 55,
    }
    assert volume == run.gold["monthly_trends"].agg(F.max("running_total_volume")).first()[0]


def test_samples(run):
    gold = run.gold
    five = summary.sample_customers(gold["customer_summary"]).collect()
    assert [r.customer_id for r in five] == sorted(r.customer_id for r in gold["customer_summary"].collect())[:5]
    assert len(summary.sample_merchants(gold["merchant_analytics"]).collect()) == 5
    assert len(summary.sample_months(gold["monthly_trends"]).collect()) == 12


def test_months_are_stored_in_order(run):
    stored = [r.transaction_month for r in run.gold["monthly_trends"].collect()]
    assert stored == sorted(stored)


def test_running_again_replaces_everything(spark, run, base):
    again = run_layers(spark, f"{base}/landing", base)
    assert (again.bronze.count(), again.silver.count()) == (6064, 4389)


def test_dynamic_overwrite_touches_only_the_months_present(spark, tmp_path):
    path = str(tmp_path / "silver")
    june, july = {"transaction_date": "2025-06-01"}, {"transaction_date": "2025-07-01"}
    silver = lambda *rows: cleaning.to_silver(raw(spark, *rows))
    write_by_month(silver(june, july), path)
    write_by_month(silver({**july, "amount": 99.0}), path, only_months_present=True)
    assert column(read_table(spark, path), "amount", "transaction_month") == {"2025-06": 8.4, "2025-07": 99.0}
    write_by_month(silver(june), path)
    assert column(read_table(spark, path), "amount", "transaction_month") == {"2025-06": 8.4}


def test_a_second_batch_into_a_month_leaves_layers_that_agree(spark, tmp_path):
    base = str(tmp_path / "base")
    june, july = {"transaction_date": "2025-06-01"}, {"transaction_date": "2025-07-01"}
    for batch in (({"transaction_id": "T1", **june}, {"transaction_id": "T3", **july}), ({"transaction_id": "T9", **july},)):
        write_transactions_csv(raw(spark, *batch), str(tmp_path / "in"))
        run = run_layers(spark, str(tmp_path / "in"), base)
    assert [r.transaction_id for r in run.silver.collect()] == ["T9"]
    for found in (checks.orphans(run.bronze, run.silver, run.gold), checks.row_accounting(run.bronze, run.silver, run.quality_report)):
        assert found.filter("not passed").isEmpty()


def test_landing_options_reach_the_run(spark, tmp_path):
    good = "T1,ann,m,Shop,Dining,12.50,GBP,online,completed,2025-06-01,10:00:00,Ghent,False"
    bad = good.replace("T1", "T2").replace("12.50", "much")
    (tmp_path / "in").mkdir()
    for name, line in (("a.csv", good), ("b.csv", bad)):
        (tmp_path / "in" / name).write_text(",".join(RAW_COLUMNS) + "\n" + line + "\n")
    run = run_layers(spark, str(tmp_path / "in"), str(tmp_path / "base"), corrupt_column="as_received", each_file=True)
    assert column(run.bronze, "as_received", "transaction_id") == {"T1": None, "T2": bad}
    assert sorted(r.source_file.rsplit("/", 1)[-1] for r in run.bronze.collect()) == ["a.csv", "b.csv"]
    assert run.silver.count() == 1 and "as_received" not in run.silver.columns
    (tmp_path / "in" / "a.csv").write_text(",".join(RAW_COLUMNS).replace("amount", "value") + "\n" + good + "\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        run_layers(spark, str(tmp_path / "in"), str(tmp_path / "base"), strict_header=True)


def test_failing_on_a_bad_time_stops_the_run(spark, tmp_path):
    paths = LayerPaths(str(tmp_path))
    write_table(raw(spark, {}, {"transaction_time": "late"}), paths.bronze)
    bronze = read_table(spark, paths.bronze)
    with pytest.raises(Exception, match="unreadable transaction time"):
        run_silver(bronze, paths, on_bad_timestamp="fail")
    assert run_silver(bronze, paths)[0].count() == 1


def test_command_line(spark, tmp_path, capsys):
    from remitlake.__main__ import main

    write_transactions_csv(raw(spark, {}, {"transaction_time": "late"}), str(tmp_path / "in"))
    main([str(tmp_path / "in"), str(tmp_path / "base")])
    shown = capsys.readouterr().out
    assert "bad_timestamp" in shown and "£8.40" in shown
    assert read_table(spark, LayerPaths(str(tmp_path / "base")).silver).count() == 1


def test_only_received_columns_pass_through_the_shuffle_before_the_write(spark, tmp_path, monkeypatch):
    from remitlake.plans import layers as steps
    from remitlake.sources.layers import LayerPaths
    from remitlake.sources.shared import SPLIT_BYTES, small_splits

    seen = []
    monkeypatch.setattr(steps, "gathered_by_month", lambda df: seen.append((df.columns, spark.conf.get("spark.sql.files.maxPartitionBytes"))) or df)
    write_transactions_csv(raw(spark, {}, {"transaction_time": "late"}), str(tmp_path / "in"))
    bronze = steps.run_bronze(spark, str(tmp_path / "in"), LayerPaths(str(tmp_path / "base")))
    silver, report = steps.run_silver(bronze, LayerPaths(str(tmp_path / "base")))
    ((columns, usual),) = seen
    assert set(columns) == {*RAW_COLUMNS, "ingestion_timestamp", "source_file", "transaction_month"}
    assert silver.count() == 1 and set(silver.columns) == set(cleaning.to_silver(bronze).columns)
    with small_splits(spark):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(SPLIT_BYTES)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == usual


def test_a_whole_run_leaves_no_shuffle_files_and_no_landing_files(spark, sf_dir, monkeypatch):
    from remitlake.plans import registry
    from test_shared import _released, _shuffle_files

    landed = []
    write = registry.write_transactions_csv
    monkeypatch.setattr(registry, "write_transactions_csv", lambda df, path, **how: landed.append(path) or write(df, path, **how))
    before = _shuffle_files(spark)
    kpis = registry.queries()["pipeline_summary"](spark, sf_dir)
    assert _released(spark, before)
    assert kpis.first().customers == 150
    assert len(landed) == 1 and not os.path.exists(landed[0])


def test_a_stored_file_has_row_groups_that_a_task_can_sort(spark, tmp_path):
    from glob import glob

    from pyarrow.parquet import ParquetFile

    from remitlake.sources.releases import Releases

    rows = spark.range(0, 4_000_000, 1, 1).select(F.xxhash64("id").alias("a"), F.lit("m").alias("transaction_month"))
    write_table(rows, str(tmp_path / "whole"))
    write_by_month(rows, str(tmp_path / "months"))
    Releases(spark, str(tmp_path / "lake")).written("t", rows)
    for folder in ("whole", "months", "lake"):
        (file,) = glob(f"{tmp_path}/{folder}/**/*.parquet", recursive=True)
        assert ParquetFile(file).num_row_groups >= 2
    with small_splits(spark):
        assert read_table(spark, str(tmp_path / "whole")).groupBy(F.spark_partition_id()).count().where("count > 0").count() >= 2
