"""Run all layers: ``python -m remitlake SOURCE BASE``, in the session that the environment configures."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from remitlake.plans import summary
from remitlake.plans.layers import run_layers


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="remitlake", description="CSV payments to bronze, silver and gold tables")
    parser.add_argument("source", help="CSV file or folder")
    parser.add_argument("base", help="folder for the layers")
    parser.add_argument("--on-bad-timestamp", choices=("reject", "fail"), default="reject")
    parser.add_argument("--strict-header", action="store_true", help="a header unlike the schema is an error")
    parser.add_argument("--corrupt-column", metavar="NAME", help="keep the text of malformed rows in bronze")
    parser.add_argument("--each-file", action="store_true", help="record each row's own file as its source")
    options = parser.parse_args(argv)

    spark = SparkSession.builder.appName("remitlake").getOrCreate()
    run = run_layers(
        spark,
        options.source,
        options.base,
        on_bad_timestamp=options.on_bad_timestamp,
        strict_header=options.strict_header,
        corrupt_column=options.corrupt_column,
        each_file=options.each_file,
    )
    run.quality_report.show(truncate=False)
    run.kpis.show(truncate=False)
    summary.sample_customers(run.gold["customer_summary"]).show(truncate=False)
    summary.sample_merchants(run.gold["merchant_analytics"]).show(truncate=False)
    summary.sample_months(run.gold["monthly_trends"]).show(truncate=False)


if __name__ == "__main__":
    main()
