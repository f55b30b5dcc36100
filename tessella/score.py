"""``python -m tessella.score BUNDLE INPUT OUTPUT``: label new customers without a fit."""

from __future__ import annotations

import argparse

from tessella.plans.bundle import load_bundle, read_new_customers
from tessella.session import get_session
from tessella.sinks.tables import write_csv, write_parquet


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessella.score", description="Label customers with a saved segmentation.")
    parser.add_argument("bundle", help="folder that the segmentation job saved its bundle in")
    parser.add_argument("input", help="customers: CSV files with a header line, or Parquet")
    parser.add_argument("output", help="folder of the labelled customers")
    parser.add_argument("--input-as", choices=("csv", "parquet"), default="csv", help="form of the input")
    parser.add_argument("--labelled-as", choices=("csv", "parquet"), default="csv", help="form of the output")
    given = parser.parse_args(arguments)
    spark = get_session()
    bundle = load_bundle(spark, given.bundle)
    customers = read_new_customers(spark, bundle, given.input) if given.input_as == "csv" else spark.read.parquet(given.input)
    labelled = bundle.apply(customers)
    (write_csv if given.labelled_as == "csv" else write_parquet)(labelled, given.output)


if __name__ == "__main__":
    main()
