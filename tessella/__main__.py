"""``python -m tessella INPUT OUTPUT``, also for spark-submit: the whole job."""

from __future__ import annotations

import argparse

from tessella.config import SegmentationConfig
from tessella.plans.bundle import save_bundle
from tessella.plans.segmentation import run_job
from tessella.session import get_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessella", description="Segment the customers of a CSV table.")
    parser.add_argument("input", help="customer CSV files with a header line")
    parser.add_argument("output", help="folder of the result tables")
    parser.add_argument("--k", type=int, help="number of segments; by default the best of a sweep")
    parser.add_argument("--invalid", choices=("error", "skip"), default="error", help="customers without a feature")
    parser.add_argument("--labelled-as", choices=("csv", "parquet", "segments"), default="csv", help="form of the labelled table; segments: Parquet by cluster")
    parser.add_argument("--resume", action="store_true", help="keep finished steps and take up those of a failed run")
    given = parser.parse_args(arguments)
    config = SegmentationConfig(invalid=given.invalid)
    with run_job(get_session(), given.input, given.output, config, given.k, given.labelled_as, resume=given.resume) as result:
        save_bundle(result, f"{given.output}/bundle")
        result.report.show(truncate=False)


if __name__ == "__main__":
    main()
