"""Writing results. Every task writes its own rows; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header line. ``files`` bounds the number of files for tables
    known to be tiny, such as one row per cluster."""
    table = df if files is None else df.coalesce(files)
    table.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_text(spark: SparkSession, line: str, path: str) -> None:
    """One line of text, by way of Spark so that any store it writes to will do."""
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_by_label(df: DataFrame, path: str, label: str, sizes: Mapping[int, int], rows_per_file: int = 1_000_000) -> None:
    """Parquet in a folder for each label, for readers of single segments.

    ``sizes`` are the rows of each label: a label gets a task for every ``rows_per_file`` of
    its rows, so a segment with most of the rows is spread and a small one is one file. No
    file holds more than ``rows_per_file`` rows.
    """
    parts = {c: max(1, ceil(n / rows_per_file)) for c, n in sizes.items()}
    share = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col(label)]
    part = F.pmod(F.xxhash64(*[c for c in df.columns if c != label]), F.coalesce(share, F.lit(1)))
    spread = df.withColumn("_part", part).repartition(max(1, sum(parts.values())), label, "_part").drop("_part")
    spread.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(label).parquet(path)
