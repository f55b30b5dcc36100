"""Missing values, counted for all columns in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.columns import percent


def non_null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percent per column. NULL is missing, NaN is a value."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    return missing_table(counts, df.columns)


def missing_table(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """From one row: ``_rows`` and the non-null count of each column."""
    missing = F.col("_rows") - F.col("non_null")
    return counts.unpivot(["_rows"], list(columns), "column_name", "non_null").select(
        "column_name",
        missing.alias("missing"),
        F.round(percent(missing, F.col("_rows")), 2).alias("missing_percent"),
    )


def missing_columns(df: DataFrame) -> DataFrame:
    return missing_values(df).filter("missing > 0")


def incomplete(numeric: Sequence[str], only: Column | None = None) -> Column:
    """How many rows (where ``only`` holds) have a NULL or NaN in a numeric feature."""
    bad = reduce(lambda a, b: a | b, [F.isnull(c) | F.isnan(F.col(c).cast("double")) for c in numeric], F.lit(False))
    return F.count_if(bad if only is None else bad & only)


def left_out(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """How many customers have all numeric features, and how many are left out under
    ``invalid="skip"`` because one is NULL or NaN. One aggregate."""
    return left_out_table(df.agg(F.count("*").alias("_rows"), incomplete(numeric).alias("_incomplete")))


def left_out_table(counts: DataFrame) -> DataFrame:
    return counts.select(
        (F.col("_rows") - F.col("_incomplete")).alias("clustered"), F.col("_incomplete").alias("left_out")
    )
