"""Looking at a table: counts, schema, first rows, summary statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position and type, with the size of the table."""
    return schema_table(row_count(df), df.schema)


def head_records(df: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by id: each task keeps its own n, none sorts all."""
    return df.orderBy(id_col).limit(n)


def describe_numeric(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation and range of every numeric column.

    One aggregate over the table; turning its single row on end is free.
    """
    return numeric_table(df.agg(*[_moments(c).alias(c) for c in numbers(df.schema)]), df.schema)


def describe_strings(df: DataFrame) -> DataFrame:
    """Count and first and last value, in string order, of every string column."""
    return string_table(df.agg(*[_range(c).alias(c) for c in strings(df.schema)]), df.schema)


# All of it in one aggregate, which a write can carry along (``materialised``) --------


def numbers(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]


def strings(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def _moments(c: str | Column) -> Column:
    return F.struct(
        F.count(c).alias("count"),
        F.mean(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    )


def _range(c: str | Column) -> Column:
    return F.struct(F.count(c).alias("count"), F.min(c).alias("min"), F.max(c).alias("max"))


def summary_columns(schema: T.StructType, only: Column | None = None) -> dict[str, Column]:
    """Aggregates that say all about a table that ``schema_table``, ``numeric_table``,
    ``string_table`` and ``quality.missing_table`` show, by name; of the rows where ``only``
    holds, if it is given."""
    at = lambda c: F.col(c) if only is None else F.when(only, F.col(c))
    known = {c: _moments(at(c)) for c in numbers(schema)} | {c: _range(at(c)) for c in strings(schema)}
    plain = {c: F.struct(F.count(at(c)).alias("count")) for c in schema.names}
    return {"_rows": F.count("*") if only is None else F.count_if(only), **(plain | known)}


def schema_table(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` has the size of the table as its first column."""
    fields = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("type"),
        )
        for position, field in enumerate(schema.fields, start=1)
    ]
    size = rows.select(F.col(rows.columns[0]).alias("n_rows")).withColumn("n_columns", F.lit(len(fields)))
    return size.select(F.inline(F.array(*fields)), "n_columns", "n_rows")


def _on_end(summary: DataFrame, columns: list[str], fields: tuple[str, ...], schema: str) -> DataFrame:
    if not columns:
        return summary.sparkSession.createDataFrame([], schema)
    return summary.unpivot([], columns, "column_name", "s").select("column_name", *[f"s.{f}" for f in fields])


def numeric_table(summary: DataFrame, schema: T.StructType) -> DataFrame:
    kinds = "column_name string, count long, mean double, stddev double, min double, max double"
    return _on_end(summary, numbers(schema), ("count", "mean", "stddev", "min", "max"), kinds)


def string_table(summary: DataFrame, schema: T.StructType) -> DataFrame:
    kinds = "column_name string, count long, min string, max string"
    return _on_end(summary, strings(schema), ("count", "min", "max"), kinds)
