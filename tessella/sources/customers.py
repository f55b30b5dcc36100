"""Reading the customer table: one row per customer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.operators.layout import materialised

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("products_number", T.IntegerType()),
        T.StructField("credit_card", T.IntegerType()),
        T.StructField("active_member", T.IntegerType()),
        T.StructField("estimated_salary", T.DoubleType()),
        T.StructField("churn", T.IntegerType()),
    ]
)


def read_customers_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = CUSTOMER_SCHEMA,
) -> DataFrame:
    """Customers from CSV with a header line.

    With a schema the files are read once and the header is checked against
    it. ``schema=None`` infers the types, which costs one more pass over the
    text. Empty fields are NULL either way.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


@dataclass(frozen=True)
class CheckedFiles:
    """Customers of well-formed lines, and the lines that are not, with a reason each."""

    customers: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """``(reason, n)`` of the rejected lines."""
        return self.rejected.groupBy("reason").agg(F.count("*").alias("n"))


LINE = "_rejected_line"
QUOTED = r'"([^"\\]|\\.)*"'  # a quoted field, whose separators don't count


def read_customers_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CUSTOMER_SCHEMA,
    header: bool = True,
    store: Callable[[DataFrame], DataFrame] = materialised,
) -> CheckedFiles:
    """Customers from CSV, malformed lines kept apart from them.

    A line is malformed if it has too few or too many fields or a field that its column
    can't hold; an empty field is a NULL of a well-formed line. The text is parsed once,
    into a Parquet table that both results read; ``store`` writes it, with the whole line
    of a malformed one in the column ``LINE``.
    """
    kept = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    reader = spark.read.option("header", header).option("enforceSchema", not header)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    table = store(reader.schema(kept).csv(path))
    bad = table.filter(F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"))
    return CheckedFiles(table.filter(F.col(LINE).isNull()).drop(LINE), bad.withColumn("reason", reason_of("line", schema)))


def reason_of(line: str, schema: T.StructType) -> Column:
    """Why a line doesn't fit: its number of fields, else the first field of another type."""
    bare = F.regexp_replace(line, QUOTED, "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = F.when(fields < len(schema), "too few fields").when(fields > len(schema), "too many fields")
    names = [f"f{i}" for i in range(len(schema))]
    texts = F.from_csv(line, ", ".join(f"{n} string" for n in names))
    for name, field in zip(names, schema.fields):
        wrong = texts[name].isNotNull() & texts[name].try_cast(field.dataType).isNull()
        reason = reason.when(wrong, f"{field.name} is no {field.dataType.simpleString()}")
    return reason.otherwise("malformed")


def read_customers_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
