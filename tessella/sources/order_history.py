"""Customers of the bank schema, derived from customer and order tables.

The columns keep the bank's names; their content is taken from order history
(``age`` is the number of orders, ``churn`` is no order in 180 days, and so
on). "Today" is the latest order date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_summary(orders: DataFrame) -> DataFrame:
    """One row per ordering customer, combined map-side before the shuffle."""
    return orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.max("o_totalprice").alias("largest_order"),
        F.countDistinct("o_orderpriority").alias("n_priorities"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_finished"),
    )


def bank_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table of ``sources.customers.CUSTOMER_SCHEMA``.

    Orders are aggregated before the join, so the join sees one row per key on
    both sides however many orders a customer has. Whether nation and region
    are broadcast is left to the optimizer, which checks their size.
    """
    orders = _table(spark, folder, "orders")
    today = orders.agg(F.max("o_orderdate")).scalar()
    since_first = F.datediff(today, F.col("first_order"))
    since_last = F.datediff(today, F.col("last_order"))
    return (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(order_summary(orders), F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            (350 + F.floor(500 * F.col("n_finished").cast("double") / F.col("n")))
            .cast("int")
            .alias("credit_score"),
            F.col("r_name").alias("country"),
            F.col("c_mktsegment").alias("gender"),
            F.col("n").cast("int").alias("age"),
            F.floor(since_first / 365).cast("int").alias("tenure"),
            F.col("c_acctbal").alias("balance"),
            F.col("n_priorities").cast("int").alias("products_number"),
            F.col("urgent").alias("credit_card"),
            F.when(since_last <= 365, 1).otherwise(0).alias("active_member"),
            F.col("largest_order").alias("estimated_salary"),
            F.when(F.col("last_order").isNull() | (since_last > 180), 1).otherwise(0).alias("churn"),
        )
    )


def dirty_customers(spark: SparkSession, folder: str) -> DataFrame:
    """``bank_customers`` with NULLs seeded into three columns; no row is left out."""

    def holed(column: str, step: int):
        return F.when(F.col("customer_id") % step != 0, F.col(column))

    return bank_customers(spark, folder).withColumns(
        {"balance": holed("balance", 17), "country": holed("country", 23), "age": holed("age", 29)}
    )
