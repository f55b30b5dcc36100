"""The derived customer table under hot keys and without broadcasts."""

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from oracle import connect, difference
from tessella.catalog.oracles import ORACLES
from tessella.session import scratch_path, shared_dir
from tessella.sources.order_history import bank_customers

TABLES = ("customer", "nation", "region")


@pytest.fixture
def skewed(spark, tmp_path):
    """One customer places a third of all orders."""
    for name in TABLES:
        (tmp_path / f"{name}.parquet").symlink_to(TESTDATA / "sf0.01" / f"{name}.parquet")
    orders = spark.read.parquet(str(TESTDATA / "sf0.01" / "orders.parquet"))
    hot = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey"))
    table = orders.withColumn("o_custkey", hot.cast("bigint")).toPandas()
    table["o_orderdate"] = table["o_orderdate"].astype("datetime64[us]")
    table.to_parquet(tmp_path / "orders.parquet")
    return tmp_path


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_a_hot_customer(spark, skewed, broadcast):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, broadcast)
    try:
        df = bank_customers(spark, str(skewed))
        assert difference(df, connect(skewed), ORACLES["scan_csv"]) is None
        assert df.filter("customer_id = 7").first()["age"] >= 5000
    finally:
        spark.conf.set(key, before)


def test_orders_are_combined_before_every_shuffle(spark):
    plan = bank_customers(spark, str(TESTDATA / "sf0.01"))._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(o_custkey" in line:
            assert "HashAggregate" in lines[i + 1] and "partial_" in lines[i + 1]


def test_only_needed_columns_are_scanned(spark):
    df = bank_customers(spark, str(TESTDATA / "sf0.01")).select("customer_id", "country")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "c_acctbal" not in plan


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder is not None
    if named:
        assert folder == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(folder)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
