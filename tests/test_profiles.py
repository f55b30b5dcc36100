import pytest
from pyspark.sql import functions as F

from tessella.operators import evaluation, profiles

# Medians of this table: balance 50, salary 10, products 1. One row per rule.
NAMING = [
    (0, 40.0, 5.0, 100.0, 1.0, 100.0, 0.6, "High-Value Customers"),
    (1, 30.0, 2.0, 10.0, 1.0, 10.0, 0.6, "Young Newcomers"),
    (2, 40.0, 5.0, 50.0, 1.0, 10.0, 0.4, "Inactive/At-Risk"),
    (3, 40.0, 5.0, 50.0, 3.0, 10.0, 0.6, "Multi-Product Engagers"),
    (4, 40.0, 5.0, 10.0, 1.0, 10.0, 0.6, "Low-Balance Savers"),
    (5, 40.0, 5.0, 50.0, 1.0, 10.0, 0.6, "Standard Segment 5"),
]
SCHEMA = (
    "cluster int, avg_age double, avg_tenure double, avg_balance double, avg_products double,"
    " avg_salary double, pct_active double, expected string"
)


def test_every_naming_rule(spark):
    table = spark.createDataFrame(NAMING, SCHEMA)
    medians = profiles.profile_medians(table).first().asDict()
    assert medians == {
        "median_avg_balance": 50.0,
        "median_avg_salary": 10.0,
        "median_avg_products": 1.0,
    }
    rows = profiles.with_names(table).collect()
    assert len(rows) == 6
    assert all(r["segment_name"] == r["expected"] for r in rows)


@pytest.mark.parametrize(
    "scores, best",
    [
        # The published scores, and a tie that the lowest k wins.
        ([.384, .416, .452, .429, .409, .396, .382, .370, .359], 4),
        ([.4, .5, .5], 3),
        ([None, .1], 3),
    ],
)
def test_best_k(spark, scores, best):
    table = spark.createDataFrame(list(enumerate(scores, start=2)), evaluation.SCORES)
    assert evaluation.best_k(table.orderBy(F.desc("k"))).first()["k"] == best
    marked = evaluation.score_series(table).collect()
    assert [r["k"] for r in marked] == sorted(r["k"] for r in marked)
    assert [r["k"] for r in marked if r["is_best"]] == [best]


def test_bands(spark):
    table = spark.createDataFrame(
        [(2, .51), (3, .5), (4, .25), (5, .2), (6, None)], evaluation.SCORES
    )
    bands = [r["band"] for r in evaluation.score_series(table).collect()]
    assert bands == ["strong", "moderate", "moderate", "weak", None]


@pytest.mark.parametrize(
    "kmeans, bisecting, winner",
    [
        (.3, .2, "kmeans"),
        (.2, .3, "bisecting_kmeans"),
        (.2, .2, "bisecting_kmeans"),
        (.2, None, "kmeans"),
        (None, .2, "bisecting_kmeans"),
    ],
)
def test_compare(spark, kmeans, bisecting, winner):
    rows = [("kmeans", kmeans), ("bisecting_kmeans", bisecting)]
    table = spark.createDataFrame(rows, "algorithm string, silhouette_score double")
    assert evaluation.compare(table).first()["winner"] == winner


def test_report_reads_the_customers_once(spark):
    df = spark.range(100).select(
        (F.col("id") % 3).cast("int").alias("cluster"),
        *[F.col("id").alias(c) for c in profiles.profile_means().values()],
    )
    report = profiles.segment_report(profiles.cluster_profiles(df))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    assert sum(r["share_percent"] for r in report.collect()) == pytest.approx(100)
