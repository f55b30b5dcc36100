"""What must hold for fitted models, whatever clusters they find."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import TESTDATA
from tessella.config import SegmentationConfig
from tessella.operators import clustering, evaluation
from tessella.operators.features import SCALED
from tessella.operators.layout import materialised, pin_layout
from tessella.plans.segmentation import segment_customers
from tessella.sources.order_history import bank_customers

CONFIG = SegmentationConfig(invalid="skip", max_k=5)
FOLDER = str(TESTDATA / "sf0.01")
K = 4
POINT = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField(SCALED, VectorUDT()),
        T.StructField("cluster", T.IntegerType()),
    ]
)


@pytest.fixture(scope="module")
def customers(spark):
    return materialised(bank_customers(spark, FOLDER))


@pytest.fixture(scope="module")
def fit(customers):
    with clustering.fit_table(customers, CONFIG) as table:
        yield table


@pytest.fixture(scope="module")
def model(fit):
    return clustering.fit_kmeans(fit.table, K, CONFIG)


def vectors(df, label="cluster"):
    rows = df.select("customer_id", SCALED, label).orderBy("customer_id").collect()
    return np.array([r[SCALED].toArray() for r in rows]), np.array([r[label] for r in rows])


def nearest(points, centres):
    return ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)


def test_kmeans_labels_and_centres(fit, model):
    points, labels = vectors(clustering.assign(fit.features, model))
    centres = np.array(model.clusterCenters())
    assert len(points) == 1500
    assert set(labels) == set(range(K))
    assert (nearest(points, centres) == labels).all()
    means = np.array([points[labels == c].mean(axis=0) for c in range(K)])
    assert np.abs(means - centres).max() < 0.02
    cost = ((points - centres[labels]) ** 2).sum()
    assert cost < ((points - points.mean(axis=0)) ** 2).sum()


def test_centres_table(fit, model):
    rows = clustering.centres_table(fit.features, model, CONFIG.feature_cols).collect()
    assert [r["cluster"] for r in rows] == list(range(K))
    assert sum(r["size"] for r in rows) == 1500


def test_a_fit_does_not_depend_on_the_input_layout(customers, model):
    for layout in (customers.repartition(3), customers.repartition(7, "country")):
        with clustering.fit_table(layout, CONFIG) as again:
            other = clustering.fit_kmeans(again.table, K, CONFIG)
        # Up to the last bits, as sums over partitions are added in any order.
        assert np.allclose(other.clusterCenters(), model.clusterCenters(), atol=1e-9)


def pinned(df, rows):
    return pin_layout(df, [F.col("customer_id"), F.col("age"), F.col("balance")], df.count(), rows)


def test_many_partitions_hold_every_row_once(customers):
    table = pinned(customers, 100)
    assert table.rdd.getNumPartitions() == 15
    assert table.select("customer_id").distinct().count() == table.count() == 1500


def with_hot_id(customers):
    return customers.withColumn(
        "customer_id", F.expr("CASE WHEN customer_id % 3 = 0 THEN 7 ELSE customer_id END")
    )


def test_a_hot_id_is_spread(customers):
    table = pinned(with_hot_id(customers), 100)
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 15 and sum(sizes) == 1500 and max(sizes) <= 150


@pytest.mark.parametrize("k", [4, 6])
def test_a_hot_id_does_not_change_a_fit(customers, k):
    from dataclasses import replace

    config, hot = replace(CONFIG, rows_per_partition=400), with_hot_id(customers)
    centres = []
    for layout in (hot.repartition(3), hot.repartition(7, "country")):
        with clustering.fit_table(layout, config) as fit:
            centres.append(clustering.fit_kmeans(fit.table, k, config).clusterCenters())
    assert np.allclose(*centres, atol=1e-9)


def test_absent_seeds_are_named(fit):
    with pytest.raises(ValueError, match="999999"):
        clustering.vectors_of(fit.customers, fit.model, "customer_id", [0, 999999])


def test_churn_does_not_reach_the_labels(customers):
    flipped = customers.withColumn("churn", 1 - F.col("churn"))
    labels = []
    for df in (customers, flipped):
        with clustering.fit_table(df, CONFIG) as table:
            found = clustering.fit_kmeans(table.table, K, CONFIG)
        labels.append(vectors(clustering.assign(table.features, found))[1])
    assert (labels[0] == labels[1]).all()


@pytest.mark.parametrize("k", [2, 4])
def test_bisecting_finds_all_leaves(fit, k):
    model = clustering.fit_bisecting(fit.table, fit.model, k, CONFIG)
    df = clustering.assign_bisecting(fit.features, fit.model, model)
    sizes = {r["cluster"]: r["size"] for r in evaluation.cluster_sizes(df).collect()}
    assert set(sizes) == set(range(k))
    assert sum(sizes.values()) == 1500


def test_sweep(fit):
    swept = clustering.sweep(fit, CONFIG)
    scores = {r["k"]: r["silhouette_score"] for r in swept.scores.collect()}
    assert list(scores) == [2, 3, 4, 5]
    sizes = swept.sizes.collect()
    for k in scores:
        points, labels = vectors(clustering.assign(fit.features, swept.models[k]))
        assert scores[k] == pytest.approx(closed_form(points, labels), abs=1e-9)
        counted = {r["cluster"]: r["size"] for r in sizes if r["k"] == k}
        assert counted == {c: int((labels == c).sum()) for c in set(labels)}


def test_a_sweep_in_turn_equals_one_side_by_side(fit):
    from dataclasses import replace

    small = replace(CONFIG, max_k=3)
    together = clustering.sweep(fit, replace(small, parallelism=2)).scores.collect()
    in_turn = clustering.sweep(fit, replace(small, parallelism=1)).scores.collect()
    assert together == in_turn


def test_no_more_clusters_than_distinct_points(spark):
    rows = [(i, Vectors.dense([float(i % 2)]), 0) for i in range(20)]
    df = spark.createDataFrame(rows, POINT)
    model = clustering.fit_kmeans(df, 5, CONFIG)
    assert len(model.clusterCenters()) == 2
    labelled = clustering.assign(df.drop("cluster"), model)
    assert sorted(r["size"] for r in evaluation.cluster_sizes(labelled).collect()) == [10, 10]


def test_one_cluster_has_no_score(spark):
    rows = [(i, Vectors.dense([float(i)]), 0) for i in range(5)]
    df = spark.createDataFrame(rows, POINT)
    assert evaluation.silhouette(df, "cluster") is None
    assert evaluation.silhouette(df.limit(0), "cluster") is None


def closed_form(points, labels):
    """Silhouette of every point from all its pairwise squared distances."""
    distances = ((points[:, None, :] - points[None]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = distances[i][same].sum() / (same.sum() - 1)
        b = min(distances[i][labels == c].mean() for c in set(labels) - {own})
        scores.append(1 - a / b if a < b else (b / a - 1 if a > b else 0.0))
    return float(np.mean(scores))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.integers(-50, 50), st.integers(-50, 50), st.integers(0, 3)),
        min_size=3,
        max_size=30,
    ).filter(lambda rows: len({r[2] for r in rows}) > 1)
)
def test_silhouette_against_all_pairs(spark, rows):
    table = [
        (i, Vectors.dense([float(x), float(y)]), c) for i, (x, y, c) in enumerate(rows)
    ]
    df = spark.createDataFrame(table, POINT)
    points = np.array([[x, y] for x, y, _ in rows], dtype=float)
    labels = np.array([c for _, _, c in rows])
    assert evaluation.silhouette(df, "cluster") == pytest.approx(
        closed_form(points, labels), abs=1e-9
    )


def test_nearest_centre_takes_the_lowest_on_a_tie(spark):
    rows = [(0, Vectors.dense([0.0, 0.0]), 0), (1, Vectors.dense([2.0, 0.0]), 0)]
    df = spark.createDataFrame(rows, POINT).drop("cluster")
    centres = [[5.0, 5.0], [1.0, 0.0], [1.0, 0.0], [-1.0, 0.0]]
    got = clustering.assign_to_centres(df, centres).orderBy("customer_id").collect()
    assert [r["cluster"] for r in got] == [1, 1]


def test_nearest_of_the_first_centres(fit):
    centres = clustering.vectors_of(fit.customers, fit.model, "customer_id", range(6))
    labels = clustering.label_names(range(2, 7))
    points, found = vectors(clustering.assign_to_first(fit.table, centres, labels), labels[4])
    assert (nearest(points, np.array(centres[:4])) == found).all()


def test_an_empty_cluster_keeps_its_centre(spark):
    rows = [(i, Vectors.dense([float(i)]), 0) for i in range(4)]
    df = spark.createDataFrame(rows, POINT).drop("cluster")
    assert clustering.lloyd_rounds(df, [[1.0], [100.0]], 2) == [[1.5], [100.0]]


def test_clustering_an_array_column(spark):
    raw = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    df = raw.select(
        F.col("vec_id").alias("customer_id"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias(SCALED),
    )
    model = clustering.fit_kmeans(df, 10, CONFIG)
    points, labels = vectors(clustering.assign(df, model))
    assert points.shape == (500, 64)
    assert (nearest(points, np.array(model.clusterCenters())) == labels).all()


def test_whole_job(spark, customers, tmp_path):
    result = segment_customers(customers, CONFIG)
    scores = {r["k"]: r["silhouette_score"] for r in result.scores.collect()}
    assert result.best_k == max(sorted(scores), key=scores.get)
    assert result.labelled.count() == 1500
    report = result.report.collect()
    assert sum(r["size"] for r in report) == 1500
    assert {r["cluster"] for r in report} == set(range(result.best_k))
    assert sum(r["size"] for r in result.sizes.collect() if r["k"] == result.best_k) == 1500
    comparison = result.comparison.first()
    assert comparison["kmeans"] == pytest.approx(scores[result.best_k], abs=1e-9)
    assert result.missing.count() == 0
    churned = sum(r["churn_rate"] * r["total_customers"] for r in result.churn.collect())
    assert churned == pytest.approx(customers.agg(F.sum("churn")).first()[0])

    out = str(tmp_path / "out")
    result.save(out)
    assert spark.read.parquet(f"{out}/clustered_customers").count() == 1500
    for name, rows in (
        ("kmeans_evaluation", 4),
        ("cluster_profiles", result.best_k),
        ("churn_by_cluster", result.best_k),
    ):
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() == rows


def test_a_given_k_is_fitted_alone(customers):
    result = segment_customers(customers, CONFIG, k=3)
    assert result.best_k == 3 and result.report.count() == 3
    assert [r["k"] for r in result.scores.collect()] == [3]


def test_the_command(spark, customers, tmp_path):
    from tessella.__main__ import main
    from tessella.score import main as score_main
    from tessella.sinks.releases import read_released
    from tessella.sinks.tables import write_csv

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(customers, source)
    main([source, target, "--k", "3", "--invalid", "skip"])
    assert read_released(spark, target, "clustered_customers").count() == 1500
    assert read_released(spark, target, "cluster_profiles").count() == 3
    assert read_released(spark, target, "report_left_out").first()["left_out"] == 0
    assert read_released(spark, target, "report_report").count() == 3
    score_main([f"{target}/bundle", source, str(tmp_path / "scored"), "--labelled-as", "parquet"])
    scored = spark.read.parquet(str(tmp_path / "scored")).select("customer_id", "cluster")
    labelled = read_released(spark, target, "clustered_customers").select("customer_id", "cluster")
    assert scored.exceptAll(labelled).count() == 0 == labelled.exceptAll(scored).count()
