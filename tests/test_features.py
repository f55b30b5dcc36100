import math

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessella.config import SegmentationConfig
from tessella.operators.features import (
    RAW,
    SCALED,
    UNCENTRED,
    fit_encoder,
    fit_features,
    uncentred,
)

ONE = SegmentationConfig(numeric=("x",), categorical=("label",), invalid="error")


def test_labels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "label string")
    model = fit_encoder(df, ONE)
    unseen = spark.createDataFrame([("z",)], "label string")
    got = [r["label_index"] for r in model.transform(df.union(unseen)).collect()]
    assert got == [2.0, 1.0, 0.0, 0.0, 3.0, 3.0]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_many_labels_with_a_hot_one(spark, threshold):
    """The indices of StringIndexer, whatever the join."""
    df = (
        spark.range(3000)
        .repartition(5)
        .select(
            F.col("id").alias("customer_id"),
            F.when(F.col("id") % 3 == 0, "hot")
            .when(F.col("id") % 31 != 0, F.concat(F.lit("label "), F.col("id") % 613))
            .alias("label"),
        )
    )
    config = SegmentationConfig(numeric=(), categorical=("label",))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = fit_encoder(df, config).transform(df).select("customer_id", "label_index").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep").fit(df)
    assert sorted(got) == sorted(want.transform(df).select("customer_id", "label_index").collect())


def test_whole_numbers_are_labels_by_their_text(spark):
    df = spark.createDataFrame([(9,), (10,), (100,)], "label int")
    rows = fit_encoder(df, ONE).transform(df).collect()
    assert {r["label"]: r["label_index"] for r in rows} == {10: 0.0, 100: 1.0, 9: 2.0}


def test_standardise_with_sample_deviation_and_constant_column(spark):
    config = SegmentationConfig(numeric=("x", "y"), categorical=())
    df = spark.createDataFrame([(1, 1, 7), (2, 2, 7)], "customer_id int, x int, y int")
    rows = fit_features(df, config).transform(df).orderBy("customer_id").collect()
    got = [list(r[SCALED]) for r in rows]
    assert got[0] == pytest.approx([-math.sqrt(0.5), 0.0])
    assert got[1] == pytest.approx([math.sqrt(0.5), 0.0])


def test_uncentred_features_keep_all_distances(spark):
    config = SegmentationConfig(numeric=("x", "y"), categorical=())
    df = spark.createDataFrame([(1, 1, 7), (2, 5, 9), (3, 6, 1)], "customer_id int, x int, y int")
    model = fit_features(df, config)
    rows = uncentred(model).transform(model.transform(df)).collect()
    for a in rows:
        for b in rows:
            assert a[SCALED].squared_distance(b[SCALED]) == pytest.approx(
                a[UNCENTRED].squared_distance(b[UNCENTRED])
            )


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_number_fails_or_is_skipped(spark, bad):
    schema = "customer_id int, x double, label string"
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, None), (3, bad, "a")], schema)
    with pytest.raises(Exception, match="(?i)null|nan"):
        fit_features(df, ONE)
    skip = SegmentationConfig(numeric=("x",), categorical=("label",), invalid="skip")
    out = fit_features(df, skip).transform(df)
    assert sorted(r["customer_id"] for r in out.collect()) == [1, 2]
    # A NULL label is no error: it has an index of its own.
    assert out.filter("customer_id = 2").select(vector_to_array(RAW)).first()[0] == [2.0, 1.0]


def test_features_model_can_be_saved(spark, tmp_path):
    from pyspark.ml import PipelineModel

    config = SegmentationConfig(numeric=("x",), categorical=("label",))
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 4.0, "b")], "customer_id int, x double, label string")
    model = fit_features(df, config)
    model.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.transform(df).collect() == model.transform(df).collect()
