"""Encoding, assembling and standardising the clustering features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    StandardScaler,
    StandardScalerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.config import SegmentationConfig
from tessella.operators.labels import LabelEncoder

RAW, SCALED, UNCENTRED = "features_unscaled", "features", "features_uncentred"


def encoders(config: SegmentationConfig) -> list[LabelEncoder]:
    """The stage that puts an index next to every category, if there is one."""
    if not config.categorical:
        return []
    return [LabelEncoder(list(config.categorical), list(config.index_cols))]


def fit_encoder(df: DataFrame, config: SegmentationConfig) -> PipelineModel:
    return Pipeline(stages=encoders(config)).fit(df)


def assembler(config: SegmentationConfig) -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(config.feature_cols), outputCol=RAW, handleInvalid=config.invalid
    )


def scaler() -> StandardScaler:
    """Zero mean, unit sample deviation; a constant column becomes 0."""
    return StandardScaler(inputCol=RAW, outputCol=SCALED, withMean=True, withStd=True)


def fit_features(df: DataFrame, config: SegmentationConfig) -> PipelineModel:
    """Encoder, assembler and scaler as one reusable, savable model.

    Reads ``df`` twice (the scaler needs the encoder's indices), so give it a
    table that is cheap to read again.
    """
    return Pipeline(stages=[*encoders(config), assembler(config), scaler()]).fit(df)


def fitted_scaler(model: PipelineModel) -> StandardScalerModel:
    return next(s for s in model.stages if isinstance(s, StandardScalerModel))


def uncentred(model: PipelineModel) -> ElementwiseProduct:
    """Scaled but not shifted features, from an already fitted pipeline.

    Distances are those of the standardised features. Bisecting K-Means needs
    them: it splits a cluster by moving its centre in proportion to the
    centre's norm, and centred data has a root centre of about zero.
    """
    factors = [1.0 / s if s > 0 else 0.0 for s in fitted_scaler(model).std.toArray()]
    return ElementwiseProduct(
        scalingVec=Vectors.dense(factors), inputCol=RAW, outputCol=UNCENTRED
    )


def feature_projection(df: DataFrame, config: SegmentationConfig) -> DataFrame:
    return df.select(config.id_col, *config.feature_cols)


def long_form(
    df: DataFrame, id_col: str, vector_col: str, names: Sequence[str], value: str = "value"
) -> DataFrame:
    """A vector column as one row per id and feature."""
    return df.select(
        id_col, F.posexplode(vector_to_array(vector_col)).alias("_position", value)
    ).select(
        id_col,
        F.element_at(F.lit(list(names)), F.col("_position") + 1).alias("feature"),
        value,
    )


def wide_form(df: DataFrame, id_col: str, vector_col: str, names: Sequence[str]) -> DataFrame:
    """A vector column as one column per feature."""
    values = df.select(id_col, vector_to_array(vector_col).alias("_values"))
    return values.select(
        id_col, *[F.get("_values", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )
