"""K-Means and Bisecting K-Means: fitting, sweeping over k, comparing."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel, KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.clustering import KMeans as RddKMeans
from pyspark.mllib.clustering import KMeansModel as KMeansCentres
from pyspark.mllib.linalg import Vectors as OldVectors
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.config import SegmentationConfig
from tessella.functions.columns import centre_distances, nearest
from tessella.operators.evaluation import (
    SCORES,
    compare,
    run_side_by_side,
    silhouette,
    silhouettes,
    sizes_table,
)
from tessella.operators.features import (
    RAW,
    SCALED,
    UNCENTRED,
    fit_features,
    fitted_scaler,
    uncentred,
)
from tessella.operators.inspection import summary_columns
from tessella.operators.journal import NO_JOURNAL, Journal, NoJournal
from tessella.operators.layout import checkpointed, persisted, pin_layout
from tessella.operators.quality import incomplete


@dataclass(frozen=True)
class FitTable:
    """Features ready for fitting.

    ``customers`` is the materialised input, ``summary`` one row that its write has counted
    (sizes, missing values, moments), and ``model`` turns it into features. ``table`` holds just id and feature vectors, in pinned layout:
    the assembled vectors are checkpointed, and persisted for as long as the
    ``fit_table`` block lasts; scaling them is cheaper than storing them twice.
    """

    customers: DataFrame
    summary: DataFrame
    model: PipelineModel
    table: DataFrame
    journal: Journal | NoJournal = NO_JOURNAL

    @property
    def features(self) -> DataFrame:
        """All customers with their features, recomputed row by row on demand."""
        return self.model.transform(self.customers)


def customer_aggregates(df: DataFrame, config: SegmentationConfig, only: Column | None = None) -> dict[str, Column]:
    """What the write of the customers counts on its way, of the rows where ``only`` holds."""
    schema = df.select(*config.columns_of(df.columns)).schema
    return summary_columns(schema, only) | {"_incomplete": incomplete(config.numeric, only)}


@contextmanager
def fit_table(
    df: DataFrame,
    config: SegmentationConfig,
    journal: Journal | NoJournal = NO_JOURNAL,
    summary: DataFrame | None = None,
) -> Iterator[FitTable]:
    """Read ``df`` once and prepare it for any number of fits.

    One shuffle, of ids and assembled vectors; all else is row-wise. With a ``summary`` of
    its ``customer_aggregates`` ``df`` counts as written already and is used as it is.
    """
    customers = df.select(*config.columns_of(df.columns))
    if summary is None:
        customers, summary = journal.observed("customers", customers, customer_aggregates(customers, config))
    model = journal.model("features", PipelineModel, lambda: fit_features(customers, config))
    pinned = pin_layout(
        model.transform(customers).select(config.id_col, RAW),
        [F.col(config.id_col), vector_to_array(RAW)],
        summary.first()["_rows"],
        config.rows_per_partition,
    )
    raw = checkpointed(pinned)
    with persisted(raw):
        yield FitTable(customers, summary, model, fitted_scaler(model).transform(raw), journal)


def kept_kmeans(fit: FitTable, k: int, config: SegmentationConfig) -> KMeansModel:
    """``fit_kmeans``, unless the journal has the model of an earlier run."""
    return fit.journal.model(f"kmeans-{k}", KMeansModel, lambda: fit_kmeans(fit.table, k, config))


def fit_kmeans(table: DataFrame, k: int, config: SegmentationConfig) -> KMeansModel:
    """K-Means on the standardised features.

    The column handed over is not itself persisted, so MLlib holds the vectors
    in the form its rounds read rather than decode a cached table each time.
    """
    return KMeans(
        featuresCol=SCALED, predictionCol="cluster", k=k, seed=config.seed, maxIter=config.max_iter
    ).fit(table.select(SCALED))


def fit_bisecting(
    table: DataFrame, model: PipelineModel, k: int, config: SegmentationConfig
) -> BisectingKMeansModel:
    """Bisecting K-Means on the scaled, un-centred features (see ``uncentred``)."""
    return BisectingKMeans(
        featuresCol=UNCENTRED,
        predictionCol="cluster",
        k=k,
        seed=config.seed,
        maxIter=config.max_iter,
    ).fit(uncentred(model).transform(table).select(UNCENTRED))


def assign(df: DataFrame, model: KMeansModel, label: str = "cluster") -> DataFrame:
    return model.transform(df, {model.predictionCol: label})


def assign_bisecting(
    df: DataFrame,
    features_model: PipelineModel,
    model: BisectingKMeansModel,
    label: str = "cluster",
) -> DataFrame:
    shifted = uncentred(features_model).transform(df)
    return model.transform(shifted, {model.predictionCol: label}).drop(UNCENTRED)


def centres_table(df: DataFrame, model: KMeansModel, names: Sequence[str]) -> DataFrame:
    """Centres of a model with the size of each cluster of ``df``.

    There may be fewer than k of them: MLlib finds no more than there are
    distinct points.
    """
    spark = df.sparkSession
    rows = [(i, *map(float, c)) for i, c in enumerate(model.clusterCenters())]
    centres = spark.createDataFrame(
        rows, "cluster int, " + ", ".join(f"{name} double" for name in names)
    )
    sizes = assign(df, model).groupBy("cluster").agg(F.count("*").alias("size"))
    return centres.join(sizes, "cluster", "left").fillna(0, ["size"]).orderBy("cluster")


@dataclass(frozen=True)
class Sweep:
    """Models, scores and cluster sizes by k, the last two also as tables."""

    models: Mapping[int, KMeansModel]
    score_of: Mapping[int, float | None]
    size_of: Mapping[int, dict[int, int]]
    scores: DataFrame
    sizes: DataFrame


def label_names(ks) -> dict[int, str]:
    return {k: f"cluster_{k}" for k in ks}


def sweep(fit: FitTable, config: SegmentationConfig) -> Sweep:
    """Fit and score K-Means for every k of the configured range.

    The fits share one persisted table; ``config.parallelism`` of them run at once. Sizes
    and scores for all k come from two passes.
    """
    spark = fit.table.sparkSession
    # The largest k takes longest, so it starts first.
    ks = list(reversed(config.ks))
    fitted = run_side_by_side(spark, lambda k: kept_kmeans(fit, k, config), ks, config.parallelism)
    models = dict(sorted(zip(ks, fitted)))
    labels, labelled = label_names(config.ks), fit.table
    for k, model in models.items():
        labelled = assign(labelled, model, labels[k])
    scores, sizes = silhouettes(labelled, labels)
    return Sweep(
        models=models,
        score_of=scores,
        size_of=sizes,
        scores=spark.createDataFrame(list(scores.items()), SCORES),
        sizes=sizes_table(spark, sizes),
    )


def compare_algorithms(
    fit: FitTable, kmeans_score: float | None, k: int, config: SegmentationConfig
) -> DataFrame:
    """K-Means, whose silhouette is known, against Bisecting K-Means for the same k."""
    bisecting = fit.journal.model(
        f"bisecting-{k}", BisectingKMeansModel, lambda: fit_bisecting(fit.table, fit.model, k, config)
    )
    labelled = assign_bisecting(fit.table, fit.model, bisecting)
    scores = [
        ("kmeans", kmeans_score),
        ("bisecting_kmeans", silhouette(labelled, "cluster")),
    ]
    spark = fit.table.sparkSession
    return compare(spark.createDataFrame(scores, "algorithm string, silhouette_score double"))


def vectors_of(
    customers: DataFrame, model: PipelineModel, id_col: str, ids: Sequence[int]
) -> list[list[float]]:
    """Feature vectors of the given ids, in their order, to serve as centres.

    The filter comes before the features, as it would not pass below MLlib's
    assembler; here it reaches the scan.
    """
    rows = (
        model.transform(customers.filter(F.col(id_col).isin(list(ids))))
        .groupBy(id_col)
        .agg(F.first(vector_to_array(SCALED)).alias("at"))
        .collect()
    )
    found = {row[id_col]: row["at"] for row in rows}
    missing = [i for i in ids if i not in found]
    if missing:
        raise ValueError(f"no features for these ids: {missing}")
    return [found[i] for i in ids]


def _with_distances(df: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    # The array is a column of its own, so that it is made once per row.
    return df.withColumn("_at", vector_to_array(SCALED)).withColumn(
        "_distances", centre_distances(F.col("_at"), centres)
    )


def assign_to_centres(
    df: DataFrame, centres: Sequence[Sequence[float]], label: str = "cluster"
) -> DataFrame:
    """Label every row with the nearest of the given centres."""
    labelled = _with_distances(df, centres).withColumn(label, nearest(F.col("_distances")))
    return labelled.drop("_at", "_distances")


def assign_to_first(
    df: DataFrame, centres: Sequence[Sequence[float]], labels: Mapping[int, str]
) -> DataFrame:
    """One label column per k: the nearest of the first k centres.

    Distances are computed once; each k takes the least of its own.
    """
    firsts = {label: nearest(F.slice("_distances", 1, k)) for k, label in labels.items()}
    return _with_distances(df, centres).withColumns(firsts).drop("_at", "_distances")


def lloyd_rounds(
    df: DataFrame, centres: Sequence[Sequence[float]], rounds: int
) -> list[list[float]]:
    """Centres after so many rounds of MLlib's K-Means from declared ones.

    A fit without its random start; only MLlib's RDD interface takes given centres. An
    empty cluster keeps its centre.
    """
    vectors = MLUtils.convertVectorColumnsFromML(df.select(SCALED), SCALED)
    start = KMeansCentres([OldVectors.dense(c) for c in centres])
    fitted = RddKMeans.train(
        vectors.rdd.map(lambda row: row[0]), len(centres), maxIterations=rounds, initialModel=start, epsilon=0.0
    )
    return [[float(x) for x in c] for c in fitted.clusterCenters]
