"""Scoring a clustering and choosing between clusterings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.columns import silhouette_band
from tessella.operators.features import SCALED

SCORES = "k int, silhouette_score double"

Item = TypeVar("Item")
Result = TypeVar("Result")


def run_side_by_side(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item], at_once: int
) -> list[Result]:
    """``work`` for each item, at most ``at_once`` at a time, results in order."""
    items = list(items)
    if at_once <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPool(min(at_once, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def silhouettes(
    df: DataFrame, labels: Mapping[int, str], features: str = SCALED
) -> tuple[dict[int, float | None], dict[int, dict[int, int]]]:
    """Mean silhouette under squared Euclidean distance, and cluster sizes, of several
    label columns by their key, in two passes for all of them.

    The mean distance of a row to a whole cluster follows from the cluster's size, sum and
    sum of squares. The first pass adds these up for every column and cluster, combined
    map-side; the second averages the scores of all columns, which are written out over
    the numbers of the clusters, so no pair of rows is formed. A labelling of one cluster
    has no score (None); a cluster of one row scores 0, as do rows with both means equal.
    """
    point = vector_to_array(features)
    square = F.aggregate(point, F.lit(0.0), lambda total, x: total + x * x)
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("cluster")) for k, c in labels.items()])
    rows = df.select(F.col(features).alias("point"), square.alias("square"), F.explode(pairs).alias("at"))
    sums = rows.groupBy("at.k", "at.cluster").agg(
        F.count("*").alias("n"), Summarizer.sum(F.col("point")).alias("total"), F.sum("square").alias("square")
    )
    clusters: dict[int, dict[int, tuple]] = {k: {} for k in labels}
    for r in sums.collect():
        clusters[r["k"]][r["cluster"]] = (r["n"], r["total"].toArray().tolist(), r["square"])
    sizes = {k: {c: part[0] for c, part in sorted(found.items())} for k, found in clusters.items()}
    scored = {k: dict(sorted(found.items())) for k, found in clusters.items() if len(found) > 1}
    if not scored:
        return dict.fromkeys(labels), sizes
    width = len(next(iter(next(iter(scored.values())).values()))[1])
    points = df.select(*[labels[k] for k in scored], point.alias("_point"), square.alias("_square"))
    # Plain columns and literals, which generated code adds up; each distance is one column.
    # As SQL text: a thousand Column objects would take longer to make than to compute.
    points = points.selectExpr("*", *[f"get(_point, {i}) AS _x{i}" for i in range(width)])

    def mean_distance(n: int, total: list[float], squares: float) -> str:
        inner = " + ".join(f"_x{i} * {2 * t / n!r}D" for i, t in enumerate(total))
        return f"_square + {squares / n!r}D - ({inner})"

    far = [f"{mean_distance(*part)} AS _{k}_{c}" for k, found in scored.items() for c, part in found.items()]
    points = points.selectExpr(*[f"`{labels[k]}` AS _{k}" for k in scored], *far)

    def own_and_other(k: int) -> list[str]:
        """Mean distance to the own cluster, NULL where that is the row alone, and to the nearest other."""
        own = " ".join(f"WHEN {c} THEN _{k}_{c} * {n / (n - 1)!r}D" for c, n in sizes[k].items() if n > 1)
        others = ", ".join(f"IF(_{k} = {c}, NULL, _{k}_{c})" for c in sizes[k])
        return [f"CASE _{k} {own or 'WHEN NULL THEN 0D'} END AS _own_{k}", f"least({others}) AS _other_{k}"]

    points = points.selectExpr(*[part for k in scored for part in own_and_other(k)])
    mean = "avg(CASE WHEN {own} IS NULL OR {own} = {other} THEN 0 WHEN {own} < {other} THEN 1 - {own} / {other} ELSE {other} / {own} - 1 END) AS s{k}"
    row = points.selectExpr(*[mean.format(own=f"_own_{k}", other=f"_other_{k}", k=k) for k in scored]).first()
    return {k: row[f"s{k}"] if k in scored else None for k in labels}, sizes


def silhouette(df: DataFrame, label: str, features: str = SCALED) -> float | None:
    """The mean silhouette of one label column, None for one cluster. Two passes."""
    return silhouettes(df, {0: label}, features)[0][0]


def score_labels(df: DataFrame, labels: Mapping[int, str], features: str = SCALED) -> tuple[DataFrame, DataFrame]:
    """``(k, silhouette_score)`` and ``(k, cluster, size)`` for several label columns of
    one table."""
    spark = df.sparkSession
    scores, sizes = silhouettes(df, labels, features)
    return spark.createDataFrame(list(scores.items()), SCORES), sizes_table(spark, sizes)


def cluster_sizes(df: DataFrame, label: str = "cluster") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("size")).orderBy(label)


def count_by_k(df: DataFrame, labels: Mapping[int, str]) -> dict[int, dict[int, int]]:
    """Sizes by k and cluster of several label columns: one aggregate of conditional
    counts, one row per task. Clusters are numbered below k."""
    counts = [F.count_if(F.col(c) == i).alias(f"{k}_{i}") for k, c in labels.items() for i in range(k)]
    row = df.agg(*counts).first()
    return {k: {i: row[f"{k}_{i}"] for i in range(k)} for k in labels}


def sizes_table(spark: SparkSession, counted: Mapping[int, Mapping[int, int]]) -> DataFrame:
    rows = [(k, i, n) for k, sizes in sorted(counted.items()) for i, n in sorted(sizes.items()) if n]
    return spark.createDataFrame(rows, "k int, cluster int, size long")


def sizes_by_k(df: DataFrame, labels: Mapping[int, str]) -> DataFrame:
    """Cluster sizes of several label columns, counted in one pass."""
    return sizes_table(df.sparkSession, count_by_k(df, labels))


def best_k(scores: DataFrame) -> DataFrame:
    """The row with the highest score, the lowest k among equals."""
    return scores.orderBy(F.desc_nulls_last("silhouette_score"), "k").limit(1)


def score_series(scores: DataFrame) -> DataFrame:
    """Scores by rising k with their reading and the best one marked."""
    best = best_k(scores).select("k").scalar()
    return scores.select(
        "k",
        "silhouette_score",
        silhouette_band(F.col("silhouette_score")).alias("band"),
        (F.col("k") == best).alias("is_best"),
    ).orderBy("k")


def compare(scores: DataFrame) -> DataFrame:
    """Who wins between ``kmeans`` and ``bisecting_kmeans``, and by how much.

    ``scores`` holds one row ``(algorithm, silhouette_score)`` for each. A tie
    goes to Bisecting K-Means. A missing score loses to any score.
    """

    def of(algorithm: str):
        return F.max(F.when(F.col("algorithm") == algorithm, F.col("silhouette_score")))

    return (
        scores.agg(of("kmeans").alias("kmeans"), of("bisecting_kmeans").alias("bisecting_kmeans"))
        .withColumn(
            "winner",
            F.when(
                (F.col("kmeans") > F.col("bisecting_kmeans"))
                | (F.col("kmeans").isNotNull() & F.col("bisecting_kmeans").isNull()),
                "kmeans",
            ).otherwise("bisecting_kmeans"),
        )
        .withColumn("delta", F.abs(F.col("kmeans") - F.col("bisecting_kmeans")))
    )
