"""Describing segments: profiles, names, shares and churn.

Everything here is one aggregate per cluster, combined map-side, with at most
k rows behind it. Steps after the aggregate use windows over those k rows
instead of a second pass over the customers.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.config import SegmentationConfig
from tessella.functions.columns import percent, segment_name

# Published names of averages that don't follow from their column's name.
PUBLISHED_NAMES = {"products_number": "avg_products", "estimated_salary": "avg_salary", "active_member": "pct_active"}
# Averages that the naming rules compare with their median over the clusters.
MEDIANS = ("avg_balance", "avg_salary", "avg_products")
DEFAULT = SegmentationConfig()


def profile_means(config: SegmentationConfig = DEFAULT) -> dict[str, str]:
    """Names of the profile's columns and the column that each one averages: numbers, then
    shares of flags, then means of the label index of categories."""
    described = tuple(dict.fromkeys(config.numeric + config.described))
    name = lambda c: PUBLISHED_NAMES.get(c) or f"{'pct' if c in config.flags else 'avg'}_{c}"
    ordered = sorted(described, key=lambda c: c in config.flags)
    return {name(c): c for c in ordered} | {f"{c}_mode": f"{c}_index" for c in config.categorical}


def _all_clusters():
    return Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _means_by_cluster(df: DataFrame, means: Mapping[str, str]) -> DataFrame:
    return (
        df.groupBy("cluster")
        .agg(
            F.count("*").alias("size"),
            *[F.mean(column).alias(name) for name, column in means.items()],
        )
        .orderBy("cluster")
    )


def cluster_profiles(df: DataFrame, config: SegmentationConfig = DEFAULT) -> DataFrame:
    """Size and feature means per cluster.

    ``country_mode`` and ``gender_mode`` are means of the label index; their
    names are part of the published table.
    """
    return _means_by_cluster(df, profile_means(config))


def cluster_summary(df: DataFrame, config: SegmentationConfig = DEFAULT) -> DataFrame:
    """Profile and churn rate of every cluster in one pass; the rate is NULL without an outcome."""
    if config.outcome:
        return _means_by_cluster(df, {**profile_means(config), "churn_rate": config.outcome})
    return cluster_profiles(df, config).withColumn("churn_rate", F.lit(None).cast("double"))


def churn_of(summary: DataFrame) -> DataFrame:
    return summary.select("cluster", F.col("size").alias("total_customers"), "churn_rate")


def profile_lookup(profiles: DataFrame, cluster: int) -> DataFrame:
    return profiles.filter(F.col("cluster") == cluster)


def profile_medians(profiles: DataFrame) -> DataFrame:
    """Exact medians across clusters, every cluster counting once."""
    return profiles.agg(*[F.median(c).alias(f"median_{c}") for c in MEDIANS if c in profiles.columns])


def with_names(profiles: DataFrame) -> DataFrame:
    medians = {c: F.median(c).over(_all_clusters()) for c in MEDIANS if c in profiles.columns}
    return profiles.withColumn("segment_name", segment_name(F.col("cluster"), profiles.columns, medians))


def segment_names(profiles: DataFrame) -> DataFrame:
    return with_names(profiles).select("cluster", "segment_name").orderBy("cluster")


def with_share(profiles: DataFrame) -> DataFrame:
    total = F.sum("size").over(_all_clusters())
    return profiles.withColumn("share_percent", percent(F.col("size"), total))


def segment_share(profiles: DataFrame) -> DataFrame:
    return with_share(profiles).select("cluster", "size", "share_percent").orderBy("cluster")


def segment_report(profiles: DataFrame) -> DataFrame:
    """One row per segment: name, size, share, averages, and shares of flags in percent."""
    averages = [c for c in profiles.columns if c.startswith("avg_")]
    shares = [c for c in profiles.columns if c.startswith("pct_")]
    return (
        with_share(with_names(profiles))
        .select(
            "cluster",
            "segment_name",
            "size",
            "share_percent",
            *averages,
            *[(F.col(c) * 100).alias(f"{c.removeprefix('pct_')}_percent") for c in shares],
        )
        .orderBy("cluster")
    )


def churn_by_cluster(df: DataFrame, outcome: str = "churn") -> DataFrame:
    return churn_of(_means_by_cluster(df, {"churn_rate": outcome}))


def churn_percent(churn: DataFrame) -> DataFrame:
    """Churn in percent, with the one-decimal label shown to readers."""
    in_percent = F.col("churn_rate") * 100
    return churn.select(
        "cluster",
        in_percent.alias("churn_percent"),
        F.format_string("%.1f%%", in_percent).alias("label"),
    ).orderBy("cluster")


def clustered_customers(df: DataFrame, config: SegmentationConfig = DEFAULT) -> DataFrame:
    """The labelled table: id, cluster, then every other column with a part, as the table
    of customers orders them."""
    rest = [c for c in config.columns_of(df.columns) if c != config.id_col]
    return df.select(config.id_col, "cluster", *rest)


def segment_projection(df: DataFrame) -> DataFrame:
    """Balance in thousands against products, the two axes of the segment map."""
    return df.select(
        "customer_id",
        (F.col("balance") / 1000).alias("balance_thousands"),
        "products_number",
        "cluster",
    )


def segment_grid(df: DataFrame, x: str = "balance", y: str = "products_number", bins: int = 20) -> DataFrame:
    """The segment map as counts: ``(x_bin, x_from, x_to, y, cluster, n)``.

    The range of ``x`` is cut into ``bins`` equal parts between its least and greatest value,
    found in one pass; a second counts, combined map-side. The result has at most bins x
    values of ``y`` x clusters rows, whatever the number of customers. Where all values are
    equal there is one bin. NULL and NaN in ``x`` have bin and bounds NULL.
    """
    value = F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double"))
    least, most = df.agg(F.min(value), F.max(value)).first()
    width = (most - least) / bins if least is not None and most > least else None
    place = F.lit(0) if width is None else F.least(F.floor((value - least) / width), F.lit(bins - 1))
    placed = df.select(F.when(value.isNotNull(), place).cast("int").alias("x_bin"), F.col(y).alias("y"), "cluster")
    grid = placed.groupBy("x_bin", "y", "cluster").agg(F.count("*").alias("n"))
    edge = lambda n: F.when(F.col("x_bin").isNotNull(), F.lit(least) + (F.col("x_bin") + n) * F.lit(width or 0.0))
    return grid.select("x_bin", edge(0).alias("x_from"), edge(1).alias("x_to"), "y", "cluster", "n")
