"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reading bands of a silhouette score.
STRONG_ABOVE = 0.5
MODERATE_FROM = 0.25

# Thresholds and names of the segment rules, in rule order.
YOUNG_BELOW_AGE = 35
NEW_BELOW_TENURE = 3
INACTIVE_BELOW = 0.5
HIGH_VALUE = "High-Value Customers"
YOUNG = "Young Newcomers"
INACTIVE = "Inactive/At-Risk"
MULTI_PRODUCT = "Multi-Product Engagers"
LOW_BALANCE = "Low-Balance Savers"
STANDARD = "Standard Segment "


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent; NULL when the whole is zero."""
    return F.try_divide(part, whole) * 100


def silhouette_band(score: Column) -> Column:
    return (
        F.when(score > STRONG_ABOVE, "strong")
        .when(score >= MODERATE_FROM, "moderate")
        .when(score.isNotNull(), "weak")
    )


def segment_name(cluster: Column, known: Collection[str], medians: Mapping[str, Column]) -> Column:
    """Business name of a profile row; the first rule that holds wins.

    ``known`` are the profile's columns, ``medians`` those of the averages that rules
    compare with them. A rule on a column that the profile has not is left out.
    """
    at, median = F.col, medians.get
    rules = [
        (("avg_balance", "avg_salary"), HIGH_VALUE, lambda: (at("avg_balance") > median("avg_balance")) & (at("avg_salary") > median("avg_salary"))),
        (("avg_age", "avg_tenure"), YOUNG, lambda: (at("avg_age") < YOUNG_BELOW_AGE) & (at("avg_tenure") < NEW_BELOW_TENURE)),
        (("pct_active",), INACTIVE, lambda: at("pct_active") < INACTIVE_BELOW),
        (("avg_products",), MULTI_PRODUCT, lambda: at("avg_products") > median("avg_products")),
        (("avg_balance",), LOW_BALANCE, lambda: at("avg_balance") < median("avg_balance")),
    ]
    name = F.concat(F.lit(STANDARD), cluster.cast("string"))
    for needs, title, holds in reversed(rules):
        if set(needs) <= set(known):
            name = F.when(holds(), title).otherwise(name)
    return name


def squared_distance(x: Column, centre: Sequence[float]) -> Column:
    at = F.lit([float(v) for v in centre])
    squares = F.zip_with(x, at, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)


def centre_distances(x: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Squared distances of a double array to each centre, with its number.

    The centres are literals of the plan (k x d numbers), so a row is compared
    where it lies: no join, no shuffle, no row multiplied. ``x`` should be a
    plain column, as it is referred to once per centre.
    """
    return F.array(
        *[
            F.struct(squared_distance(x, centre).alias("distance"), F.lit(number).alias("cluster"))
            for number, centre in enumerate(centres)
        ]
    )


def nearest(distances: Column) -> Column:
    """Number of the nearest centre, the lowest one on a tie."""
    return F.array_min(distances)["cluster"]
