"""Comparing two clusterings of the same customers, whose label numbers are arbitrary.

All of it follows from the contingency table, one aggregate with a row for each pair of
labels that occurs together: at most k x k rows, whatever the number of customers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(a, b, n)``: how many rows have both labels. Rows without a label are left out."""
    labelled = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return labelled.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))


def pairs(n: Column) -> Column:
    """Pairs of n rows, as a double: exact up to some hundred million rows of a label."""
    return n.cast("double") * (n - 1) / 2


def adjusted_rand(table: DataFrame) -> DataFrame:
    """One row ``(n, rand_index, adjusted_rand_index)`` from a contingency table.

    The share of pairs of rows that both clusterings treat alike, and the same corrected
    for chance: 1 for equal partitions, about 0 for unrelated ones. Two clusterings of one
    cluster each, or of single rows only, are equal.
    """
    by_a = table.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("in_a"))
    by_b = table.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("in_b"))
    both = table.agg(F.sum("n").alias("n"), F.sum(pairs(F.col("n"))).alias("in_both"))
    row = both.select("n", "in_both", by_a.scalar().alias("in_a"), by_b.scalar().alias("in_b"))
    row = row.withColumn("all", pairs(F.col("n")))
    expected = F.try_divide(F.col("in_a") * F.col("in_b"), F.col("all"))
    most = (F.col("in_a") + F.col("in_b")) / 2
    adjusted = F.when(most == expected, 1.0).otherwise(F.try_divide(F.col("in_both") - expected, most - expected))
    alike = F.try_divide(F.col("all") + 2 * F.col("in_both") - F.col("in_a") - F.col("in_b"), F.col("all"))
    return row.select("n", alike.alias("rand_index"), adjusted.alias("adjusted_rand_index"))


def heaviest_pairing(weights: Sequence[Sequence[int]]) -> list[int]:
    """For each row of a square matrix its column, so that the weights add up to the most.

    Rows join one at a time along the cheapest augmenting path, with prices on rows and
    columns that keep all reduced costs non-negative: k^3 steps for k rows.
    """
    k = len(weights)
    row_price, column_price = [0] * (k + 1), [0] * (k + 1)
    holder = [0] * (k + 1)  # row (from 1) that holds a column (from 1)
    for row in range(1, k + 1):
        holder[0], column = row, 0
        slack, came_from, settled = [float("inf")] * (k + 1), [0] * (k + 1), [False] * (k + 1)
        while holder[column]:
            settled[column] = True
            at, step, following = holder[column], float("inf"), 0
            for j in range(1, k + 1):
                if not settled[j]:
                    reduced = -weights[at - 1][j - 1] - row_price[at] - column_price[j]
                    if reduced < slack[j]:
                        slack[j], came_from[j] = reduced, column
                    if slack[j] < step:
                        step, following = slack[j], j
            for j in range(k + 1):
                if settled[j]:
                    row_price[holder[j]] += step
                    column_price[j] -= step
                else:
                    slack[j] -= step
            column = following
        while column:
            holder[column], column = holder[came_from[column]], came_from[column]
    pairing = [0] * k
    for column in range(1, k + 1):
        pairing[holder[column] - 1] = column - 1
    return pairing


def best_matching(table: DataFrame) -> DataFrame:
    """``(a, b, n)``: labels of two clusterings matched one to one so that as many rows as
    possible keep their match. A label beyond the other's number of labels has NULL there
    and n 0. The k x k table passes through the driver; nothing else does."""
    rows = table.collect()
    of_a, of_b = sorted({r["a"] for r in rows}), sorted({r["b"] for r in rows})
    size = max(len(of_a), len(of_b))
    count = {(r["a"], r["b"]): r["n"] for r in rows}
    names_a, names_b = ([*of, *[None] * (size - len(of))] for of in (of_a, of_b))
    pairing = heaviest_pairing([[count.get((a, b), 0) for b in names_b] for a in names_a])
    matched = [(a, names_b[j], count.get((a, names_b[j]), 0)) for a, j in zip(names_a, pairing)]
    return table.sparkSession.createDataFrame(matched, table.schema)


def canonical_numbers(centres: Sequence[Sequence[float]], sizes: dict[int, int]) -> list[int]:
    """A number for each cluster that does not depend on the fit's own: 0 is the largest,
    clusters of one size go by their centres, smallest first."""
    order = sorted(range(len(centres)), key=lambda c: (-sizes.get(c, 0), list(centres[c])))
    return [order.index(c) for c in range(len(centres))]


def renumbered(df: DataFrame, numbers: Sequence[int], label: str = "cluster") -> DataFrame:
    """``df`` with every label replaced by its number."""
    return df.withColumn(label, F.get(F.array(*[F.lit(n) for n in numbers]), F.col(label)))
