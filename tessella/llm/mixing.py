"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent, normalised:
1 leaves the shares as they are, 0 makes them equal. The exponent is bisected until
the weights have a wanted entropy, or the most repeated source is repeated as often as
allowed. The weights are then realised: each source's documents are dealt to blocks,
each block gets its part of the source's budget, and spends it on whole passes over the
block and on the front of a permutation of it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import written


@dataclass(frozen=True)
class MixSettings:
    """One of ``entropy`` (as a part of the largest possible, ln of the number of
    sources) and ``repeats`` has to be given.

    With ``entropy`` the budget is ``budget`` times all tokens. With ``repeats`` it is
    the smallest that leaves no source with less than all its documents, and no source
    is repeated more often than ``repeats`` times.
    """

    entropy: float | None = 0.95
    repeats: float | None = None
    budget: float = 1.0
    block_docs: int = 1000
    steps: int = 48  # halvings of the exponent's range


# Halvings evaluated by one pass over the sources.
HALVINGS = 4
# Rows of a source are joined with its weight in so many parts.
SALTS = 32


def words(text: str = "text") -> Column:
    """Tokens of a whole text: runs of characters that are not white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_shares(counted: DataFrame) -> DataFrame:
    """source, docs, tokens, share: one row per source. Pre-aggregated by task."""
    found = counted.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")
    )
    found = written(found, "sources")
    total = found.agg(F.sum("tokens")).first()[0] or 1
    return found.withColumn("share", F.col("tokens") / F.lit(total))


def exponent(shares: DataFrame, settings: MixSettings) -> float:
    """The bisected exponent in [0, 1]; each pass settles four halvings at once.

    Entropy falls and repetition (largest share over smallest, to the power of 1 minus
    the exponent) falls as the exponent rises. Out of reach targets give 0 or 1.
    Sources without tokens don't count.
    """
    live = shares.where("tokens > 0")
    low, high = 0.0, 1.0
    log = F.log("share")

    def too_low(at: list[float]) -> list[bool]:
        """Is the entropy above its target, or the repetition above its limit?"""
        if settings.repeats is not None:
            spread = live.agg(F.max(log) - F.min(log)).first()[0] or 0.0
            return [spread * (1 - a) > math.log(settings.repeats) for a in at]
        power = [F.exp(log * a) for a in at]
        sums = live.agg(
            F.count("*").alias("n"),
            *[F.sum(p).alias(f"z{i}") for i, p in enumerate(power)],
            *[F.sum(p * log * a).alias(f"e{i}") for i, (p, a) in enumerate(zip(power, at))],
        )
        over = [
            (F.log(f"z{i}") - F.col(f"e{i}") / F.col(f"z{i}") > settings.entropy * F.log("n")).alias(f"r{i}")
            for i in range(len(at))
        ]
        return [bool(x) for x in sums.select(*over).first()]

    for _ in range(settings.steps // HALVINGS):
        inner = [low + (high - low) * k / 2**HALVINGS for k in range(1, 2**HALVINGS)]
        below = too_low(inner)
        # too_low falls from true to false: the last true place is the new lower end.
        edges = [low, *inner, high]
        last = max([k + 1 for k, low_ in enumerate(below) if low_], default=0)
        low, high = edges[last], edges[last + 1]
    return (low + high) / 2


def weights(shares: DataFrame, settings: MixSettings) -> DataFrame:
    """``shares`` with weight and passes: how often the source's tokens are wanted.

    Rounded to nine places, so that the order of addition doesn't show.
    """
    power = F.exp(F.log("share") * exponent(shares, settings))
    rows = shares.withColumn("power", F.when(F.col("tokens") > 0, power).otherwise(0.0))
    least = F.min(F.when(F.col("tokens") > 0, F.col("power") / F.col("share")))
    total, least = rows.agg(F.sum("power"), least).first()
    weight = F.col("power") / F.lit(total or 1.0)
    if settings.repeats is None:
        passes = weight * settings.budget / F.col("share")
    else:
        passes = F.col("power") / (F.col("share") * F.lit(least or 1.0))
    # A source without tokens costs nothing: its documents stay, once.
    passes = F.when(F.col("tokens") > 0, passes).otherwise(1.0)
    return rows.select(
        "source", "docs", "tokens", F.round(weight, 9).alias("weight"), F.round(passes, 9).alias("passes")
    )


def draw(*columns: Column) -> Column:
    """A number below 2^52 that follows from the columns alone."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 13), 16, 10).cast("long")


def plan(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """doc_id, source, n_tokens, block, place, copies of every document.

    ``copies``: how often the mixture holds it; ``place``: its place in the permutation
    of its block. A null source counts as the source "", a null text as no tokens.
    Repeated rows each count, and are told apart by a number in their block. A source
    that holds most rows is spread over blocks of about ``block_docs`` documents, so no
    task gets more. A block misses its budget by half a document at most, however long that
    is. An empty table gives no rows.
    """
    source = F.coalesce("source", F.lit(""))
    counted = written(docs.select("doc_id", source.alias("source"), words().alias("n_tokens")), "counted")
    mixed = weights(source_shares(counted), settings)
    blocks = F.ceil(F.col("docs") / settings.block_docs).cast("long")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    per_salt = mixed.select("source", "passes", blocks.alias("blocks"), salts.alias("salt"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = counted.withColumn("salt", F.pmod(draw(F.lit("salt"), key), F.lit(SALTS)).cast("int"))
    rows = rows.join(per_salt, ["source", "salt"]).withColumn(
        "block", F.pmod(draw(F.lit("block"), F.col("source"), key), F.col("blocks"))
    )
    in_block = Window.partitionBy("source", "block")
    order = in_block.orderBy("turn", "doc_id", "n_tokens")
    rows = rows.withColumn("turn", draw(F.lit("turn"), F.col("source"), key))
    rows = rows.withColumns(
        {
            "place": F.row_number().over(order),
            "spent": F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "held": F.sum("n_tokens").over(in_block),
        }
    )
    whole = F.floor("passes")
    rest = (F.col("passes") - whole) * F.col("held")
    # The document that crosses the block's rest counts when at least half of it lies inside.
    inside = 2 * F.col("spent") - F.col("n_tokens") <= 2 * rest
    extra = F.when(inside & (F.col("passes") > whole), 1).otherwise(0)
    return rows.select(
        "doc_id", "source", "n_tokens", "block", "place", (whole + extra).cast("long").alias("copies")
    )


def mixed(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The documents of the mixture, all columns, each as often as planned."""
    copies = plan(docs, settings).groupBy("doc_id").agg(F.max("copies").alias("mix_copies"))
    whole = docs.select(F.struct(*docs.columns).alias("row"))  # so that no name can clash
    kept = whole.join(copies, F.col("row.doc_id").eqNullSafe(F.col("doc_id"))).where("mix_copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    return kept.select("row", times.alias("mix_copy")).select("row.*")
