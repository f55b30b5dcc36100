"""Label encoding that works the same for any number of labels.

Labels are ranked as MLlib's ``StringIndexer`` ranks them: most frequent first, ties by
name, NULL and unseen after the last. They are ranked in parallel and stay in a table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Transformer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.operators.layout import observed
from tessella.session import scratch_path

# Low bits of monotonically_increasing_id: the row's place in its partition.
PLACE_BITS = (1 << 33) - 1
# Labels on this share of all rows are hot: 100 of a category, at most.
HOT_SHARE = 0.01
KNOWN = "category string, n_labels double, hot map<string,double>"


def count_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(category, label, count)`` of all columns in one aggregate, combined map-side."""
    pairs = [
        F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("label")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs))).groupBy("category", "label").count()


@dataclass(frozen=True)
class Ranked:
    """Labels in their order: ``table`` (category, label, count, part, place), where part
    and place are a label's file and its place there; labels and counts of each category."""

    table: DataFrame
    n_labels: dict[str, float]
    totals: dict[str, int]

    def hot(self) -> dict[str, dict[str, float]]:
        """Positions of the hot labels of each category. They come first in their order, so
        their own order is enough."""
        shares = [(F.col("category") == c) & (F.col("count") >= n * HOT_SHARE) for c, n in self.totals.items() if n]
        found: dict[str, dict[str, float]] = {}
        if shares:
            rows = self.table.filter(reduce(lambda a, b: a | b, shares)).collect()
            for row in sorted(rows, key=lambda r: (r["part"], r["place"])):
                of = found.setdefault(row["category"], {})
                of[row["label"]] = float(len(of))
        return found

    def positions(self) -> DataFrame:
        """``(category, label, position)``: a label's place in its file plus the sizes of
        the files before it, less the place where its category begins."""
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = self.table.groupBy("part").count()
        offsets = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
        at = (F.col("offset") + F.col("place")).alias("at")
        placed = self.table.join(offsets, "part").select("category", "label", at)
        starts = placed.groupBy("category").agg(F.min("at").alias("start"))
        position = (F.col("at") - F.col("start")).cast("double").alias("position")
        return placed.join(starts, "category").select("category", "label", position)


def rank_labels(df: DataFrame, columns: list[str]) -> Ranked:
    """Every label ranked in parallel: sorting spreads the labels over tasks by range, and
    the one write of the sorted labels counts them."""
    counts = count_labels(df, columns).filter(F.col("label").isNotNull())
    ordered = counts.orderBy("category", F.desc("count"), "label")
    placed = ordered.withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS))}
    )
    own = {c: F.col("category") == c for c in columns}
    told = {f"{c}_labels": F.count_if(own[c]) for c in columns}
    told |= {f"{c}_rows": F.coalesce(F.sum(F.when(own[c], F.col("count"))), F.lit(0)) for c in columns}
    table, summary = observed(placed, told, scratch_path(df.sparkSession, "labels"))
    row = summary.first()
    return Ranked(
        table, {c: float(row[f"{c}_labels"]) for c in columns}, {c: row[f"{c}_rows"] for c in columns}
    )


class LabelEncoder(Estimator, HasInputCols, HasOutputCols):
    """Fits a ``LabelModel``; a drop-in stage for MLlib's ``StringIndexer``."""

    def __init__(self, inputs: list[str], outputs: list[str]):
        super().__init__()
        self._set(inputCols=inputs, outputCols=outputs)

    def _fit(self, df: DataFrame) -> LabelModel:
        return LabelModel(self.getInputCols(), self.getOutputCols(), rank_labels(df, self.getInputCols()))


class LabelModel(Transformer, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """Puts a label's position next to it.

    Hot labels, a bounded number of them, are looked up in the row. All others come from
    the table by a join, whose strategy Spark chooses. Rows that need no look-up, NULLs
    among them, get keys of their own there, so no key of the join is hot.
    """

    def __init__(self, inputs: list[str] = (), outputs: list[str] = (), ranked: Ranked | None = None):
        super().__init__()
        self._set(inputCols=list(inputs), outputCols=list(outputs))
        if ranked is not None:
            self.use(ranked.positions(), ranked.n_labels, ranked.hot())

    def use(self, table: DataFrame, n_labels: dict[str, float], hot: dict[str, dict[str, float]]) -> None:
        self.table, self.n_labels, self.hot = table, n_labels, hot

    def _transform(self, df: DataFrame) -> DataFrame:
        for column, output in zip(self.getInputCols(), self.getOutputCols()):
            df = self._encoded(df, column, output)
        return df

    def _encoded(self, df: DataFrame, column: str, output: str) -> DataFrame:
        label = F.col(column).cast("string")
        hot = self.hot.get(column, {})
        known: Column = F.lit(None).cast("double")
        if hot:
            known = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])[label]
        n_labels = self.n_labels.get(column, 0.0)
        if n_labels == len(hot):  # the table has no label that isn't looked up here
            return df.withColumn(output, F.coalesce(known, F.lit(n_labels)))
        labels = self.table.filter((F.col("category") == column) & ~F.col("label").isin(list(hot))).select(
            F.col("label").alias("_label"), F.lit(0).alias("_spread"), F.col("position").alias("_position")
        )
        looked_up = label.isNotNull() & F.col("_known").isNull()
        rows = df.withColumn("_known", known).withColumn(
            "_place", F.when(looked_up, 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int"))
        )
        joined = rows.join(
            labels, (label.eqNullSafe(F.col("_label"))) & (F.col("_place") == F.col("_spread")), "left"
        )
        return joined.withColumn(output, F.coalesce("_known", "_position", F.lit(n_labels))).drop(
            "_known", "_place", "_label", "_spread", "_position"
        )

    def write(self) -> MLWriter:
        return LabelModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return LabelModelReader()


class LabelModelWriter(MLWriter):
    def __init__(self, model: LabelModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.model.table.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        self.model.table.write.parquet(f"{path}/labels")
        known = [(c, n, self.model.hot.get(c, {})) for c, n in self.model.n_labels.items()]
        spark.createDataFrame(known, KNOWN).coalesce(1).write.parquet(f"{path}/known")


class LabelModelReader(MLReader):
    def load(self, path: str) -> LabelModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = LabelModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        known = spark.read.schema(KNOWN).parquet(f"{path}/known").collect()
        table = spark.read.schema("category string, label string, position double").parquet(f"{path}/labels")
        model.use(table, {r["category"]: r["n_labels"] for r in known}, {r["category"]: dict(r["hot"]) for r in known})
        return model
