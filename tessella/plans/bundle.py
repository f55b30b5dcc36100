"""A fitted segmentation as one versioned folder, applied to customers it has not seen.

The folder holds the feature pipeline, the K-Means model and a manifest: version, config,
schema of the customers it was fitted on, canonical cluster numbers and segment names. The
manifest is written last, so a folder without one is not a bundle.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.config import SegmentationConfig
from tessella.operators.agreement import renumbered
from tessella.operators.clustering import assign
from tessella.operators.features import RAW, SCALED
from tessella.plans.segmentation import Segmentation
from tessella.sinks.tables import write_text

VERSION = 1


class SchemaMismatch(ValueError):
    """The customers lack columns the bundle needs, or have them in another kind."""


@dataclass(frozen=True)
class Bundle:
    """Everything needed to label customers without a fit."""

    config: SegmentationConfig
    schema: T.StructType
    features_model: PipelineModel
    model: KMeansModel
    numbers: list[int]
    names: dict[int, str]

    @property
    def needed(self) -> list[str]:
        """Columns that labelling reads."""
        return [self.config.id_col, *self.config.numeric, *self.config.categorical]

    def problems(self, schema: T.StructType) -> list[str]:
        """What keeps a table from being labelled: absent columns, columns twice (case is not
        told apart), features of another kind. Other columns may be anything."""
        found = []
        for name in self.needed:
            fields = [f for f in schema.fields if f.name.lower() == name.lower()]
            if len(fields) != 1:
                found.append(f"{name}: {'absent' if not fields else 'there are several'}")
            elif name in self.config.numeric and not isinstance(fields[0].dataType, (T.NumericType, T.BooleanType)):
                found.append(f"{name}: {fields[0].dataType.simpleString()} is no number")
            elif name in self.config.categorical and not isinstance(fields[0].dataType, T.AtomicType):
                found.append(f"{name}: {fields[0].dataType.simpleString()} is no label")
        made = {"cluster", "segment_name", RAW, SCALED, *self.config.index_cols}
        return found + [f"{f.name}: taken by the result" for f in schema.fields if f.name in made]

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with ``cluster`` and ``segment_name``. Row-wise: scan, features, nearest
        centre, no fit and no shuffle (but for labels that are looked up by a join).

        A category the bundle has not seen is a label of its own, as in the fit. Customers
        with a NULL or NaN in a numeric feature fail or are left out, as ``config.invalid``
        says. Raises ``SchemaMismatch`` before anything runs.
        """
        found = self.problems(df.schema)
        if found:
            raise SchemaMismatch("; ".join(found))
        columns = df.columns
        labelled = renumbered(assign(self.features_model.transform(df), self.model), self.numbers)
        names = F.create_map(*[F.lit(x) for pair in sorted(self.names.items()) for x in pair])
        return labelled.select(*columns, "cluster", names[F.col("cluster")].alias("segment_name"))


def save_bundle(result: Segmentation, folder: str) -> None:
    """Write the fitted parts of a segmentation below ``folder``, the manifest last.

    What an earlier bundle there holds is replaced only where its parts have the same
    version; the manifest goes first then, so a half-written folder can't be loaded.
    """
    spark = result.report.sparkSession
    write_text(spark, "", f"{folder}/manifest")
    result.features_model.write().overwrite().save(f"{folder}/features")
    result.model.write().overwrite().save(f"{folder}/kmeans")
    manifest = {
        "version": VERSION,
        "config": asdict(result.config),
        "schema": result.customers_schema.jsonValue(),
        "numbers": result.numbers,
        "names": {str(r["cluster"]): r["segment_name"] for r in result.names.collect()},
    }
    write_text(spark, json.dumps(manifest), f"{folder}/manifest")


def load_bundle(spark: SparkSession, folder: str) -> Bundle:
    """The bundle of ``folder``; ``ValueError`` where there is none or of another version."""
    lines = [r["value"] for r in spark.read.text(f"{folder}/manifest").collect() if r["value"]]
    if len(lines) != 1:
        raise ValueError(f"{folder} holds no whole bundle")
    manifest = json.loads(lines[0])
    if manifest["version"] != VERSION:
        raise ValueError(f"{folder} has version {manifest['version']}, this is {VERSION}")
    config = {k: tuple(v) if isinstance(v, list) else v for k, v in manifest["config"].items()}
    return Bundle(
        config=SegmentationConfig(**config),
        schema=T.StructType.fromJson(manifest["schema"]),
        features_model=PipelineModel.load(f"{folder}/features"),
        model=KMeansModel.load(f"{folder}/kmeans"),
        numbers=manifest["numbers"],
        names={int(c): name for c, name in manifest["names"].items()},
    )


def read_new_customers(spark: SparkSession, bundle: Bundle, path: str) -> DataFrame:
    """CSV files with a header line, in any order of columns. Columns the bundle knows have
    its types; others are strings."""
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name.lower(): f.dataType for f in bundle.schema.fields}
    schema = T.StructType([T.StructField(c, known.get(c.lower(), T.StringType())) for c in header])
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
