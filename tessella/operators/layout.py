"""Where rows lie while models are fitted on them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from math import ceil

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessella.session import scratch_path, shared_dir

@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept on the executors inside the block; lost parts are recomputed."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def materialised(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    For a table that several passes read, each its own columns: the plan below
    runs once, and nothing goes back beyond these files when an executor is
    lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, aggregates: Mapping[str, Column], path: str) -> tuple[DataFrame, DataFrame]:
    """``df`` as a Parquet table at ``path``, read back, and one row of aggregates over it.

    The tasks that write the table add the aggregates up: they cost no further scan. The
    row is held as it is."""
    spark, told = df.sparkSession, Observation()
    columns = [c.alias(alias) for alias, c in aggregates.items()]
    df.observe(told, *columns).write.mode("overwrite").parquet(path)
    row = told.get
    plain = {alias: v.asDict() if isinstance(v := row[alias], Row) else v for alias in aggregates}
    return spark.read.schema(df.schema).parquet(path), held(spark, [plain], df.agg(*columns).schema)


def held(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few rows as part of the plan: reading them takes no job."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder, partition by partition.

    Unlike a table it comes back in the layout it had, which iterative fits
    need, and every round of a fit starts from a plan of one step.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def gathered(df: DataFrame) -> DataFrame:
    """A table of one row per cluster or so, computed once and held as is."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def pin_layout(
    df: DataFrame, order: Sequence[Column], rows: int, rows_per_partition: int
) -> DataFrame:
    """Rows in a partition and order that depend on the data alone.

    K-Means samples its first centres and adds up its sums per partition, so a seed only
    reproduces a fit on the same layout. The number of partitions comes from the row
    count, and rows go to them by hash of all of ``order``, id and features: an id on
    very many rows is spread as its features are.
    """
    n = max(1, ceil(rows / rows_per_partition))
    return df.repartition(n, *order).sortWithinPartitions(*order)
