"""Finished steps of a job, taken up by a run that starts again after a lost driver.

A step is known by the fingerprint of the run (config and input files) and its name. Its
model or table is written first and a mark after it, each step to a folder of its own, so
steps that finish side by side don't meet and a half-written step counts as not done.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import asdict
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.config import SegmentationConfig
from tessella.operators.layout import observed
from tessella.session import remove, scratch_path
from tessella.sinks.tables import write_text


def fingerprint(spark: SparkSession, config: SegmentationConfig, source: str) -> str:
    """Changes with the config, and with name, size or time of any input file. Contents
    aren't read; the files' digests are summed, so any number of them will do."""
    files = spark.read.format("binaryFile").load(source).select("path", "length", "modificationTime")
    digest = F.conv(F.substring(F.sha2(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")), 256), 1, 15), 16, 10)
    row = files.agg(F.count("*"), F.sum(digest.cast("decimal(38,0)"))).first()
    told = json.dumps([asdict(config), row[0], str(row[1])], sort_keys=True)
    return sha256(told.encode()).hexdigest()[:32]


class Journal:
    """The steps of one run. ``folder`` is one that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, run: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/{run}"
        try:
            lines = spark.read.text(f"{self.folder}/*/done").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = []
        self.done = {json.loads(r["value"])["step"]: json.loads(r["value"]) for r in lines}

    def _finish(self, step: str, **told) -> None:
        self.done[step] = {"step": step, **told}
        write_text(self.spark, json.dumps(self.done[step]), f"{self.folder}/{step}/done")

    def model(self, step: str, kind: type, fit: Callable[[], object]):
        """What ``fit`` returns, from the journal if the step is done."""
        path = f"{self.folder}/{step}/model"
        if step in self.done:
            return kind.load(path)
        model = fit()
        model.write().overwrite().save(path)
        self._finish(step)
        return model

    def table(self, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The rows of ``make``, written and read back, from the journal if it is done."""
        path = f"{self.folder}/{step}/table"
        if step not in self.done:
            df = make()
            df.write.mode("overwrite").parquet(path)
            self._finish(step, schema=df.schema.jsonValue())
        return self.spark.read.schema(StructType.fromJson(self.done[step]["schema"])).parquet(path)

    def observed(self, step: str, df: DataFrame, aggregates: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
        """``observed`` of ``df`` and its row of aggregates, from the journal if it is done."""
        path = f"{self.folder}/{step}/table"
        if step in self.done:
            return self.spark.read.schema(df.schema).parquet(path), self.table(f"{step}-summary", lambda: df)
        table, summary = observed(df, aggregates, path)
        summary = self.table(f"{step}-summary", lambda: summary)
        self._finish(step)
        return table, summary

    def clear(self) -> None:
        """Forget the run, once its result is safe."""
        remove(self.spark, self.folder)
        self.done = {}


class NoJournal:
    """Runs every step and keeps nothing."""

    def model(self, step: str, kind: type, fit: Callable[[], object]):
        return fit()

    def table(self, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        return make()

    def observed(self, step: str, df: DataFrame, aggregates: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
        return observed(df, aggregates, scratch_path(df.sparkSession, step))

    def clear(self) -> None:
        pass


NO_JOURNAL = NoJournal()
