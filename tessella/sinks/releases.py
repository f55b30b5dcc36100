"""Several result tables that appear at once.

A release writes its tables below a folder of its own. The last step appends one line to the
log of the target folder; readers take the tables that the newest line names. Until that
line is there, readers see the release before, so a run that fails in any write leaves the
old result whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessella.session import remove

Writer = Callable[[DataFrame, str], None]
LOG = "releases"


def log_of(spark: SparkSession, folder: str) -> list[dict]:
    """The lines of a folder's log, oldest first; none where nothing was released."""
    try:
        lines = spark.read.text(f"{folder}/{LOG}").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(r["value"]) for r in lines), key=lambda e: (e["number"], e["id"]))


def release(spark: SparkSession, folder: str, tables: Mapping[str, tuple[DataFrame, Writer, str]]) -> dict:
    """Write every table (DataFrame, how it is written, its format), then make them known.

    Two releases at once both stay readable; the one with the greater id wins a tie.
    """
    earlier = log_of(spark, folder)
    entry = {"number": earlier[-1]["number"] + 1 if earlier else 0, "id": uuid.uuid4().hex, "tables": {}}
    for name, (df, write, kind) in tables.items():
        path = f"release-{entry['number']}-{entry['id']}/{name}"
        write(df, f"{folder}/{path}")
        entry["tables"][name] = {"path": path, "format": kind, "schema": df.schema.jsonValue()}
    # One file, which the commit of this write moves into place.
    line = spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1)
    line.write.mode("append").text(f"{folder}/{LOG}")
    return entry


def read_released(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the newest release, with the types it was written with."""
    log = log_of(spark, folder)
    if not log:
        raise ValueError(f"nothing has been released to {folder}")
    table = log[-1]["tables"][name]
    reader = spark.read.schema(StructType.fromJson(table["schema"])).format(table["format"])
    return reader.option("header", True).load(f"{folder}/{table['path']}")


def prune(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Remove the tables of all but the newest releases; how many releases went."""
    old = log_of(spark, folder)[: -keep or None]
    for entry in old:
        remove(spark, f"{folder}/release-{entry['number']}-{entry['id']}")
    return len(old)
