"""What several operators share: bounded caches, hashed words, thin-coded numbers and shared-folder tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    A session on one machine without that setting (a local test) gets one of its own; on
    a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tessella-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Lets go of the shuffles of results that are written: Spark deletes the files of those
    that neither Python nor the JVM refers to any more, once the JVM has looked."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class BoundedCache(dict):
    """A dict that starts anew once it holds ``limit`` entries, so memory stays bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def put(self, key, value):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class AgingCache(BoundedCache):
    """Two generations of ``limit`` / 2 entries: when the newer is full the older one goes, but
    for what was asked for meanwhile. A key not found by ``get`` may be found by ``recall``."""

    def __init__(self, limit: int):
        super().__init__(limit // 2)
        self.older: dict = {}

    def recall(self, key):
        found = self.older.get(key)
        return None if found is None else self.put(key, found)

    def put(self, key, value):
        if len(self) >= self.limit:
            self.older = dict(self)
        return super().put(key, value)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words: ASCII white space parts them, A-Z is lower-cased. A hash is
    sooner computed than looked up, so none are kept."""
    words = text.encode("utf-8", "replace").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def thin(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs: one byte for the
    width, then the low bytes of all, the next bytes of all, and so on."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def thick(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()
