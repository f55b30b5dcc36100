"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def get_session(app_name: str = "tessella", **conf: str) -> SparkSession:
    """The running session, or a new one; adaptive execution is Spark's default.

    The caller owns the session: nothing in this package stops it.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as ``spark.checkpoint.dir`` names it.

    On one machine (a local session, as in tests) a session without that setting gets a
    folder of its own. On a cluster a machine-local path would be lost with its machine,
    so there the setting is required.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tessella-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


class Scratch:
    """A folder of intermediate tables and checkpoints, below the shared one, with an owner.

    Inside ``with scratch.owning():`` every scratch path and every checkpoint of this thread
    lies in the folder. ``close()`` removes it with all that lies in it; lazy results that
    read it are of no use after that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/tessella/{uuid.uuid4().hex}"
        self.closed = False

    @contextmanager
    def owning(self) -> Iterator[Scratch]:
        before, token = shared_dir(self.spark), OWNER.set(self)
        self.spark.sparkContext.setCheckpointDir(f"{self.folder}/checkpoints")
        try:
            yield self
        finally:
            OWNER.reset(token)
            self.spark.sparkContext.setCheckpointDir(before)

    def close(self) -> None:
        if not self.closed:
            remove(self.spark, self.folder)
            self.closed = True

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


OWNER: ContextVar[Scratch | None] = ContextVar("tessella_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table: its owner's, if there is one, else one in the
    shared folder that the cluster's own clean-up removes."""
    owner = OWNER.get()
    return f"{owner.folder if owner else f'{shared_dir(spark)}/tessella'}/{uuid.uuid4().hex}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder wherever Spark can write, by the file system of its path."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
