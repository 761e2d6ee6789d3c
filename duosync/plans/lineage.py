"""Cutting long plans with written tables.

A flow reads its enriched events many times, and each reading would plan and run all the
joins before it again. ``Scratch`` writes such a frame once into the folder the session names
for checkpoints and reads it back: the plan starts over, only the needed columns are read,
and the optimizer knows the true size. The files outlive a lost executor.

The shuffle files that a frame took go when it is written: nothing reads them again. Otherwise they
stay until the driver happens to collect garbage, and those of many steps add up on disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="duosync-")
    spark.conf.set(SETTING, folder)
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    return _on_store(spark, path, lambda store, at: store.exists(at))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever Spark can write. Nothing happens if it isn't there."""
    _on_store(spark, path, lambda store, at: store.delete(at, True))


def _on_store(spark: SparkSession, path: str, act):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return act(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside delete their shuffle files at their end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Written frames of one batch; ``release`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark)}/duosync-{uuid.uuid4().hex}"
        self.count = 0
        self.written: dict[int, tuple[DataFrame, str]] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        with shuffles_go(df.sparkSession):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.written[id(out)] = (out, path)
        return out

    def let_go(self, *frames: DataFrame) -> None:
        """Delete written frames that nothing reads any more."""
        for df in frames:
            delete_path(self.spark, self.written.pop(id(df))[1])

    def release(self) -> None:
        if self.count:
            delete_path(self.spark, self.folder)


def no_cut(df: DataFrame) -> DataFrame:
    """Keep the plan whole."""
    return df


def let_go(cut, *frames: DataFrame) -> None:
    """Delete frames that ``cut`` wrote, if it writes any."""
    if isinstance(cut, Scratch):
        cut.let_go(*frames)
