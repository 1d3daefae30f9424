"""Shared storage for results that are used twice and must stay the same both times."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; where it names none, one in the warehouse, which is shared as well."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"


def scratch_path(spark: SparkSession, name: str = "") -> str:
    """A new path in the shared folder, under the application id; it is removed when the application ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/settled/{spark.sparkContext.applicationId}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return f"{folder}/{name}{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and read them back.

    The result survives lost executors, is computed once (``checkpoint()`` computes twice), and
    values that depend on partitioning, such as a partition number, no longer change. Tables lie
    under the application id and are removed when the application ends.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run in here go when it ends; else they stay until the driver happens to collect its garbage.

    For what runs once, such as a write: a DataFrame that is collected twice would make its shuffle files again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settle_each(pieces: Iterable[DataFrame]) -> DataFrame:
    """As ``settle``, of tables with the same columns one after another: each has removed its shuffle files before the next begins."""
    path = ""
    for piece in pieces:
        spark, schema, path = piece.sparkSession, piece.schema, path or scratch_path(piece.sparkSession)
        with shuffles_removed(spark):
            piece.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that is no longer read."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Give a finished table its name; nothing may have that name yet."""
    source, target = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(target) or not files.rename(source, target):
        raise OSError(f"{new} exists or cannot be written")
