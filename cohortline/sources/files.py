"""Image files on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def has_extension(path: Column, ext: str = ".dcm") -> Column:
    return path.endswith(ext)


def filter_files(files: DataFrame, ext: str = ".dcm", path: str = "path") -> DataFrame:
    """Rows of a file listing with the expected extension."""
    return files.where(has_extension(F.col(path), ext))


def scan_image_files(spark: SparkSession, root: str, ext: str = ".dcm") -> DataFrame:
    """Recursive listing ``(path, length)``; file contents are never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{ext}")
        .load(root)
    )
    return files.select("path", "length")


def read_image_contents(spark: SparkSession, root: str, ext: str = ".dcm") -> DataFrame:
    """``(path, content)`` for the late join in ``operators.series.load_images``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{ext}")
        .load(root)
    )
    return files.select("path", "content")
