"""Writers for logs, manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_missing_log(log: DataFrame, path: str) -> int:
    """Write the missing-data log as CSV and return its number of rows."""
    seen = Observation()
    log.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')
    return seen.get["n"]


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Write the manifest as JSON: one row per statistic, or one nested row."""
    manifest.write.mode("overwrite").json(path)


def write_split_ids(ids: DataFrame, path: str, column: str = "subject_id") -> None:
    """Write one id per line."""
    ids.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a metric table (confusion matrix, class report, best epoch) as parquet or JSON."""
    if fmt not in ("parquet", "json"):
        raise ValueError("fmt is 'parquet' or 'json'")
    report.write.mode("overwrite").format(fmt).save(path)
