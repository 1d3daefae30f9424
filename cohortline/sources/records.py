"""Record tables (requirements, tests, changes, risks ...) as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RECORDS

CORRUPT = "corrupt_line"


def read_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of one kind with its fixed schema; absent keys and nulls are both NULL.

    Lines that are no record of the kind are not among the rows; ``corrupt_records`` returns them.
    """
    return _lines(spark, path, kind).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The lines that ``read_records`` could not read, as ``corrupt_line``."""
    return _lines(spark, path, kind).where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def _lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    if kind not in RECORDS:
        raise ValueError(f"unknown record kind {kind!r}; known: {', '.join(sorted(RECORDS))}")
    schema = T.StructType([*RECORDS[kind].fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return spark.read.text(path).where(F.trim("value") != "").select(parsed.alias("record")).select("record.*")
