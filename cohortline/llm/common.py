"""Helpers that the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII characters that part words: space, tab, line feed, vertical tab, form feed, return.
BLANKS = b" \t\n\r\x0b\x0c"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Bytes of an Arrow batch; a worker holds a few of them at once.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches below BATCH_BYTES, since texts can be long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = str(spark.conf.get(name)).lower().removesuffix("b")
    if not given.isdigit() or not 0 < int(given) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def id_and_text(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The id and the whole text (null as empty) under fixed names, so that other columns cannot clash."""
    bound_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def blocks_of(
    batches: Iterator[pa.RecordBatch], size_of: Callable[[pa.RecordBatch], list[int]], most: int
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose rows sum to about ``most``; a larger single row comes alone."""
    for batch in batches:
        start, total = 0, 0
        for i, size in enumerate(size_of(batch)):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)
        batch = None
    give_back()


def give_back() -> None:
    """Return a worker's free memory to the system, since it waits for its next task beside others that need it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_sizes(batch: pa.RecordBatch, name: str = "text") -> list[int]:
    """Bytes of each row's text."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()


def raw(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes, not decoded."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def buckets_for(rows: int, each: int) -> int:
    """A power of two of buckets that hold about ``each`` rows."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows) / each)))


def list_bounds(lists: pa.ListArray) -> np.ndarray:
    """The n + 1 bounds of the lists among the values that ``flatten`` gives."""
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0]


def gather(
    flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``order`` names, one after another, and where each of them ends."""
    sizes = lengths[order]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(starts[order] - (ends - sizes), sizes)
    return flat[at], ends
