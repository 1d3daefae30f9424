"""Mixing sources to target weights (operator 9).

The words of each source are one stream, packed into blocks of ``BLOCK_WORDS`` words (the last one may be shorter). Sources
weigh 1, 2, 3, repeating, in code point order (null last), share the sum of all sizes by weight, and stop at
``MOST_TIMES`` their size, the excess being shared again. A source's target is a number of draws: whole passes over
its blocks and a part of one. Every output shard draws its counts per source from a multinomial; draw j of a source
takes block P(j mod n), where P is that source's and pass's pseudorandom permutation of its n block numbers. Draws beyond a
source's number are left out and a last shard makes up missing ones, so the totals are exact to a block and no block is taken
more often than ``MOST_TIMES``. Blocks, draws and documents meet by (source, block).

All numbers depend on ids, sizes and the seed only, not on partitions: reruns agree. Null and empty texts have size 0 and
take nothing. Ties in the order of a stream (equal ids) go by size, then text hash; equal rows are interchangeable. Very long documents span
many blocks. A null source is a source of its own. An empty table gives no rows. Columns other than the named ones are not read, except where
``mixed_texts`` hands all on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import settle
from .common import blocks_of, bound_batches, buckets_for, raw, text_sizes

BLOCK_WORDS = 64
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
MOST_TIMES = 3
WEIGHTS = (1, 2, 3)
SEED = 20_240_101
#: Draws of one output shard.
SHARD_DRAWS = 4096
#: Documents of a source's stream that one task orders, about.
STREAM_ROWS = 2048


def word_counts(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size and a hash of the text for every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, text_sizes, 8 << 20):
            sizes = [len(x.split()) for x in raw(block)]
            names = ("doc_id", "source", "text_hash")
            yield pa.RecordBatch.from_arrays(
                [*[block.column(c) for c in names], pa.array(sizes, pa.int64())], names=[*names, "size"]
            )

    bound_batches(df.sparkSession)
    docs = df.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(count, f"doc_id {kind}, source string, text_hash bigint, size bigint")


def shared_targets(sizes: list[int], weights: list[int], most_times: int = MOST_TIMES) -> list[float]:
    """Targets by weight that sum to the sum of the sizes; none is above ``most_times`` its size."""
    total = float(sum(sizes))
    target = [0.0] * len(sizes)
    free = [i for i, n in enumerate(sizes) if n > 0]
    left = total
    while free:
        by_weight = left / sum(weights[i] for i in free)
        full = [i for i in free if by_weight * weights[i] > most_times * sizes[i]]
        if not full:
            for i in free:
                target[i] = by_weight * weights[i]
            break
        for i in full:
            target[i] = float(most_times * sizes[i])
            left -= target[i]
        free = [i for i in free if i not in set(full)]
    return target


def draws_for(target: float, size: int, block: int = BLOCK_WORDS, most_times: int = MOST_TIMES) -> tuple[int, int]:
    """Number of blocks and of draws: whole passes, and blocks for the words that are left."""
    n = -(-size // block)
    if n == 0:
        return 0, 0
    passes = min(most_times, int(target // size))
    part = min(n, round((target - passes * size) / (size / n))) if passes < most_times else 0
    return n, passes * n + part


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: four Feistel rounds on the next even number of bits, walked
    until the number is below n."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(1, 1 << 63, 4, dtype=np.uint64) | np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= k
            left, right = right, left ^ ((mixed >> np.uint64(33)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def streams(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``start`` in their source's stream, and a table with the size of each source.

    A stream is ordered by a hash of the id, so its leading bits deal it evenly, whatever the source's share.
    """
    rows = counts.agg(F.count(F.lit(1))).first()[0]
    bits = buckets_for(rows, STREAM_ROWS).bit_length() - 1
    key = F.xxhash64(F.col("doc_id").cast("string"), F.col("size"), F.col("text_hash"))
    placed = counts.withColumn("order_key", key).withColumn("bucket", F.shiftrightunsigned("order_key", 64 - bits) if bits else F.lit(0).cast("bigint"))
    inside = Window.partitionBy("source", "bucket").orderBy("order_key", "doc_id", "size", "text_hash")
    here = placed.withColumn(
        "inside", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("of"), F.col("bucket").alias("at"),
        F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("before"),
    )
    same = here["source"].eqNullSafe(offsets["of"]) & (here["bucket"] == offsets["at"])
    started = here.join(offsets, same).withColumn("start", F.col("before") + F.col("inside"))
    totals = sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    return started.select("doc_id", "source", "text_hash", "size", "start"), totals


def targets(totals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: number, size, target, blocks and draws. The sources' names and sizes come to the driver."""
    spark = totals.sparkSession
    found = [(r["source"], int(r["source_size"])) for r in totals.collect()]
    # UTF-8 order is code point order.
    found.sort(key=lambda x: (x[0] is None, (x[0] or "").encode("utf-8", "surrogatepass")))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))]
    target = shared_targets([n for _, n in found], weights)
    rows = [(s, i, n, t, *draws_for(t, n, block)) for i, ((s, n), t) in enumerate(zip(found, target))]
    return spark.createDataFrame(
        rows, "source string, number int, source_size bigint, target double, n_blocks bigint, n_draws bigint"
    )


def draws(table: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per draw: shard, place in it, number of the source, block."""
    sources = table.orderBy("number").collect()
    quota = np.array([r["n_draws"] for r in sources], np.int64)
    n_blocks = [r["n_blocks"] for r in sources]
    total = int(quota.sum())
    shards = -(-total // SHARD_DRAWS)
    spark = table.sparkSession
    if not total:
        return spark.createDataFrame([], "shard bigint, number int, pass int, block bigint")
    share = quota / total

    def counts(shard: int) -> np.ndarray:
        return np.random.default_rng((seed, shard)).multinomial(SHARD_DRAWS, share)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column("id")[i].as_py()
                before = np.array(batch.column("before")[i].as_py(), np.int64)
                n = quota - np.minimum(before, quota) if shard == shards else counts(shard)
                number, passes, block = [], [], []
                for s in np.flatnonzero(n).tolist():
                    last = min(int(before[s] + n[s]), int(quota[s]))
                    # The last shard may have to make up many draws of a source: never more than a few standard errors.
                    j = np.arange(min(int(before[s]), last), last, dtype=np.int64)
                    for p in np.unique(j // n_blocks[s]).tolist() if len(j) else []:
                        mine = j[j // n_blocks[s] == p] % n_blocks[s]
                        block.append(permuted(mine, n_blocks[s], (seed * 1_000_003 + s) * 7 + p))
                        number.append(np.full(len(mine), s, np.int32))
                        passes.append(np.full(len(mine), p, np.int32))
                if block:
                    taken = np.concatenate(block)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(taken), shard, np.int64)), pa.array(np.concatenate(number)),
                         pa.array(np.concatenate(passes)), pa.array(taken)],
                        names=["shard", "number", "pass", "block"],
                    )

    # Per shard the draws of each source before it: shards of shards, so that no task adds up all of them.
    span = max(1, int(np.sqrt(shards)))
    parts = -(-shards // span)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("id").to_pylist():
                n = sum((counts(s) for s in range(part * span, min(shards, (part + 1) * span))), np.zeros(len(quota), np.int64))
                yield pa.RecordBatch.from_pydict({"part": [part], "n": [n.tolist()]})

    tasks = max(1, min(parts, 4 * spark.sparkContext.defaultParallelism))
    # sqrt(shards) rows of one number per source come to the driver.
    sums = {r["part"]: r["n"] for r in spark.range(0, parts, 1, tasks).mapInArrow(summed, "part bigint, n array<bigint>").collect()}
    upto = np.zeros((parts + 1, len(quota)), np.int64)
    for part in range(parts):
        upto[part + 1] = upto[part] + np.array(sums[part], np.int64)

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("id").to_pylist():
                before = upto[part].copy()
                for shard in range(part * span, min(shards, (part + 1) * span)):
                    yield pa.RecordBatch.from_pydict({"id": [shard], "before": [before.tolist()]})
                    before += counts(shard)
                if part == parts - 1:
                    yield pa.RecordBatch.from_pydict({"id": [shards], "before": [before.tolist()]})

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from drawn(started(batches))

    return spark.range(0, parts, 1, tasks).mapInArrow(both, "shard bigint, number int, pass int, block bigint")


def segments(started: DataFrame, table: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Each document's stretches by block: source number, block, and the words from ``low`` to ``high`` of the document."""
    numbers = table.select(F.col("source").alias("of"), "number")
    named = started.where("size > 0").join(numbers, started["source"].eqNullSafe(numbers["of"])).drop("of")
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = named.withColumn("block", F.explode(F.sequence(first, last)))
    return cut.withColumns(
        {
            "low": F.greatest(F.lit(0), F.col("block") * block - F.col("start")),
            "high": F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start")),
        }
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with ``start`` in their stream, the table of sources, and the taken stretches: (source number, start) of
    the document, ``pass``, ``shard``, low, high."""
    started, totals = streams(settle(word_counts(df, id_col, text_col, source_col)))
    started, table = settle(started), targets(totals, block)
    # The draws come from a short range of shards, which must not pass for a small table: no broadcast.
    taken = segments(started, table, block).join(draws(table, seed).hint("merge"), ["number", "block"])
    kept = ("number", "start", "size", "doc_id", "text_hash", "shard", "pass", "block", "low", "high")
    return started, table, taken.select(*kept)


def mixed_counts(df: DataFrame, **names: str) -> DataFrame:
    """doc_id, source, size, source_size, target and ``taken`` (words the mix takes, repeats counted) of every row."""
    started, table, taken = mix(df, **names)
    words = taken.groupBy("number", "start").agg(F.sum(F.col("high") - F.col("low")).alias("words"))
    numbers = table.select(F.col("source").alias("of"), "number", "source_size", "target")
    rows = started.join(numbers, started["source"].eqNullSafe(numbers["of"])).drop("of")
    # An empty document shares its start with the next one; it takes nothing.
    keyed = rows.withColumn("place", F.when(F.col("size") > 0, F.col("start")))
    found = keyed.join(words.withColumnRenamed("start", "place"), ["number", "place"], "left")
    return found.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("bigint").alias("taken")
    )


def cut_words(text: bytes, stretches: list[tuple[int, int]], size: int) -> bytes:
    """The words of the stretches with the white space behind them; the whole text if they cover it."""
    merged: list[list[int]] = []
    for low, high in sorted(stretches):
        if merged and merged[-1][1] == low:
            merged[-1][1] = high
        else:
            merged.append([low, high])
    if merged == [[0, size]]:
        return text
    at = [m.start() for m in WORD.finditer(text)] + [len(text)]
    return b"".join(text[at[low] : at[high]] for low, high in merged)


def mixed_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as rows of ``df``: one per document and pass, its text cut to the blocks drawn in that pass.

    Equal rows (id, source, text) are interchangeable; one of them lends its other columns to all.
    """
    keys = ["_id", "_source", "_hash"]
    _, table, taken = mix(df, id_col, text_col, source_col, block, seed)
    names = table.select("number", F.col("source").alias("_source"))
    hashes = taken.join(names, "number")
    # At most as many stretches as the document has blocks.
    drawn = hashes.groupBy("doc_id", "_source", "text_hash", "start", "size", "pass").agg(
        F.collect_list(F.struct("low", "high")).alias("stretches")
    ).toDF("_id", "_source", "_hash", "_start", "_size", "_pass", "_stretches")
    keyed = df.withColumns(
        {
            "_id": F.col(id_col),
            "_source": F.col(source_col).cast("string"),
            "_hash": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
        }
    )
    one = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    single = keyed.withColumn("_n", one).where("_n = 1").drop("_n")
    same = [single[k].eqNullSafe(drawn[k]) for k in keys]
    rows = single.join(drawn, same[0] & same[1] & same[2]).select(
        *[single[c] for c in df.columns], "_stretches", "_size"
    )

    names_in = df.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names_in.index(text_col)
        for batch in batches:
            spans = batch.column("_stretches").to_pylist()
            texts = [
                cut_words(text, [(s["low"], s["high"]) for s in x], size)
                for text, x, size in zip(raw(batch, text_col), spans, batch.column("_size").to_pylist())
            ]
            columns = [batch.column(c) for c in names_in]
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names_in)

    return rows.mapInArrow(cut, df.schema)
