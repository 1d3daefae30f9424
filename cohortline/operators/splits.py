"""Samples, splits and training shards that depend on ids only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_number, hash_unit, stable_hash
from ..functions.permute import permuted
from .ranks import first_by_hash, hash_rank, hash_thresholds

TRAIN, VALIDATION, TEST = "train", "validation", "test"
SPLITS = (TRAIN, VALIDATION, TEST)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def bounded_sample(
    df: DataFrame, n: int, seed: object = 42, key: str | Sequence[str] = "subject_key"
) -> DataFrame:
    """``n`` random rows if 0 < n < total, else all; the same rows for the same seed."""
    if n <= 0:
        return df
    return first_by_hash(df.withColumn("draw", stable_hash(seed, *_keys(key))), "draw", _keys(key), n).drop("draw")


def preview_sample(
    split: DataFrame, n: int = 24, seed: object = 42, key: str | Sequence[str] = "subject_key"
) -> DataFrame:
    """At most ``n`` training samples for review."""
    return bounded_sample(split.where(F.col("split") == TRAIN), n, seed, key)


def split_samples(
    df: DataFrame,
    seed: object = 42,
    fractions: Sequence[float] = (0.5, 0.25, 0.25),
    exact: bool = False,
    key: str | Sequence[str] = "subject_key",
) -> DataFrame:
    """Add a ``split`` column: train, validation or test.

    The default compares the digest of the id with fixed thresholds: no shuffle, and a subject
    keeps its split when others are added. ``exact`` gives the exact sizes of two successive cuts
    (the later part of each cut rounds up); it counts digests per bucket, ranks only the rows of
    the buckets that hold a cut, and then compares every row with the two cut points.
    """
    train, validation, test = fractions
    if min(fractions) < 0 or abs(train + validation + test - 1.0) > 1e-9:
        raise ValueError("fractions are three shares that add up to 1")
    digest = stable_hash(seed, *_keys(key))
    if not exact:
        draw = hash_unit(digest)
        return df.withColumn(
            "split",
            F.when(draw < train, TRAIN).when(draw < train + validation, VALIDATION).otherwise(TEST),
        )
    hashed = df.withColumn("draw", digest)
    held = F.ceil(F.round(F.col("n") * F.lit(1 - train), 9))
    share = test / (validation + test) if validation + test > 0 else 0.0
    cuts = {
        TRAIN: F.col("n") - held,
        VALIDATION: F.col("n") - F.ceil(F.round(held * F.lit(share), 9)),
    }
    me = F.struct("draw", *_keys(key))
    found = hash_thresholds(hashed, "draw", _keys(key), cuts)
    last = found.agg(
        F.struct(*[F.max(F.when(F.col("cut") == cut, me)).alias(cut) for cut in cuts]).alias("last")
    ).scalar()
    # No row has rank 0: such a cut point is null and the comparison falls through.
    return hashed.withColumn(
        "split",
        F.when(me <= last.getField(TRAIN), TRAIN).when(me <= last.getField(VALIDATION), VALIDATION).otherwise(TEST),
    ).drop("draw")


def held_out_ids(split: DataFrame, key: str | Sequence[str] = "subject_id") -> DataFrame:
    """Ids of the test split; over several projects name the project as well."""
    return split.where(F.col("split") == TEST).select(*_keys(key))


def training_shards(
    df: DataFrame,
    batch_size: int,
    n_shards: int,
    seed: object = 42,
    epoch: int | None = None,
    key: str | Sequence[str] = "subject_key",
) -> DataFrame:
    """Add ``shard``, ``position`` (0-based inside the shard) and ``batch``.

    The shard of a sample never changes. With an ``epoch`` the order inside shards is drawn anew
    for it (training); without one it is the same every time (validation and test). Write with
    ``partitionBy('shard')``.
    """
    home = stable_hash(seed, *_keys(key))
    order = home if epoch is None else stable_hash(f"{seed}:{epoch}", *_keys(key))
    placed = df.withColumn("shard", F.pmod(hash_number(home, 9, 8), F.lit(n_shards)).cast("int")).withColumn(
        "draw", order
    )
    ranked = hash_rank(placed, "draw", _keys(key), ["shard"])
    return (
        ranked.withColumn("position", F.col("position") - 1)
        .withColumn("batch", F.floor(F.col("position") / batch_size))
        .drop("draw")
    )


def indexed_shards(
    df: DataFrame, n_shards: int, seed: object = 42, key: str | Sequence[str] = "subject_key"
) -> DataFrame:
    """Add ``shard``, ``index`` (0-based inside the shard, the same every time) and ``shard_rows``.

    Done once, this carries every later order: see ``epoch_order``. The counts are one row per shard.
    """
    home = stable_hash(seed, *_keys(key))
    placed = df.withColumn("shard", F.pmod(hash_number(home, 9, 8), F.lit(n_shards)).cast("int")).withColumn("draw", home)
    ranked = hash_rank(placed, "draw", _keys(key), ["shard"], name="index").withColumn("index", F.col("index") - 1)
    rows = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("shard_rows"))
    return ranked.join(rows, "shard").select(*df.columns, "shard", "index", "shard_rows")


def _order_key(seed: object, epoch: int) -> Column:
    return F.concat_ws(":", F.lit(f"{seed}:{epoch}"), F.col("shard").cast("string"))


def epoch_order(shards: DataFrame, batch_size: int, seed: object = 42, epoch: int = 0) -> DataFrame:
    """The rows of ``indexed_shards`` with the ``position`` and ``batch`` that an epoch gives them inside their shard.

    A keyed bijection of the index: no row needs another, so a new epoch costs no shuffle.
    """
    position = permuted(F.col("index"), F.col("shard_rows"), _order_key(seed, epoch))
    return shards.withColumn("position", position).withColumn("batch", F.floor(F.col("position") / batch_size))


def shard_positions(
    shards: DataFrame, shard: int, positions: Sequence[int], seed: object = 42, epoch: int = 0
) -> DataFrame:
    """The rows at some positions of one shard in an epoch, such as one batch, with ``position``.

    The bijection runs backwards for the asked positions only, and their indexes are looked up: with a table partitioned by
    shard and ordered by index, a read of a few rows.
    """
    spark = shards.sparkSession
    asked = spark.createDataFrame([(shard, int(p)) for p in positions], "shard int, position bigint")
    size = shards.where(F.col("shard") == shard).select("shard", "shard_rows").limit(1)
    wanted = asked.join(size, "shard").where((F.col("position") >= 0) & (F.col("position") < F.col("shard_rows")))
    index = permuted(F.col("position"), F.col("shard_rows"), _order_key(seed, epoch), inverse=True)
    found = wanted.select("shard", "position", index.alias("index"))
    return shards.where(F.col("shard") == shard).join(found, ["shard", "index"]).select(*shards.columns, "position")
