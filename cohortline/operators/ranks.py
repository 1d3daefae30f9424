"""Exact ranks and running totals without putting all rows, or one group, in one task.

Two ways, by what is known about the order:

* ids ordered by a digest are spread evenly, so the leading digits of the digest are a
  bucket of known size (``hash_rank``, ``hash_threshold``);
* any other order is cut by ``repartitionByRange`` and the pieces are written once
  (``range_pieces``), since a piece number must not change between its two uses.

In both, totals per bucket or piece are summed to offsets, and the rank is offset + rank inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_number
from ..sources.storage import settle

SALTS = 64
#: Leading hex digits of a digest that make a bucket: at most 65,536 counts, whatever the number of rows, and no
#: count of the rows while a plan is built. A bucket that is ranked holds that share of the rows.
DIGITS = 4


def hash_rank(
    df: DataFrame,
    digest: str,
    ties: Sequence[str],
    group: Sequence[str] = (),
    digits: int = DIGITS,
    name: str = "position",
) -> DataFrame:
    """1-based rank by (digest, ties) inside each group.

    Rows shuffle once, by (group, bucket); the offsets are at most 16**digits rows per group.
    """
    keys = [*group, "bucket"]
    placed = df.withColumn("bucket", hash_number(F.col(digest), 1, digits))
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bucket"))
    upto = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("n_bucket").over(upto), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(digest, *ties))
    return (
        placed.withColumn("inside", inside)
        .join(offsets, keys)
        .withColumn(name, F.col("before") + F.col("inside"))
        .drop("bucket", "before", "inside")
    )


def hash_thresholds(
    df: DataFrame, digest: str, tie: str | Sequence[str], ranks: dict[str, Column], digits: int = DIGITS
) -> DataFrame:
    """The (digest, tie) pair at each asked rank: rows ``(cut, digest, tie)``.

    ``ranks`` maps a cut name to an expression on ``n``, the number of rows. Only the few buckets
    that hold a cut are ranked; all other rows are just counted.
    """
    ties = [tie] if isinstance(tie, str) else list(tie)
    placed = df.select(digest, *ties, hash_number(F.col(digest), 1, digits).alias("bucket"))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_bucket"))
    # At most 16**digits rows reach this window.
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    totals = counts.select(
        "bucket",
        F.sum("n_bucket").over(upto).alias("through"),
        (F.sum("n_bucket").over(upto) - F.col("n_bucket")).alias("before"),
        F.sum("n_bucket").over(everything).alias("n"),
    )
    cuts = totals.select(
        "bucket",
        "before",
        "through",
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("cut"), r.cast("bigint").alias("rank")) for c, r in ranks.items()])
        ).alias("c"),
    ).where((F.col("c.rank") > F.col("before")) & (F.col("c.rank") <= F.col("through")))
    # One row per cut, so this side is known to be tiny and the counted rows stay in place.
    local = placed.join(F.broadcast(cuts.select("bucket", "before", "c.cut", "c.rank")), "bucket")
    place = F.row_number().over(Window.partitionBy("cut").orderBy(digest, *ties))
    return (
        local.withColumn("place", place)
        .where(F.col("place") == F.col("rank") - F.col("before"))
        .select("cut", digest, *ties)
    )


def first_by_hash(df: DataFrame, digest: str, ties: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest (digest, ties), exactly, for any ``n``; of equal rows any.

    Rows are counted per bucket; whole buckets before the cut stay as they are, and only the bucket with the
    cut is ranked.
    """
    placed = df.withColumn("bucket", hash_number(F.col(digest), 1, DIGITS))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_bucket"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("bucket").alias("at"), F.coalesce(F.sum("n_bucket").over(upto), F.lit(0)).alias("before"))
    # The last bucket of which rows are wanted: one row.
    cut = before.where(F.col("before") < n).agg(F.max(F.struct("before", "at")).alias("cut")).scalar()
    sure = placed.where(F.col("bucket") < cut.getField("at")).select(*df.columns)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(digest, *ties))
    edge = placed.where(F.col("bucket") == cut.getField("at")).withColumn("place", place)
    return sure.unionByName(edge.where(F.col("place") <= n - cut.getField("before")).select(*df.columns))


def first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "place"
) -> DataFrame:
    """The first ``k`` rows of each group with their 1-based place.

    A group is always cut into salts first, each of which keeps its first ``k`` rows, so a group of any size is
    spread and at most salts * k of its rows meet.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SALTS))
    salted = Window.partitionBy(*group, "salt").orderBy(*order)
    few = (
        df.withColumn("salt", salt)
        .withColumn(name, F.row_number().over(salted))
        .where(F.col(name) <= k)
        .drop("salt", name)
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return few.withColumn(name, place).where(F.col(name) <= k)


def range_pieces(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with a ``piece`` number that rises with (group, order), written once.

    A group of any size is spread over as many pieces as it needs.
    """
    cut = df.repartitionByRange(*[F.col(c) for c in (*group, *order)])
    return settle(cut.withColumn("piece", F.spark_partition_id()))


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], totals: dict[str, str], extra: dict[str, str] | None = None
) -> DataFrame:
    """Running sums of columns along ``order`` inside each group, current row included.

    ``totals`` maps a new column to the summed one. ``extra`` maps a new column to one whose value
    in the next row of the group is wanted. (group, order) must be unique. Rows whose group is null are a group.
    """
    extra = extra or {}
    # One struct, since a null column equals nothing in a join, but null fields of structs are equal.
    pieces = range_pieces(df.withColumn("group_key", F.struct(F.lit(0), *group)), group, order)
    keys = ["group_key", "piece"]
    first = F.min_by(F.struct(*extra.values()), F.struct(*order)) if extra else F.lit(None).cast("int")
    sums = pieces.groupBy(*keys).agg(
        *[F.sum(col).alias(f"piece_{new}") for new, col in totals.items()], first.alias("first_row")
    )
    # One row per piece and group: the number of pieces plus the number of groups.
    earlier = Window.partitionBy("group_key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("group_key").orderBy("piece")
    offsets = sums.select(
        *keys,
        *[F.coalesce(F.sum(f"piece_{new}").over(earlier), F.lit(0)).alias(f"before_{new}") for new in totals],
        F.lead("first_row").over(later).alias("next_piece"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = pieces
    for new, col in totals.items():
        out = out.withColumn(f"inside_{new}", F.sum(col).over(upto))
    for new, col in extra.items():
        out = out.withColumn(f"next_{new}", F.lead(col).over(inside))
    out = out.join(offsets, keys)
    for new in totals:
        out = out.withColumn(new, F.col(f"before_{new}") + F.col(f"inside_{new}"))
    for new, col in extra.items():
        out = out.withColumn(new, F.coalesce(f"next_{new}", F.col("next_piece").getField(col)))
    return out.select(*df.columns, *totals, *extra)


def ordered_position(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """1-based ``position`` along ``order`` inside each group; equal rows in any order."""
    pieces = range_pieces(df, group, order)
    keys = [*group, "piece"]
    counts = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_piece"))
    earlier = Window.partitionBy(*group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("n_piece").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        pieces.withColumn("inside", inside)
        .join(offsets, keys)
        .withColumn("position", F.col("before") + F.col("inside"))
        .select(*df.columns, "position")
    )
