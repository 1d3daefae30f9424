"""Items in a hierarchy: who lies above whom, by doubling of path lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import settle


def ancestors(edges: DataFrame, item: str = "item", parent: str = "parent", by: str | None = None) -> DataFrame:
    """All pairs (item, ancestor, distance) of a table of items and their parents; distance is the shortest.

    Rows without an item or a parent are no edges; repeated rows count once; an item may have several parents. Round k joins the
    walks of 2^k steps with all shorter ones, so a hierarchy of depth d takes log2(d) rounds, each written once. An
    item that lies on a cycle is an ancestor of itself. ``by`` names a column, such as a project, that keeps
    hierarchies apart.
    """
    scope = [by] if by else []
    both = [*scope, "item", "ancestor"]
    given = edges.where(F.col(item).isNotNull() & F.col(parent).isNotNull())
    steps = settle(given.select(*scope, F.col(item).alias("item"), F.col(parent).alias("ancestor")).distinct())
    pairs, known = steps.withColumn("distance", F.lit(1).cast("bigint")), steps.count()
    length = 1
    while known:
        above = [F.col(c) for c in scope]
        # A walk of `length` steps from item to middle, and on from there.
        first = steps.select(*above, "item", F.col("ancestor").alias("middle"))
        further = pairs.select(*above, F.col("item").alias("middle"), "ancestor", (F.col("distance") + length).alias("distance"))
        longer = first.join(further, [*scope, "middle"]).select(*both, "distance")
        pairs = settle(pairs.unionByName(longer).groupBy(*both).agg(F.min("distance").alias("distance")))
        found = pairs.count()
        if found == known:
            break
        known = found
        second = steps.select(*above, F.col("item").alias("middle"), "ancestor")
        steps = settle(first.join(second, [*scope, "middle"]).select(*both).distinct())
        length *= 2
    return pairs


def cycle_items(pairs: DataFrame) -> DataFrame:
    """Items on a cycle, from the pairs of ``ancestors``."""
    return pairs.where(F.col("item") == F.col("ancestor")).select(*[c for c in pairs.columns if c not in ("ancestor", "distance")])


def roll_up(facts: DataFrame, pairs: DataFrame, totals: dict[str, str], item: str = "item", by: str | None = None) -> DataFrame:
    """Sums of facts over each item and all items below it: ``totals`` maps a new column to the summed one.

    Facts are summed by item first, so an item with most of the facts is one row in the join. A fact on a cycle counts once for
    every item of the cycle. Facts without an item are left out.
    """
    scope = [by] if by else []
    own = facts.where(F.col(item).isNotNull()).groupBy(*scope, F.col(item).alias("item")).agg(
        *[F.sum(c).alias(new) for new, c in totals.items()]
    )
    others = pairs.where(F.col("item") != F.col("ancestor")).select(*scope, "item", "ancestor")
    above = own.join(others, [*scope, "item"]).select(*scope, F.col("ancestor").alias("item"), *totals)
    return own.unionByName(above).groupBy(*scope, "item").agg(*[F.sum(c).alias(c) for c in totals])
