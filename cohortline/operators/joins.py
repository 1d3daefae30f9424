"""Outer joins that still split when one key holds a large share of the rows.

Adaptive execution splits a skewed partition on the preserved side of a left join and on both
sides of an inner join, but never on the side that may be padded with nulls, and never in a full
join. Both helpers therefore join inner and add the unmatched rows with anti joins, whose right
side is a distinct key list (partly aggregated before its shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def keep_left(one: DataFrame, many: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join of a table with unique keys to one where a key may repeat very often."""
    keys = [on] if isinstance(on, str) else list(on)
    matched = one.join(many, keys, "inner")
    alone = one.join(many.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def keep_both(one: DataFrame, many: DataFrame, on: str | list[str]) -> DataFrame:
    """Full outer join of a table with unique keys to one where a key may repeat very often."""
    keys = [on] if isinstance(on, str) else list(on)
    orphans = many.join(one.select(*keys), keys, "left_anti")
    return keep_left(one, many, keys).unionByName(orphans, allowMissingColumns=True)
