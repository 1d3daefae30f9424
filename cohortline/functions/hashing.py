"""Stable pseudo-random numbers from ids.

``rand()`` depends on how the rows are partitioned, so a lost executor or another cluster size
would change a split. A digest of ``seed:id`` depends on the row alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX32 = float(2**32)


def stable_hash(seed: object, *ids: Column | str) -> Column:
    """Hex digest of the seed and the id columns."""
    cols = [F.col(c) if isinstance(c, str) else c for c in ids]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_number(digest: Column, start: int = 1, digits: int = 8) -> Column:
    """``digits`` hex digits of a digest, from the 1-based ``start``, as a BIGINT."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def hash_unit(digest: Column) -> Column:
    """A digest as a number in [0, 1)."""
    return hash_number(digest) / F.lit(HEX32)


def coin(p: float, seed: object, *ids: Column | str) -> Column:
    """True with probability ``p``, decided by the ids."""
    return hash_unit(stable_hash(seed, *ids)) < F.lit(float(p))
