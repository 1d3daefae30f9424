"""A keyed bijection on 0 .. n-1 as an expression, for any n.

Swap-or-not: a round pairs x with (k - x) mod n and, by a coin that both of the pair share, swaps them or not. Every round
is its own inverse, so the rounds run backwards undo the permutation. No row needs to know another, so an order
is drawn, or one position of it found, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import hash_number

ROUNDS = 40
#: The coin is a polynomial modulo this prime, below 2^31 so that products fit a BIGINT.
PRIME = 2147483647


def _round(x: Column, n: Column, key: Column, number: Column) -> Column:
    digest = F.md5(F.concat_ws(":", key, number.cast("string")))
    k, a, b, c = (hash_number(digest, 1 + 8 * i) for i in range(4))

    def swapped(v: Column) -> Column:
        other = F.pmod(v["k"] % n - x, n)
        # Places beyond the prime fold onto it: the coin stays a function of the pair.
        top = F.greatest(x, other) % PRIME
        coin = ((v["a"] % PRIME * top + v["b"]) % PRIME * top + v["c"]) % PRIME
        return F.when(F.shiftright(coin, 12) % 2 == 1, other).otherwise(x)

    values = F.struct(k.alias("k"), a.alias("a"), b.alias("b"), c.alias("c"))
    return F.get(F.transform(F.array(values), swapped), F.lit(0))


def permuted(x: Column, n: Column, key: Column, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """The place of ``x`` in the order that ``key`` draws of 0 .. n-1; with ``inverse`` which x has place ``x``."""
    numbers = [F.lit(i) for i in range(rounds)]
    order = F.array(*(reversed(numbers) if inverse else numbers))
    return F.aggregate(order, x.cast("bigint"), lambda at, number: _round(at, n.cast("bigint"), key, number))
