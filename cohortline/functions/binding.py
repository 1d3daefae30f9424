"""Name a sub-expression so that it is computed once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda body is evaluated per element, so an array maximum written inside one would be
    recomputed for every element. Passing through a one-element array binds it to a variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
