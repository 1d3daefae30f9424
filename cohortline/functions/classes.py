"""Label and class-score expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def contains_any(text: Column, parts: tuple[str, ...] | list[str]) -> Column:
    """True if the text holds any of the parts (plain substring test, case kept)."""
    hit = F.lit(False)
    for part in parts:
        hit = hit | text.contains(part)
    return hit


def label_part(label: Column, sep: str, index: int) -> Column:
    """The ``index``-th (0-based) part of a separated text; null if there is none."""
    return F.get(F.split(label, re.escape(sep)), F.lit(index))


def label_number(label: Column, sep: str = "_", index: int = 1) -> Column:
    """The ``index``-th part as BIGINT; null where the part is absent or is not an integer."""
    part = label_part(label, sep, index)
    return F.when(part.rlike(INTEGER_TEXT), F.trim(part).try_cast("bigint"))


def map_labels(name: Column, label_dict: Mapping[str, int | None]) -> Column:
    """Class name to class id; null for names that are not in the dictionary."""
    pairs = [F.lit(x) for item in label_dict.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), name).cast("int")


def n_classes(label_dict: Mapping[str, int | None]) -> int:
    """Number of different class ids, missing ids left out."""
    return len({v for v in label_dict.values() if v is not None})


def softmax(logits: Column) -> Column:
    """Class probabilities of an array of logits; the maximum is taken off first."""

    def powers(values: Column) -> Column:
        return let(F.array_max(values), lambda top: F.transform(values, lambda x: F.exp(x - top)))

    def shares(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(values, lambda x: x / t))

    return let(let(logits.cast("array<double>"), powers), shares)


def argmax(values: Column) -> Column:
    """0-based index of the largest element; the first one wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def log_probability(logits: Column, index: Column) -> Column:
    """Log of the softmax probability at ``index``, by the log-sum-exp form."""
    values = logits.cast("array<double>")
    return let(
        F.array_max(values),
        lambda top: F.get(values, index)
        - top
        - F.ln(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))),
    )
