"""Scans of whole texts: sensitive patterns, clause tags, unfinished markers.

All are narrow: a text is split and searched where it lies, and only the hits move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of sensitive text; the syntax is common to Java and RE2.
SENSITIVE_PATTERNS = {
    "mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+[0-9]{1,3} \([0-9]{2,4}\) [0-9]{3}-[0-9]{4}",
    "long number": r"[0-9]{16}",
    "address": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "token": r"token = \"[0-9a-f]+\"",
}

#: Text that every match of a rule contains: lines without it skip the rule.
SENSITIVE_LITERALS = {"mail": "@", "phone": "+", "address": ".", "token": "token = "}

#: Clause tags: [[standard:clause]], or several separated by commas or "and".
CLAUSE_TAG = r"\[\[([^\[\]]+)\]\]"
#: A tag inside the brackets: a standard and a clause; whatever else stands there is comment.
CLAUSE = r"[A-Za-z0-9][A-Za-z0-9_-]*:[A-Za-z0-9]+(?:[._-][A-Za-z0-9]+)*"


def text_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, line_no, line)`` with lines counted from 1."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("at", "line")).select(
        key, (F.col("at") + 1).alias("line_no"), "line"
    )


def sensitive_scan(
    docs: DataFrame,
    patterns: Mapping[str, str] = SENSITIVE_PATTERNS,
    value_exceptions: DataFrame | Sequence[str] | None = None,
    file_exceptions: DataFrame | None = None,
    key: str = "doc_id",
    literals: Mapping[str, str] | None = None,
    directory_exceptions: Sequence[str] = (),
) -> DataFrame:
    """Every match ``(doc_id, line_no, rule, value)`` that no exception allows.

    ``literals`` names, for some rules, a text that each match contains; a plain search for it
    spares most lines the pattern (the default fits the default patterns). Exceptions are taken off
    the hits, which are few and carry no text: ``value_exceptions`` is a list of values or a table
    with ``value``, ``file_exceptions`` a table with the document key. Documents whose key is a path below one of
    ``directory_exceptions`` are not scanned.
    """
    for directory in directory_exceptions:
        docs = docs.where(~F.col(key).startswith(directory.rstrip("/") + "/"))
    if literals is None:
        literals = SENSITIVE_LITERALS if patterns is SENSITIVE_PATTERNS else {}

    def occurs(rule: str, regex: str) -> Column:
        match = F.col("line").rlike(regex)
        return F.col("line").contains(literals[rule]) & match if rule in literals else match

    lines = text_lines(docs, key=key).where(reduce(Column.__or__, [occurs(r, x) for r, x in patterns.items()]))

    def matches(rule: str, regex: str) -> Column:
        values = F.regexp_extract_all(F.col("line"), F.lit(regex), F.lit(0))
        return F.transform(values, lambda v: F.struct(F.lit(rule).alias("rule"), v.alias("value")))

    found = F.concat(*[matches(rule, regex) for rule, regex in patterns.items()])
    hits = lines.select(key, "line_no", F.inline(found))
    if isinstance(value_exceptions, DataFrame):
        hits = hits.join(value_exceptions.select("value").distinct(), "value", "left_anti")
    elif value_exceptions:
        hits = hits.where(~F.col("value").isin(*value_exceptions))
    if file_exceptions is not None:
        hits = hits.join(file_exceptions.select(key).distinct(), key, "left_anti")
    return hits.select(key, "line_no", "rule", "value")


def sensitive_counts(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Hits, documents and different values per rule."""
    return hits.groupBy("rule").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.count_distinct(key).alias("n_docs"),
        F.count_distinct("value").alias("n_values"),
    )


def extract_tags(
    docs: DataFrame,
    pattern: str = CLAUSE_TAG,
    separator: str | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Every tag ``(doc_id, tag)`` in the first group of the pattern.

    Tags are of the form ``standard:clause``, however they are parted; with a ``separator`` all parts between separators are tags.
    """
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    found = F.transform(matches, lambda m: F.split(m, separator) if separator else F.regexp_extract_all(m, F.lit(CLAUSE), F.lit(0)))
    parts = F.flatten(found)
    tags = docs.select(key, F.explode(parts).alias("tag")).select(key, F.trim("tag").alias("tag"))
    return tags.where(F.col("tag") != "")


def tag_coverage(tags: DataFrame, checklist: DataFrame) -> DataFrame:
    """Tags per checklist clause, zero included; tags are counted before the join."""
    counts = tags.groupBy(F.col("tag").alias("clause")).agg(F.count(F.lit(1)).alias("n_tags"))
    return checklist.join(counts, "clause", "left").withColumn("n_tags", F.coalesce("n_tags", F.lit(0)))


def gap_audit(tags: DataFrame, checklist: DataFrame) -> DataFrame:
    """Checklist clauses without any tag."""
    return checklist.join(tags.select(F.col("tag").alias("clause")).distinct(), "clause", "left_anti")


def unfinished_markers(docs: DataFrame, marker: str = "TODO", text: str = "text", key: str = "doc_id") -> DataFrame:
    """Lines with the marker and how often it occurs in them."""
    lines = text_lines(docs.where(F.col(text).contains(marker)), text, key)
    times: Column = F.size(F.split(F.col("line"), _quoted(marker), -1)) - 1
    return lines.where(F.col("line").contains(marker)).select(key, "line_no", "line", times.alias("n_markers"))


def _quoted(text: str) -> str:
    """The text as a regular expression that matches itself."""
    return "".join(c if c.isalnum() or c == "_" else f"[{c}]" if c not in "^[]\\" else f"\\{c}" for c in text)
