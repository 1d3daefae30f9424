"""Text scans over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import textscan as ts
from .. import driver_tables as dt
from .registry import query

PATTERNS = ts.SENSITIVE_PATTERNS


def _quoted(regex: str) -> str:
    return "'" + regex.replace("'", "''") + "'"


LINES = """
lines AS (
  SELECT doc_id, CAST(i AS INTEGER) AS line_no, all_lines[i] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM documents),
       LATERAL (SELECT unnest(range(1, len(all_lines) + 1)) AS i)
)"""

HITS = (
    "WITH "
    + LINES
    + ", hits AS ("
    + " UNION ALL ".join(
        f"""SELECT doc_id, line_no, '{rule}' AS rule, unnest(regexp_extract_all(line, {_quoted(regex)})) AS value FROM lines"""
        for rule, regex in PATTERNS.items()
    )
    + ")"
)


@query(HITS + " SELECT doc_id, line_no, rule, value FROM hits")
def sensitive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.sensitive_scan(dt.docs(spark, sf_dir))


@query(
    HITS
    + """ SELECT doc_id, line_no, rule, value FROM hits
          WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)
            AND value NOT IN (SELECT value FROM hits WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))"""
)
def sensitive_scan_with_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed files: documents of low quality. Allowed values: those found in toxic documents."""
    docs, labels = dt.docs(spark, sf_dir), dt.table(spark, sf_dir, "labels")
    allowed_files = labels.where(F.col("quality") == 0).select("doc_id")
    toxic = docs.join(labels.where(F.col("toxic") == 1).select("doc_id"), "doc_id", "left_semi")
    return ts.sensitive_scan(
        docs, value_exceptions=ts.sensitive_scan(toxic).select("value"), file_exceptions=allowed_files
    )


@query(
    HITS
    + """ SELECT rule, count(*) AS n_hits, count(DISTINCT doc_id) AS n_docs, count(DISTINCT value) AS n_values
          FROM hits GROUP BY 1"""
)
def sensitive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.sensitive_counts(ts.sensitive_scan(dt.docs(spark, sf_dir)))


# No clause tags occur in the driver's texts; link targets and style rules of pages stand in.
HREF = r'href="([^"]*)"'
TAGS = f"""
WITH tags AS (
  SELECT page_id, trim(unnest(flatten([string_split(m, ',') FOR m IN regexp_extract_all(html, '{HREF}', 1)]))) AS tag
  FROM pages
), kept AS (SELECT page_id, tag FROM tags WHERE tag <> '')
"""


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.extract_tags(dt.table(spark, sf_dir, "pages"), HREF, ",", "html", "page_id")


@query(TAGS + "SELECT page_id, tag FROM kept")
def extract_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags(spark, sf_dir)


CHECKLIST = "SELECT DISTINCT '/' || unnest(string_split(text, ' ')) AS clause FROM benchmark"


def checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = dt.table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("word"))
    return words.select(F.concat(F.lit("/"), "word").alias("clause")).distinct()


@query(TAGS + f"SELECT clause FROM ({CHECKLIST}) WHERE clause NOT IN (SELECT tag FROM kept)")
def gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.gap_audit(tags(spark, sf_dir), checklist(spark, sf_dir))


@query(
    TAGS
    + f"""SELECT c.clause, count(k.tag) AS n_tags FROM ({CHECKLIST}) c LEFT JOIN kept k ON k.tag = c.clause GROUP BY 1"""
)
def tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.tag_coverage(tags(spark, sf_dir), checklist(spark, sf_dir))


@query(
    "WITH "
    + LINES
    + """ SELECT doc_id, line_no, line, CAST((length(line) - length(replace(line, 'icense', ''))) // 6 AS INTEGER) AS n_markers
          FROM lines WHERE contains(line, 'icense')"""
)
def marker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.unfinished_markers(dt.docs(spark, sf_dir), "icense")
