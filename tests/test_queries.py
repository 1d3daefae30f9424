"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import inspect
import os
import re

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return connect(SF_DIR)


def own(names):
    """Without the queries of the optional part, which has its own tests."""
    return sorted(n for n in names if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_queries_without_sql_give_rows(spark):
    rest = own(set(entry.queries()) - set(entry.oracle_sql()))
    assert rest == ["score_embeddings"]
    scored = entry.queries()["score_embeddings"](spark, SF_DIR)
    hit = sum(r.label == r.pred for r in scored.collect())
    assert hit / scored.count() > 0.2  # ten classes; chance is 0.1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["split", "stat", "key", "value"] and df.count() > 0


def test_queries_take_the_folder_they_are_given():
    for name, query in entry.queries().items():
        assert list(inspect.signature(query).parameters) == ["spark", "sf_dir"], name
