from __future__ import annotations

from conftest import rows

from cohortline.operators import textscan as ts


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def test_sensitive_scan(spark):
    df = docs(
        spark,
        "write to a.b@example.org or c@d.io\nnothing here\ncall +1 (017) 555-7713",
        "card 1234567812345678 from 10.0.0.1",
        'token = "00ff"',
        "clean",
        None,
        "",
    )
    hits = ts.sensitive_scan(df)
    assert rows(hits) == [
        (0, 1, "mail", "a.b@example.org"), (0, 1, "mail", "c@d.io"), (0, 3, "phone", "+1 (017) 555-7713"),
        (1, 1, "address", "10.0.0.1"), (1, 1, "long number", "1234567812345678"), (2, 1, "token", 'token = "00ff"'),
    ]
    assert ("mail", 2, 1, 2) in rows(ts.sensitive_counts(hits))


def test_exceptions(spark):
    df = docs(spark, "a@b.cc\n10.0.0.1", "a@b.cc 10.0.0.2")
    allowed = spark.createDataFrame([("10.0.0.2",)], "value string")
    files = spark.createDataFrame([(0,)], "doc_id int")
    assert rows(ts.sensitive_scan(df, value_exceptions=["a@b.cc"]).select("value")) == [("10.0.0.1",), ("10.0.0.2",)]
    assert rows(ts.sensitive_scan(df, value_exceptions=allowed).select("doc_id", "value")) == [(0, "10.0.0.1"), (0, "a@b.cc"), (1, "a@b.cc")]
    assert rows(ts.sensitive_scan(df, file_exceptions=files).select("doc_id", "value")) == [(1, "10.0.0.2"), (1, "a@b.cc")]
    paths = spark.createDataFrame([("a/b/x", "a@b.cc"), ("a/bc/x", "a@b.cc")], "doc_id string, text string")
    assert rows(ts.sensitive_scan(paths, directory_exceptions=["a/b/"]).select("doc_id")) == [("a/bc/x",)]
    assert rows(ts.sensitive_scan(df, {"one": "10[.]0"}).select("rule", "value")) == [("one", "10.0"), ("one", "10.0")]


def test_tags(spark):
    df = docs(
        spark,
        "x [[62304:9.8.g]] y [[FDA-SW:vandv, FDA-SW:vandv-summary]]",
        "[[62304:5.1.1.d, 62304:6.1.e and 62304:8.2.2]]\n[[62304:7.1 62304:7.2]]",
        "none [] [x]",
        "[[ ]]",
        "[[:This section fulfills 62304:5.1.8.a.]]",
    )
    tags = ts.extract_tags(df)
    assert rows(tags) == [
        (0, "62304:9.8.g"), (0, "FDA-SW:vandv"), (0, "FDA-SW:vandv-summary"),
        (1, "62304:5.1.1.d"), (1, "62304:6.1.e"), (1, "62304:7.1"), (1, "62304:7.2"), (1, "62304:8.2.2"),
        (4, "62304:5.1.8.a"),
    ]
    clauses = spark.createDataFrame([("62304:9.8.g",), ("62304:1",)], "clause string")
    assert rows(ts.gap_audit(tags, clauses)) == [("62304:1",)]
    assert rows(ts.tag_coverage(tags, clauses)) == [("62304:1", 0), ("62304:9.8.g", 1)]


def test_markers(spark):
    df = docs(spark, "TODO: a TODO\nfine\n  TODO", "todo", "x[^\\]y")
    assert rows(ts.unfinished_markers(df).select("doc_id", "line_no", "n_markers")) == [(0, 1, 2), (0, 3, 1)]
    assert rows(ts.unfinished_markers(df, "[^\\]").select("doc_id", "n_markers")) == [(2, 1)]
