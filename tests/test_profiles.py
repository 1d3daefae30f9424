"""Profiles by sketches, merged without rows, and exact distinct counts by digest."""

from __future__ import annotations

import re

import pytest
from conftest import final_plan, plan
from pyspark.sql import functions as F

from cohortline.operators import profiles as pr

SCHEMA = "day int, n bigint, x double, t string, b binary"


@pytest.fixture(scope="module")
def rows_of_days(spark):
    return spark.range(0, 40_000, 1, 8).select(
        (F.col("id") % 4).cast("int").alias("day"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 9_000).alias("n"),
        (F.col("id") % 1_000 / 8).alias("x"),
        F.repeat(F.lit("a"), (F.col("id") % 50).cast("int")).alias("t"),
    )


def read(sketches):
    return {r.column_name: r for r in pr.read_profile(sketches).collect()}


def test_merged_days_equal_one_pass(rows_of_days):
    days = pr.profile_sketches(rows_of_days, ["n", "x", "t"], ["day"])
    assert days.count() == 12
    merged, whole = read(pr.merge_sketches(days)), read(pr.profile_sketches(rows_of_days, ["n", "x", "t"]))
    for name, distinct in (("n", 8_100), ("x", 1_000), ("t", 50)):
        one, all_at_once = merged[name], whole[name]
        assert (one.n_rows, one.n_null, one.low, one.high) == (
            all_at_once.n_rows, all_at_once.n_null, all_at_once.low, all_at_once.high
        )
        assert one.n_distinct == pytest.approx(distinct, rel=0.1)
    assert merged["n"].n_null == 4_000
    assert merged["t"].quantiles[2] == pytest.approx(24.5, abs=3)
    assert merged["x"].quantiles[0] == 0.0 and merged["x"].quantiles[4] == 124.875


def test_sketches_combine_before_the_shuffle(rows_of_days):
    text = plan(pr.profile_sketches(rows_of_days, ["n", "t"], ["day"]))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_hll_sketch_agg" in text and "Expand" not in text


def test_shared_values(spark):
    df = spark.range(0, 30_000).select(
        F.explode(F.array(*[F.struct(F.lit(g).alias("part"), F.col("id").between(lo, hi - 1).alias("in")) for g, lo, hi in (
            ("train", 0, 20_000), ("validation", 20_000, 30_000), ("test", 15_000, 25_000))])).alias("s"),
        "id",
    ).where("s.in").select("s.part", "id")
    got = {(r.left_group, r.right_group): r.n_shared for r in pr.shared_values(pr.profile_sketches(df, ["id"], ["part"]), "part", "id").collect()}
    assert got[("train", "validation")] == 0
    assert got[("test", "train")] == pytest.approx(5_000, rel=0.15)
    assert got[("test", "validation")] == pytest.approx(5_000, rel=0.15)


def test_awkward_values(spark):
    rows = [(1, None, float("nan"), "", b""), (1, None, -0.0, None, b"\xff"), (2, None, 0.0, "x" * 300_000, None), (2, None, float("inf"), "", b"\xff")]
    df = spark.createDataFrame(rows, SCHEMA)
    exact = {r.column_name: r.n_distinct for r in pr.exact_distinct(df, ["n", "x", "t", "b"]).collect()}
    assert exact == {"n": 0, "x": 3, "t": 2, "b": 2}
    got = read(pr.merge_sketches(pr.profile_sketches(df, ["n", "x", "t", "b"], ["day"])))
    assert (got["n"].n_null, got["n"].n_distinct, got["n"].quantiles) == (4, 0, None)
    assert got["x"].n_distinct == 3 and got["x"].high == float("inf")
    assert (got["t"].n_null, got["t"].n_distinct, got["t"].high) == (1, 2, 300_000.0)
    assert got["b"].n_distinct == 2 and got["b"].quantiles is None


def test_empty_table_and_nested_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pr.profile_sketches(empty, ["n"], ["day"]).count() == 0
    assert [tuple(r) for r in pr.read_profile(pr.profile_sketches(empty, ["n"])).select("n_rows", "n_null", "n_distinct").collect()] == [(0, 0, 0)]
    assert pr.exact_distinct(empty, ["n"]).count() == 0
    with pytest.raises(ValueError, match="nested"):
        pr.exact_distinct(spark.createDataFrame([], "a array<int>"), ["a"])


def test_long_values_do_not_travel(spark):
    df = spark.range(64).select(F.repeat(F.lit("y"), 100_000).alias("t"), F.col("id").alias("n"))
    text = final_plan(pr.exact_distinct(df, ["t", "n"]))
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert exchanges and not any(re.search(r"\bt#", line) for line in exchanges)
