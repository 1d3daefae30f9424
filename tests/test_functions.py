from __future__ import annotations

import hashlib
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.functions import classes, hashing


def test_stable_hash_is_md5_of_seed_and_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    got = rows(df.select("id", hashing.stable_hash(42, "id", F.col("name"))))
    assert got == [(i, hashlib.md5(f"42:{i}:{n}".encode()).hexdigest()) for i, n in ((1, "a"), (2, "b"))]


def test_hash_unit_is_even_and_in_range(spark):
    df = spark.range(20000).select(hashing.hash_unit(hashing.stable_hash("s", "id")).alias("u"))
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01


@pytest.mark.parametrize("p, expected", [(0.0, 0), (1.0, 1000)])
def test_coin_extremes(spark, p, expected):
    assert spark.range(1000).where(hashing.coin(p, 1, "id")).count() == expected


def test_label_number(spark):
    cases = {
        "A_0": 0,
        "A_12_x": 12,
        "A_ 7 ": 7,
        "A_-3": -3,
        "A_+3": 3,
        "ABC": None,
        "A_": None,
        "A_x": None,
        "A_1.5": None,
        "A_99999999999999999999": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "label string")
    got = {r[0]: r[1] for r in df.select("label", classes.label_number(F.col("label"))).collect()}
    assert got == cases


def test_label_separator_is_plain_text(spark):
    df = spark.createDataFrame([("1|2.3",)], "label string")
    assert df.select(classes.label_number(F.col("label"), "|", 0)).first()[0] == 1
    assert df.select(classes.label_number(F.col("label"), ".", 1)).first()[0] == 3


def test_contains_any_is_a_substring_test(spark):
    df = spark.createDataFrame([("CR",), ("SCR",), ("DX/CT",), ("MR",), ("cr",)], "m string")
    assert rows(df.where(classes.contains_any(F.col("m"), ["CR", "DX"]))) == [("CR",), ("DX/CT",), ("SCR",)]


def test_label_map_and_class_count(spark):
    table = {"Normal": 0, "Positive": 1, "Unknown": None}
    df = spark.createDataFrame([("Normal",), ("Positive",), ("Unknown",), ("other",)], "n string")
    got = {r[0]: r[1] for r in df.select("n", classes.map_labels(F.col("n"), table)).collect()}
    assert got == {"Normal": 0, "Positive": 1, "Unknown": None, "other": None}
    assert classes.n_classes(table) == 2
    assert classes.n_classes({"a": 1, "b": 1}) == 1


def test_softmax_argmax_and_log_probability(spark):
    logits = [[1.0, 2.0, 2.0], [1000.0, 999.0], [5.0]]
    df = spark.createDataFrame([(v,) for v in logits], "z array<double>").select(
        "z",
        classes.softmax(F.col("z")).alias("p"),
        classes.argmax(F.col("z")).alias("k"),
        classes.log_probability(F.col("z"), F.lit(0)).alias("lp"),
    )
    for z, p, k, lp in df.collect():
        powers = [math.exp(v - max(z)) for v in z]
        assert p == pytest.approx([v / sum(powers) for v in powers])
        assert k == z.index(max(z))
        assert lp == pytest.approx(math.log(powers[0] / sum(powers)))
