from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.operators import splits


def people(spark, n, parts=4):
    return spark.range(0, n, 1, parts).select(F.col("id").alias("subject_key"), F.concat(F.lit("p"), "id").alias("subject_id"))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 100, 1001])
def test_exact_sizes(spark, n):
    split = splits.split_samples(people(spark, n), exact=True)
    sizes = {r[0]: r[1] for r in split.groupBy("split").count().collect()}
    held = math.ceil(n / 2)
    test = math.ceil(held / 2)
    expected = {"train": n - held, "validation": held - test, "test": test}
    assert sizes == {k: v for k, v in expected.items() if v}
    assert split.select("subject_key").distinct().count() == n


def test_exact_split_follows_the_digest_order(spark):
    split = rows(splits.split_samples(people(spark, 200), exact=True).withColumn("h", F.md5(F.concat(F.lit("42:"), "subject_key"))).select("h", "split"))
    names = [s for _, s in sorted(split)]
    assert names == ["train"] * 100 + ["validation"] * 50 + ["test"] * 50


def test_other_fractions(spark):
    split = splits.split_samples(people(spark, 10), fractions=(0.7, 0.15, 0.15), exact=True)
    assert {r[0]: r[1] for r in split.groupBy("split").count().collect()} == {"train": 7, "validation": 1, "test": 2}
    no_test = splits.split_samples(people(spark, 10), fractions=(0.5, 0.5, 0.0), exact=True)
    assert {r[0]: r[1] for r in no_test.groupBy("split").count().collect()} == {"train": 5, "validation": 5}
    with pytest.raises(ValueError):
        splits.split_samples(people(spark, 10), fractions=(0.5, 0.5, 0.5))


@pytest.mark.parametrize("exact", [False, True])
def test_split_does_not_depend_on_partitions(spark, exact):
    one = rows(splits.split_samples(people(spark, 300, 1), exact=exact).select("subject_key", "split"))
    many = rows(splits.split_samples(people(spark, 300, 16).repartition(16), exact=exact).select("subject_key", "split"))
    assert one == many


def test_hash_split_is_stable_when_subjects_are_added(spark):
    small = dict(rows(splits.split_samples(people(spark, 100)).select("subject_key", "split")))
    large = dict(rows(splits.split_samples(people(spark, 5000)).select("subject_key", "split")))
    assert all(large[k] == v for k, v in small.items())
    shares = [sum(1 for v in large.values() if v == s) / 5000 for s in splits.SPLITS]
    assert shares == pytest.approx([0.5, 0.25, 0.25], abs=0.03)


@pytest.mark.parametrize("n, expected", [(0, 10), (-1, 10), (10, 10), (11, 10), (4, 4)])
def test_bounded_sample_sizes(spark, n, expected):
    assert splits.bounded_sample(people(spark, 10), n).count() == expected


def test_samples_of_any_size_are_exact_and_nested(spark):
    df = people(spark, 500).unionByName(people(spark, 500))  # each key twice
    before = set()
    for n in (1, 120, 121, 499, 500, 501, 999):
        got = [r.subject_key for r in splits.bounded_sample(df, n).select("subject_key").collect()]
        assert len(got) == n and before <= set(got)
        before = set(got)
    assert splits.bounded_sample(df, 1200).count() == 1000


def test_preview_only_from_train(spark):
    split = splits.split_samples(people(spark, 200))
    preview = splits.preview_sample(split, 24)
    assert preview.count() == 24 and {r.split for r in preview.collect()} == {"train"}
    assert splits.preview_sample(splits.split_samples(people(spark, 10), exact=True), 24).count() == 5


def test_held_out_ids(spark):
    split = splits.split_samples(people(spark, 20), exact=True)
    assert splits.held_out_ids(split).columns == ["subject_id"] and splits.held_out_ids(split).count() == 5


def test_shards_cover_everything_once(spark):
    df = people(spark, 250)
    sharded = splits.training_shards(df, batch_size=8, n_shards=3, epoch=1)
    assert sharded.count() == 250
    for shard, group in _by_shard(sharded).items():
        positions = sorted(p for _, p, _ in group)
        assert positions == list(range(len(group)))
        assert all(b == p // 8 for _, p, b in group)
    other = splits.training_shards(df, batch_size=8, n_shards=3, epoch=2)
    homes = {r.subject_key: r.shard for r in sharded.collect()}
    assert homes == {r.subject_key: r.shard for r in other.collect()}
    assert rows(sharded.select("subject_key", "position")) != rows(other.select("subject_key", "position"))
    fixed = splits.training_shards(df, batch_size=8, n_shards=3)
    again = splits.training_shards(df.repartition(7), batch_size=8, n_shards=3)
    assert rows(fixed.select("subject_key", "position")) == rows(again.select("subject_key", "position"))


def _by_shard(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.shard, []).append((r.subject_key, r.position, r.batch))
    return out
