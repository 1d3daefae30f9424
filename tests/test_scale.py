"""Plans and sources that must hold at any size."""

from __future__ import annotations

import os
import re

import pytest
from conftest import final_plan, plan, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortline.operators import evaluate as ev
from cohortline.operators import samples as smp
from cohortline.operators.catalog import catalog_join
from cohortline.operators.joins import keep_both, keep_left
from cohortline.operators.splits import split_samples, training_shards
from cohortline.plans import driver_tables as dt
from cohortline.plans.cohort_run import label_action, run_cohort, scan_action
from cohortline.sources.catalog import Catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PACKAGE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "cohortline")


def sources():
    """Without the optional part, which brings counted, bounded rows to the driver and has its own tests."""
    for folder, _, names in os.walk(PACKAGE):
        if os.path.relpath(folder, PACKAGE).split(os.sep)[0] == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    yield os.path.join(folder, name), f.read()


@pytest.mark.parametrize("word", [r"\.collect\(\)", r"\.toPandas\(", r"crossJoin", r"localCheckpoint", r"\.rdd\b", r"\.toLocalIterator\("])
def test_no_driver_side_work_in_the_package(word):
    assert [path for path, text in sources() if re.search(word, text)] == []


@pytest.fixture(scope="module")
def hot(spark):
    """One subject has two thirds of the experiments, one experiment most of the scans."""
    subjects = spark.range(200).select(
        F.col("id").cast("string").alias("subject_key"),
        F.concat(F.lit("s"), "id").alias("subject_id"),
        F.concat(F.lit("/"), "id").alias("subject_uri"),
    )
    experiments = spark.range(600).select(
        F.when(F.col("id") < 400, "7").otherwise((F.col("id") % 150).cast("string")).alias("subject_key"),
        F.col("id").cast("string").alias("exp_key"),
        F.col("id").alias("exp_ordinal"),
        F.lit("CR").alias("modality"),
        F.concat(F.lit("A_"), F.col("id") % 3).alias("label"),
    )
    scans = spark.range(0, 60000, 1, 12).select(
        F.when(F.col("id") < 40000, "7").otherwise((F.col("id") % 600).cast("string")).alias("exp_key"),
        F.col("id").cast("string").alias("scan_key"),
        F.col("id").alias("scan_ordinal"),
        F.lit("d").alias("series_description"),
        F.concat(F.lit("/scan/"), "id", F.repeat(F.lit("x"), 60)).alias("uri"),
    )
    return Catalog(subjects, experiments, scans)


@pytest.fixture
def small_targets(spark):
    """Thresholds of adaptive execution scaled down to the test rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_experiment_is_split_in_the_catalog_join(spark, hot, small_targets):
    joined = catalog_join(hot)
    text = final_plan(joined)
    assert "skew=true" in text
    assert joined.count() == 60000 + 50  # subjects 150 to 199 have no experiment; all experiments have scans


def test_hot_subject_is_split_when_items_are_attached(spark, hot, small_targets):
    samples = smp.build_samples(hot, [scan_action(("CR",)), label_action(("CR",))])
    assert "skew=true" in final_plan(samples.items)
    assert samples.items.count() == 60000 + samples.subjects.where("first_fail is null").count()


def test_hot_subject_in_nested_rows(spark, hot):
    samples = smp.build_samples(hot, [scan_action(("CR",)), label_action(("CR",))])
    nested = smp.nest_items(samples, chunk_size=1000)
    sizes = nested.select("subject_key", "chunk", F.size(F.flatten("data")).alias("n")).collect()
    assert max(r.n for r in sizes) <= 1000
    assert sum(r.n for r in sizes) == samples.items.count()


def test_statistics_never_join_items(spark, hot):
    text = plan(run_cohort(hot, [scan_action(("CR",)), label_action(("CR",))], ("fetch_xr", "fetch_label")).stats())
    for line in text.splitlines():
        if "Exchange hashpartitioning(split" in line:
            break
    else:
        pytest.fail("no exchange by split")
    assert "ArrowEvalPython" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_outer_join_helpers(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    many = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r"), (None, "s")], "k int, y string")
    assert rows(keep_left(one, many, "k")) == rows(one.join(many, "k", "left"))
    assert rows(keep_both(one, many, "k")) == rows(one.join(many, "k", "full"))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_no_query_uses_a_cross_or_nested_loop_join(spark):
    for name, query in entry.queries().items():
        text = plan(query(spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_scans_read_only_what_they_need(spark):
    def schema_of(name):
        text = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        return re.findall(r"ReadSchema: (.*)", text)

    assert schema_of("label_ids") == ["struct<c_custkey:bigint,c_mktsegment:string>"]
    assert schema_of("accuracy") == ["struct<embedding:array<float>,label:int>"]
    assert schema_of("group_series") == ["struct<url:string>"]
    assert schema_of("sensitive_scan") == ["struct<doc_id:bigint,text:string>"]
    assert all("series" not in s and "l_quantity" not in s for s in schema_of("dataset_stats"))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_filters_reach_the_scan(spark):
    text = entry.queries()["best_checkpoint"](spark, SF_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(event_type,purchase)" in text
    assert "WindowGroupLimit" in text  # the first rows per run are picked before the shuffle
    reviewed = plan(entry.queries()["anomaly_review_list"](spark, SF_DIR))
    assert "WindowGroupLimit" in reviewed


def test_ranks_are_not_computed_in_one_task(spark):
    """No window over all rows: single-partition exchanges only carry counts per bucket."""
    people = spark.range(5000).select(F.col("id").alias("subject_key"))
    for df in (split_samples(people, exact=True), training_shards(people, 8, 2)):
        for line in plan(df).splitlines():
            if "Exchange SinglePartition" in line:
                continue
            assert not re.search(r"Window .*windowspecdefinition\(draw", line)


def test_curves_do_not_window_over_all_scores(spark):
    preds = spark.range(2000).select(
        (F.col("id") % 2).cast("int").alias("y"),
        F.array(F.rand(1), F.rand(2)).alias("logits"),
    )
    text = plan(ev.roc_auc(preds))
    for line in text.splitlines():
        if re.search(r"Window \[.*sum\((pos|neg)", line):
            assert "piece" in line


def test_image_pipeline_has_no_shuffle(spark):
    text = plan(entry.queries()["image_pipeline"](spark, SF_DIR)) if os.path.isdir(SF_DIR) else ""
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_same_result_for_one_and_many_partitions(spark):
    base = dt.catalog(spark, SF_DIR)

    def stats(n):
        spread = Catalog(base.subjects.repartition(n), base.experiments.repartition(n), base.scans.repartition(n))
        cohort = run_cohort(spread, [scan_action(("URGENT",)), label_action(("URGENT",))], ("fetch_xr", "fetch_label"))
        return rows(cohort.stats())

    assert stats(1) == stats(16)
