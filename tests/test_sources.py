from __future__ import annotations

import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cohortline.operators.catalog import attach_resource_files, catalog_counts
from cohortline.operators.series import group_series
from cohortline.operators.stats import data_manifest, nested_manifest
from cohortline.plans.cohort_run import label_action, run_cohort, scan_action
from cohortline.sources import files, sinks, storage
from cohortline.sources.catalog import Catalog, read_catalog, write_catalog
from cohortline.sources.records import corrupt_records, read_records


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("catalog"))
    subjects = spark.createDataFrame([(p, f"{p}{i}", f"id{i}", "/u") for p in "ab" for i in range(3)], "project_id string, subject_key string, subject_id string, subject_uri string")
    experiments = subjects.select("project_id", "subject_key", F.concat("subject_key", F.lit("e")).alias("exp_key"), F.lit(1).cast("bigint").alias("exp_ordinal"), F.lit("CR").alias("modality"), F.lit("A_1").alias("label"))
    scans = experiments.select("project_id", "exp_key", F.lit("s").alias("scan_key"), F.lit(1).cast("bigint").alias("scan_ordinal"), F.lit("d").alias("series_description"), F.lit("/s").alias("uri"))
    resources = scans.select("project_id", F.col("scan_key").alias("owner_key"), "uri", F.array(F.lit("f.dcm")).alias("resource_files"))
    write_catalog(Catalog(subjects, experiments, scans, resources), folder)
    return folder


def test_catalog_of_one_project_reads_one_partition(spark, stored):
    everything = read_catalog(spark, stored)
    assert rows(catalog_counts(everything)) == [("experiments", 6), ("resources", 6), ("scans", 6), ("subjects", 6)]
    one = read_catalog(spark, stored, ["b"])
    assert one.subjects.count() == 3
    metadata = one.subjects._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(project_id" in metadata and "PushedFilters" not in metadata


def small_catalog(spark, project):
    """Three subjects, of which the last has no scan; ``project`` is a column or none."""
    people = spark.createDataFrame([(f"k{i}", f"id{i}", "/u") for i in range(3)], "subject_key string, subject_id string, subject_uri string")
    subjects = people if project is None else people.select(project.alias("project_id"), "*")
    scope = [] if project is None else ["project_id"]
    experiments = subjects.select(*scope, "subject_key", F.concat("subject_key", F.lit("e")).alias("exp_key"), F.lit(1).cast("bigint").alias("exp_ordinal"), F.lit("CR").alias("modality"), F.lit("A_1").alias("label"))
    scans = experiments.where("subject_key <> 'k2'").select(*scope, "exp_key", F.lit("s").alias("scan_key"), F.lit(1).cast("bigint").alias("scan_ordinal"), F.lit("d").alias("series_description"), F.lit("/s").alias("uri"))
    return Catalog(subjects, experiments, scans)


@pytest.mark.parametrize("layout", ["none", "column", "null", "partitions"])
def test_a_cohort_of_a_catalog_as_it_is_stored(spark, tmp_path, layout):
    """Without projects, with the column in the files, with a null in it, and in folders by project."""
    project = {"none": None, "null": F.when(F.col("subject_key") != "k1", F.lit("p")), "column": F.lit("p"), "partitions": F.lit("7")}[layout]
    made = small_catalog(spark, project)
    if layout in ("column", "null"):
        for name in ("subjects", "experiments", "scans"):
            getattr(made, name).write.parquet(f"{tmp_path}/{name}")
    else:
        write_catalog(made, str(tmp_path))
    read = read_catalog(spark, str(tmp_path))
    assert read.resources is None and read.scope == ([] if layout == "none" else ["project_id"])
    cohort = run_cohort(read, [scan_action(), label_action()], ("fetch_xr", "fetch_label"))
    assert sorted(r.subject_key for r in cohort.split.collect()) == ["k0", "k1"]
    assert [(r.subject_id, r.failed_action) for r in cohort.missing.collect()] == [("k2", "fetch_xr")]
    assert cohort.samples.items.count() == 4
    if layout == "null":
        assert {r.subject_key: r.project_id for r in cohort.split.collect()} == {"k0": "p", "k1": ""}
    if layout == "none":
        with pytest.raises(ValueError, match="no project_id"):
            read_catalog(spark, str(tmp_path), ["p"])
    else:
        some = read_catalog(spark, str(tmp_path), ["7" if layout == "partitions" else "p"])
        assert some.subjects.count() == (2 if layout == "null" else 3)


def test_levels_with_and_without_projects_are_refused(spark, tmp_path):
    one, other = small_catalog(spark, F.lit("p")), small_catalog(spark, None)
    with pytest.raises(ValueError, match="experiments"):
        Catalog(one.subjects, other.experiments, one.scans)
    one.subjects.write.parquet(f"{tmp_path}/subjects")
    for name in ("experiments", "scans"):
        getattr(other, name).write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(ValueError, match="experiments, scans"):
        read_catalog(spark, str(tmp_path))
    items = one.scans.select("project_id", F.col("uri").alias("action_data"))
    with pytest.raises(ValueError, match="resources"):
        attach_resource_files(items, spark.createDataFrame([("/s", ["f"])], "uri string, resource_files array<string>"))


def test_image_files(spark, tmp_path):
    for name in ("s1/a.dcm", "s1/b.dcm", "s2/deep/c.dcm", "s2/d.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    listing = files.scan_image_files(spark, str(tmp_path))
    assert listing.columns == ["path", "length"] and listing.count() == 3
    assert "content" not in plan(listing)
    assert files.scan_image_files(spark, str(tmp_path), ".txt").count() == 1
    contents = files.read_image_contents(spark, str(tmp_path))
    assert {bytes(r.content) for r in contents.collect()} == {b"12345"}
    series = group_series(listing.withColumn("object_uri", F.lit("o")))
    assert sorted(r.n_files for r in series.collect()) == [1, 2]


def test_records(spark, tmp_path):
    lines = [
        {"project_id": "p", "id": "1", "title": "t", "is_problem_report": True, "change_ids": ["a"]},
        {"project_id": "p", "id": "2"},
    ]
    path = tmp_path / "cr.json"
    path.write_text("\n".join(json.dumps(line) for line in lines))
    path.write_text(path.read_text() + '\n{"id": "3", broken\n\n')
    assert [r[0] for r in corrupt_records(spark, str(path), "change_requests").collect()] == ['{"id": "3", broken']
    got = read_records(spark, str(path), "change_requests")
    assert rows(got.select("id", "title", "is_problem_report", "change_ids")) == [("1", "t", True, ["a"]), ("2", None, None, None)]
    with pytest.raises(ValueError):
        read_records(spark, str(path), "nothing")


def test_sinks(spark, tmp_path):
    log = spark.createDataFrame([("1", "a", "fetch_xr"), ("2", 'b,\n"c"', "fetch_label")], "subject_id string, subject_label string, failed_action string")
    assert sinks.write_missing_log(log, f"{tmp_path}/log") == 2
    people = spark.createDataFrame([("1", "train", [1])], "subject_key string, split string, labels array<bigint>")
    manifest = data_manifest(people, {"Positive": 1})
    sinks.write_manifest(nested_manifest(manifest), f"{tmp_path}/manifest")
    assert spark.read.json(f"{tmp_path}/manifest").first().N_patients == 1
    sinks.write_split_ids(log, f"{tmp_path}/ids")
    assert rows(spark.read.text(f"{tmp_path}/ids")) == [("1",), ("2",)]
    for fmt in ("parquet", "json"):
        sinks.write_report(log, f"{tmp_path}/{fmt}", fmt)
        assert spark.read.format(fmt).load(f"{tmp_path}/{fmt}").count() == 2
    with pytest.raises(ValueError):
        sinks.write_report(log, f"{tmp_path}/x", "xml")


def test_settled_rows_live_in_the_named_folder(spark, tmp_path):
    df = spark.range(10).withColumn("piece", F.spark_partition_id())
    settled = storage.settle(df)
    assert settled.count() == 10 and settled.schema["piece"].dataType.simpleString() == "int"
    assert f"settled/{spark.sparkContext.applicationId}" in plan(settled)


def test_named_folder_comes_first():
    """``spark.checkpoint.dir`` is fixed when a session starts, so a stand-in session is asked."""
    from types import SimpleNamespace as Stub

    def session(named, context_dir, master="yarn"):
        return Stub(
            conf=Stub(get=lambda key, default=None: named if key == storage.CHECKPOINT_DIR else default or "hdfs:///tables/"),
            sparkContext=Stub(getCheckpointDir=lambda: context_dir, master=master),
        )

    assert storage.checkpoint_dir(session("hdfs:///shared", None)) == "hdfs:///shared"
    assert storage.checkpoint_dir(session("hdfs:///shared", "/other")) == "hdfs:///shared"
    assert storage.checkpoint_dir(session(None, "hdfs:///context")) == "hdfs:///context"
    assert storage.checkpoint_dir(session(None, None)) == "hdfs:///tables/checkpoints"
