from __future__ import annotations

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cohortline.operators import samples as smp
from cohortline.operators.catalog import (
    attach_resource_files,
    catalog_join,
    label_from_experiment,
    scans_by_modality,
    scans_by_series,
)
from cohortline.plans.cohort_run import label_action, run_cohort, scan_action
from cohortline.sources.catalog import Catalog

# subject: what happens with it
#  s1 two scans and a label            s2 two scans, label of another modality only
#  s3 label, no scan                   s4 malformed label first, good one last
#  s5 labels 0 then 1                  s6 modality SCR                 s7 no experiment
EXPERIMENTS = [
    ("s1", "e1", 1, "CR", "A_3"),
    ("s2", "e2", 1, "DX", "A_1"),
    ("s3", "e3", 1, "CR", "A_2"),
    ("s4", "e4", 1, "CR", "ABC"),
    ("s4", "e5", 2, "CR", "X_1"),
    ("s5", "e6", 1, "CR", "A_0"),
    ("s5", "e7", 2, "CR", "A_1"),
    ("s6", "e8", 1, "SCR", "A_0"),
]
SCANS = [
    ("e1", "c1", 2, "late", "/1b"),
    ("e1", "c2", 1, "SlicePosition 1", "/1a"),
    ("e2", "c3", 1, "x", "/2a"),
    ("e2", "c4", 2, "x", "/2b"),
    ("e4", "c5", 1, "SlicePosition 9", "/4a"),
    ("e6", "c6", 1, "x", "/5a"),
    ("e7", "c7", 1, "SlicePosition 2", "/5b"),
    ("e8", "c8", 1, "x", "/6a"),
]


@pytest.fixture(scope="module")
def catalog(spark):
    names = [f"s{i}" for i in range(1, 8)]
    subjects = spark.createDataFrame(
        [(n, f"id-{n}", f"/subjects/{n}") for n in names],
        "subject_key string, subject_id string, subject_uri string",
    )
    experiments = spark.createDataFrame(
        EXPERIMENTS, "subject_key string, exp_key string, exp_ordinal bigint, modality string, label string"
    )
    scans = spark.createDataFrame(
        SCANS, "exp_key string, scan_key string, scan_ordinal bigint, series_description string, uri string"
    )
    return Catalog(subjects, experiments, scans)


ACTIONS = [scan_action(("CR", "DX")), label_action(("CR",))]


def built(catalog, mode="keep_partial", actions=ACTIONS):
    return smp.build_samples(catalog, actions, mode)


def found(samples):
    return rows(samples.items.select("subject_key", "action_ordinal", "action_data", "data_type"))


def test_catalog_join_keeps_empty_parents(catalog):
    joined = rows(catalog_join(catalog).select("subject_key", "exp_key", "uri"))
    assert ("s7", None, None) in joined
    assert ("s3", "e3", None) in joined
    assert len(joined) == len(SCANS) + 3  # e3, e5 and s7 have no scan


def test_scans_by_modality(catalog):
    assert len(scans_by_modality(catalog, ("CR",)).collect()) == 6
    assert rows(scans_by_modality(catalog, ("SCR",)).select("uri")) == [("/6a",)]


def test_first_scan_goes_by_catalog_order(catalog):
    first = scans_by_series(catalog, "A", "SlicePosition")
    assert rows(first.select("subject_key", "uri")) == [("s1", "/1a"), ("s4", "/4a"), ("s5", "/5b")]
    everything = scans_by_series(catalog, "A_", "", first=False)
    assert everything.count() == 7


def test_label_last_wins_and_one_bad_label_is_an_error(catalog):
    got = {r[0]: (r[1], r[2]) for r in label_from_experiment(catalog, ("CR",)).select("subject_key", "label", "error").collect()}
    assert got == {
        "s1": (3, False), "s3": (2, False), "s4": (None, True), "s5": (1, False), "s6": (0, False),
    }


def test_partial_mode_keeps_what_came_before_the_stop(catalog):
    samples = built(catalog)
    assert samples.subjects.count() == 7
    assert found(samples) == [
        ("s1", 0, "/1a", "xnat_uri"), ("s1", 0, "/1b", "xnat_uri"), ("s1", 1, "3", "value"),
        ("s2", 0, "/2a", "xnat_uri"), ("s2", 0, "/2b", "xnat_uri"),
        ("s4", 0, "/4a", "xnat_uri"),
        ("s5", 0, "/5a", "xnat_uri"), ("s5", 0, "/5b", "xnat_uri"), ("s5", 1, "1", "value"),
        ("s6", 0, "/6a", "xnat_uri"), ("s6", 1, "0", "value"),
    ]


def test_missing_log_has_missing_but_not_errors(catalog):
    log = rows(smp.missing_data_log(built(catalog)).select("subject_id", "subject_label", "failed_action"))
    assert log == [("s2", "id-s2", "fetch_label"), ("s3", "id-s3", "fetch_xr"), ("s7", "id-s7", "fetch_xr")]
    strict = rows(smp.missing_data_log(built(catalog, "drop")).select("subject_id"))
    assert strict == [("s3",), ("s7",)]  # a null value is not missing there


def test_status_rows(catalog):
    status = {(r[0], r[1]): r[2] for r in built(catalog).status.select("subject_key", "action_ordinal", "status").collect()}
    assert status[("s4", 1)] == "error" and status[("s4", 0)] == "ok"
    assert status[("s3", 0)] == "missing" and ("s3", 1) not in status


def test_strict_mode_drops_subjects_and_whole_number_values(catalog):
    samples = smp.surviving(built(catalog, "drop"))
    assert rows(samples.subjects.select("subject_key")) == [("s1",), ("s2",), ("s5",), ("s6",)]
    assert {r[3] for r in found(samples)} == {"xnat_uri"}


def test_strict_mode_keeps_text_values(catalog):
    def as_text(c):
        return label_from_experiment(c, ("CR",)).select("subject_key", "error", F.col("label").cast("string").alias("value"))

    text = smp.Action("fetch_label", "label", "value", as_text)
    samples = smp.surviving(built(catalog, "drop", [ACTIONS[0], text]))
    assert ("s1", 1, "3", "value") in found(samples)


def test_completeness_by_items_is_lenient(catalog):
    by_items = smp.complete_samples(built(catalog))
    assert rows(by_items.subjects.select("subject_key")) == [("s1",), ("s2",), ("s5",), ("s6",)]
    by_groups = smp.complete_samples(built(catalog), by="groups")
    assert rows(by_groups.subjects.select("subject_key")) == [("s1",), ("s5",), ("s6",)]
    with pytest.raises(ValueError):
        smp.complete_samples(built(catalog), by="actions")


def test_validation_wants_every_required_action(catalog):
    valid = smp.validate_samples(smp.complete_samples(built(catalog)), ("fetch_xr", "fetch_label"))
    assert rows(valid.subjects.select("subject_key")) == [("s1",), ("s5",), ("s6",)]
    assert smp.invalid_count(built(catalog)).first().asDict() == {"n_invalid": 4, "n_samples": 7}
    assert smp.validate_samples(built(catalog), ("unknown",)).subjects.count() == 0


def test_action_order_matters(catalog):
    swapped = built(catalog, actions=ACTIONS[::-1])
    items = found(swapped)
    assert ("s3", 0, "2", "value") in items  # the label came first and stays
    assert not [i for i in items if i[0] == "s2"]


def test_no_actions_keeps_all_subjects_empty(catalog):
    samples = smp.complete_samples(built(catalog, actions=[]))
    assert samples.subjects.count() == 7 and samples.items.count() == 0
    assert rows(smp.nest_items(samples).select(F.size("data")))[0] == (0,)


def test_duplicates_and_promotion(catalog):
    items = built(catalog).items
    dup = rows(smp.duplicate_labels(items).select("subject_id", "data_label", "n_items"))
    assert dup == [("id-s1", "image", 2), ("id-s2", "image", 2), ("id-s5", "image", 2)]
    wide = rows(smp.promote_values(items, ["label", "other"]).select("subject_key", "label", "other"))
    assert wide == [("s1", "3", None), ("s5", "1", None), ("s6", "0", None)]


def test_later_action_overwrites_value_of_same_label(catalog):
    again = label_action(("SCR", "DX"), name="fetch_other")
    items = built(catalog, actions=[label_action(("CR", "DX")), again]).items
    got = rows(smp.promote_values(items, ["label"]).select("subject_key", "label"))
    assert ("s6", "0") in got and ("s2", "1") in got and ("s1", "3") in got


@pytest.mark.parametrize("chunk_size", [1, 2, 3, 100])
def test_nested_items_are_whole_for_any_chunk_size(catalog, chunk_size):
    samples = built(catalog)
    nested = smp.nest_items(samples, chunk_size)
    flat = smp.flatten_items(nested)
    listed = [
        (r.subject_key, item.action_ordinal, item.action_data, item.data_type)
        for r in flat.orderBy("subject_key", "chunk").collect()
        for item in r.data
    ]
    assert sorted(listed) == found(samples)
    by_subject = {}
    for key, ordinal, *_ in listed:
        by_subject.setdefault(key, []).append(ordinal)
    assert all(v == sorted(v) for v in by_subject.values())
    assert all(len(r.data) <= chunk_size for r in flat.collect())


def test_nested_groups_follow_actions(catalog):
    data = {r.subject_key: r.data for r in smp.nest_items(built(catalog)).collect()}
    assert [len(g) for g in data["s1"]] == [2, 1]
    assert [i.action_data for i in data["s1"][0]] == ["/1a", "/1b"]
    assert [len(g) for g in data["s4"]] == [1]
    assert data["s7"] == []
    strict = {r.subject_key: r.data for r in smp.nest_items(built(catalog, "drop")).collect()}
    assert [len(g) for g in strict["s2"]] == [2, 0]  # a null value leaves an empty group


def test_resource_files(spark):
    items = spark.createDataFrame([("a", "/r/1"), ("b", "/r/1"), ("c", "/x")], "subject_id string, action_data string")
    resources = spark.createDataFrame([("/r/1", ["f1", "f2"])], "uri string, resource_files array<string>")
    got = rows(attach_resource_files(items, resources).select("subject_id", F.array_join("resource_files", ",")))
    assert got == [("a", "f1,f2"), ("b", "f1,f2"), ("c", None)]


def test_select_items(spark):
    df = spark.createDataFrame([(1, 2)], "image int, other int")
    assert smp.select_items(df, ["image", "label"]).columns == ["image"]
    with pytest.raises(ValueError):
        smp.select_items(df, ["image", "label"], allow_missing=False)


def test_action_checks(catalog):
    with pytest.raises(ValueError):
        built(catalog, "sometimes")
    with pytest.raises(ValueError):
        built(catalog, actions=[smp.Action("a", "b", "neither", lambda c: c.subjects)])


def test_a_value_action_with_several_rows_has_failed(catalog):
    def twice(c):
        keys = c.subjects.where("subject_key <> 's7'").select("subject_key", F.lit("v").alias("value"))
        return keys.unionByName(keys.where("subject_key = 's1'"))

    samples = built(catalog, actions=[smp.Action("twice", "label", smp.VALUE_ACTION, twice)])
    status = {r.subject_key: r.status for r in samples.status.collect()}
    assert samples.subjects.count() == 7 == len(status)
    assert status["s1"] == "error" and status["s7"] == "missing" and status["s2"] == "ok"
    assert len(samples.items.collect()) == 5 and [r.subject_id for r in smp.missing_data_log(samples).collect()] == ["s7"]


def test_whole_run(catalog):
    cohort = run_cohort(catalog, ACTIONS, ("fetch_xr", "fetch_label"), exact=True)
    stats = {(r.split, r.stat, r.key): r.value for r in cohort.stats().collect()}
    assert sum(v for k, v in stats.items() if k[1] == "n_samples") == 3
    assert stats[("train", "n_samples", None)] == 1 and stats[("test", "n_samples", None)] == 1
    assert sum(v for k, v in stats.items() if k[1] == "N") == 3
    assert all(v == 1.0 for k, v in stats.items() if k[1] == "class_weights")
    manifest = {(r.split, r.stat, r.key): r.value for r in cohort.manifest({"Normal": 0, "Positive": 1}).collect()}
    assert manifest[(None, "N_patients", None)] == 3 and manifest[(None, "labels", "Positive")] == 1
    assert len(cohort.missing.collect()) == 3


def test_run_on_a_sample_of_subjects(catalog):
    few = run_cohort(catalog, ACTIONS, (), test_batch=4)
    chosen = {r.subject_key for r in few.samples.subjects.collect()}
    assert {r.subject_key for r in few.samples.object_rows.select("subject_key").collect()} <= chosen | {
        r.subject_key for r in few.missing.select(F.col("subject_id").alias("subject_key")).collect()
    } | {"s4"}
    everyone = run_cohort(catalog, ACTIONS, (), test_batch=99).samples
    assert rows(everyone.subjects.select("subject_key")) == rows(run_cohort(catalog, ACTIONS, ()).samples.subjects.select("subject_key"))
    assert smp.build_samples(catalog, ACTIONS).settled().subjects.count() == 7


def test_projects_with_equal_keys_stay_apart(spark):
    """Two projects with the same keys at every level."""
    subjects = spark.createDataFrame([(p, "s", "id", "/s") for p in "ab"], "project_id string, subject_key string, subject_id string, subject_uri string")
    experiments = spark.createDataFrame(
        [(p, "s", "e", 1, "CR", f"X_{n}") for n, p in enumerate("ab")],
        "project_id string, subject_key string, exp_key string, exp_ordinal bigint, modality string, label string",
    )
    scans = spark.createDataFrame(
        [(p, "e", "c", 1, "d", f"/{p}") for p in "ab"],
        "project_id string, exp_key string, scan_key string, scan_ordinal bigint, series_description string, uri string",
    )
    both = Catalog(subjects, experiments, scans)
    assert catalog_join(both).count() == 2
    run = run_cohort(both, [scan_action(), label_action()], ("fetch_xr", "fetch_label"))
    items = rows(run.samples.items.select("project_id", "action_data"))
    assert items == [("a", "/a"), ("a", "0"), ("b", "/b"), ("b", "1")]
    assert run.samples.items.count() == 4 and smp.duplicate_labels(run.samples.items).count() == 0
    nested = smp.nest_items(run.samples)
    assert {r.project_id: len(r.data) for r in nested.collect()} == {"a": 2, "b": 2}
    joins = [x for x in run.split._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    assert joins and all("project_id" in x for x in joins)


def test_nested_items_of_usual_subjects_are_not_ordered_over_tasks(spark, catalog):
    """Subjects with one chunk are grouped after the join by subject; both ways give the same items in the same order."""
    samples = built(catalog)
    text = plan(smp.nest_items(samples))
    assert "rangepartitioning" not in text and "piece" not in text

    def items(nested):
        cut = nested.orderBy("subject_key", "chunk").collect()
        return [(r.subject_key, tuple(i)) for r in cut for group in r.data for i in group]

    assert items(smp.nest_items(samples)) == items(smp.nest_items(samples, chunk_size=1))


def test_nested_items_in_small_chunks_are_not_ordered_over_tasks(spark, catalog, monkeypatch):
    """Subjects with several small chunks are cut where they are grouped; larger ones are ordered, and both give the same rows."""
    samples = built(catalog)
    text = plan(smp.nest_items(samples, chunk_size=1))
    assert "rangepartitioning" not in text and "piece" not in text

    def cut(chunk_size):
        rows = smp.nest_items(samples, chunk_size).collect()
        return sorted((r.subject_key, r.chunk, r.n_chunks, tuple(tuple(group) for group in r.data)) for r in rows)

    grouped = [cut(n) for n in (1, 2, 3)]
    monkeypatch.setattr(smp, "WHOLE", 0)
    assert grouped == [cut(n) for n in (1, 2, 3)]
