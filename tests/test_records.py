from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline import schemas
from cohortline.operators import risk as rk
from cohortline.operators import trace as tr

R = schemas.RECORDS


def make(spark, kind, *records):
    names = R[kind].fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], R[kind])


def person(name, key):
    return {"name": name, "id": key}


def approval(who, content=""):
    return {"id": "100", "reviewer": who, "content": content}


ANN, BOB, CID = person("Ann", "1"), person("Bob", "2"), person("Cid", "3")


@pytest.fixture(scope="module")
def requests(spark):
    return make(
        spark,
        "change_requests",
        {"project_id": "p", "id": "1", "title": "feature", "is_problem_report": False, "change_ids": ["b", "a", "zz"]},
        {"project_id": "p", "id": "2", "title": "problem", "is_problem_report": True, "change_ids": []},
        {"project_id": "p", "id": "3", "title": "fixed", "is_problem_report": True, "change_ids": ["a"]},
        {"project_id": "p", "id": "4", "title": "unflagged", "change_ids": None},
        {"project_id": "q", "id": "1", "title": "open problem", "is_problem_report": True, "change_ids": None},
    )


@pytest.fixture(scope="module")
def changes(spark):
    return make(
        spark,
        "changes",
        {"project_id": "p", "id": "a", "authors": [ANN, BOB], "approvals": [approval(BOB), approval(CID)]},
        {"project_id": "p", "id": "b", "authors": [BOB], "approvals": []},
        {"project_id": "p", "id": "c", "authors": [ANN], "approvals": [approval(ANN)]},
        {"project_id": "p", "id": "d", "authors": None, "approvals": None},
    )


def test_request_filters(requests):
    assert rows(tr.plain_change_requests(requests).select("title")) == [("feature",), ("unflagged",)]
    assert rows(tr.problem_reports_addressed(requests).select("title")) == [("fixed",)]
    assert rows(tr.unresolved_anomalies(requests).select("title")) == [("open problem",), ("problem",)]


def test_filters_by_link_table(spark, requests):
    links = spark.createDataFrame([("p", "2", 0, "a"), ("p", "2", 1, "b")], "project_id string, cr_id string, position int, change_id string")
    assert rows(tr.problem_reports_addressed(requests, links, ["project_id"]).select("title")) == [("problem",)]
    assert rows(tr.unresolved_anomalies(requests, links, ["project_id"]).select("title")) == [("fixed",), ("open problem",)]


def test_resolved_changes(requests, changes):
    got = rows(
        tr.resolve_changes(requests, changes, by=["project_id"]).select(
            "project_id", "cr_id", "position", "change_id", "implemented_by", "verified_by", "found"
        )
    )
    assert got == [
        ("p", "1", 0, "b", "Bob", None, True),
        ("p", "1", 1, "a", "Ann", "Cid", True),
        ("p", "1", 2, "zz", None, None, False),
        ("p", "2", None, None, None, None, None),
        ("p", "3", 0, "a", "Ann", "Cid", True),
        ("p", "4", None, None, None, None, None),
        ("q", "1", None, None, None, None, None),
    ]


def test_reviews(changes):
    got = rows(tr.review_check(changes).select("id", "finding"))
    assert got == [("b", "not approved"), ("c", "approved by authors only"), ("d", "not approved")]


def test_checklist(spark):
    text = "\n      - [x] Implements change request\n      - [ ] Unit tests\n      - [x] Documentation: N/A"
    changes = make(spark, "changes", {"id": "1", "approvals": [approval(CID, text), approval(CID, "no list"), approval(CID, None)]})
    items = tr.approval_checklist(changes)
    assert rows(items.select("item_position", "item", "ticked")) == [
        (0, "Implements change request", True), (1, "Unit tests", False), (2, "Documentation: N/A", True),
    ]
    assert rows(tr.checklist_counts(items)) == [("1", 2, 1)]


@pytest.fixture(scope="module")
def auto_tests(spark):
    return make(
        spark,
        "auto_tests",
        {"project_id": "p", "kind": "unit", "test_key": "t1", "result": "pass", "req_ids": ["r1", "r2"]},
        {"project_id": "p", "kind": "unit", "test_key": "t2", "result": "fail", "req_ids": ["r1"], "note": "because"},
        {"project_id": "p", "kind": "integration", "test_key": "t3", "result": "fail", "req_ids": ["unknown"]},
        {"project_id": "p", "kind": "integration", "test_key": "t4", "result": "pass", "req_ids": None},
    )


@pytest.fixture(scope="module")
def reqs(spark):
    return make(spark, "requirements", *[{"project_id": "p", "id": f"r{i}", "title": f"title {i}"} for i in (1, 2, 3)])


def test_coverage(reqs, auto_tests):
    got = rows(tr.requirement_coverage(reqs, auto_tests).select("id", "n_tests", "n_pass", "n_fail", "covered"))
    assert got == [("r1", 2, 1, 1, True), ("r2", 1, 1, 0, True), ("r3", 0, 0, 0, False)]
    assert rows(tr.uncovered_requirements(reqs, auto_tests).select("id")) == [("r3",)]


def test_verdicts(auto_tests):
    got = {r.kind: r for r in tr.suite_verdict(auto_tests).collect()}
    assert got["unit"].passed and got["unit"].n_fail == 1
    assert not got["integration"].passed and got["integration"].n_unjustified == 1


def test_failures_without_report(spark, auto_tests):
    reports = spark.createDataFrame([("t3", True), ("t2", False)], "test_key string, is_problem_report boolean")
    assert rows(tr.failures_without_report(auto_tests, reports).select("test_key")) == [("t2",)]


def test_all_results(spark, auto_tests):
    manual = make(
        spark,
        "manual_tests",
        {"name": "m1", "steps": [{"step": 5, "result": "pass", "req_ids": ["r1"], "note": None}, {"step": 6, "result": "fail", "req_ids": ["r2"], "note": "XYZ"}]},
        {"name": "m2", "steps": []},
    )
    got = rows(
        tr.all_test_results(auto_tests.where("kind = 'unit'"), auto_tests.where("kind = 'integration'"), manual).select(
            "kind", "name", "step", "result", "note"
        )
    )
    assert ("manual", "m1", 6, "fail", "XYZ") in got and ("manual", "m1", 5, "pass", "") in got
    assert ("unit", "t1", None, "pass", "") in got and len(got) == 6


def test_specs_and_requirements(spark, reqs):
    specs = make(
        spark, "specifications", *[{"project_id": "p", "id": f"s{i}", "req_id": q} for i, q in enumerate(["r1", "r1", "r9", None])]
    )
    got = rows(tr.spec_to_requirement(specs, reqs).select("spec_id", "req_id", "req_title", "status"))
    assert got == [
        (None, "r2", "title 2", "requirement without specification"),
        (None, "r3", "title 3", "requirement without specification"),
        ("s0", "r1", "title 1", "mapped"),
        ("s1", "r1", "title 1", "mapped"),
        ("s2", "r9", None, "specification without requirement"),
        ("s3", None, None, "specification without requirement"),
    ]


def test_component_defaults(spark):
    soup = make(
        spark,
        "soup",
        {"title": "full", "manufacturer": "M", "version": "1", "purpose": "p", "requirements": "linux", "anomaly_reference": "u", "relevant_anomalies": "one"},
        {"title": "bare", "version": "2", "purpose": "q"},
        {"title": "listed", "version": "3", "purpose": "q", "anomaly_reference": "u"},
    )
    got = {r.title: r for r in tr.default_fields(soup, "B", "Scope").collect()}
    assert got["full"].anomalies == "one" and got["full"].requirements == "linux"
    assert got["bare"].manufacturer == tr.NO_MANUFACTURER and got["bare"].requirements == tr.NO_REQUIREMENTS
    assert got["bare"].anomalies == tr.NO_ANOMALY_LIST and got["bare"].anomaly_reference is None
    assert "for Scope leading" in got["listed"].anomalies
    hidden = {r.title: r for r in tr.default_fields(soup, "A").collect()}
    assert hidden["full"].purpose is None and hidden["full"].anomalies is None and hidden["full"].manufacturer == "M"


def test_people(spark):
    people = make(
        spark,
        "people",
        {"project_id": "p", "name": "Socrates", "roles": ["Lead", "Engineer"], "git_host_usernames": ["socrates"]},
        {"project_id": "p", "name": "Plato", "roles": ["Engineer"], "git_host_usernames": ["plato", "p2"]},
        {"project_id": "p", "name": "Zeno", "roles": ["Engineer"], "git_host_usernames": None},
    )
    assert ("Engineer", "Zeno", None) in rows(tr.people_by_role(people)) and tr.people_by_role(people).count() == 5
    assert rows(tr.role_counts(people)) == [("Engineer", 3, 3, "Plato", "Zeno"), ("Lead", 1, 1, "Socrates", "Socrates")]


def test_releases_and_terms(spark):
    versions = make(
        spark,
        "versions",
        {"project_id": "p", "position": 0, "date": "1-1-2040", "release_id": "v1", "changes": ["a", "b"]},
        {"project_id": "p", "position": 1, "date": None, "release_id": "v2", "changes": None},
        {"project_id": "p", "position": 2, "date": "", "release_id": "v3", "changes": []},
    )
    got = tr.release_history(versions).orderBy(F.desc("position"), "line").collect()
    assert [(r.release_id, r.date, r.change) for r in got] == [
        ("v3", "in progress", None), ("v2", "in progress", None), ("v1", "1-1-2040", "a"), ("v1", "1-1-2040", "b"),
    ]
    terms = make(spark, "definitions", *[{"term": t} for t in ("risk", "Harm", "SOUP", "harm")])
    assert [r.term for r in tr.sorted_terms(terms).collect()] == ["Harm", "harm", "risk", "SOUP"]


def test_commits(spark):
    commits = make(
        spark,
        "commits",
        {"sha": "ok", "subject": "Add a thing #12", "body": "\nshort\nlines"},
        {"sha": "body", "subject": "Add", "body": "\nIssue #4\n" + "x" * 73},
        {"sha": "bad", "subject": "add " + "y" * 50 + ".", "body": None},
        {"sha": "edge", "subject": "E" * 46 + " #12", "body": "\n" + "z" * 72},
        {"sha": "joined", "subject": "Add #1", "body": "at once"},
    )
    assert rows(tr.commit_check(commits)) == [
        ("bad", "no change request number"), ("bad", "subject ends with a period"), ("bad", "subject not capitalised"),
        ("bad", "subject too long"), ("body", "body line too long"), ("joined", "no blank line between subject and body"),
    ]


def test_trends(spark):
    reports = spark.createDataFrame([("a", "v1")] * 3 + [("a", "v2")] + [("b", "v2")] * 2, "software_item string, release string")
    got = rows(tr.problem_trends(reports, 2))
    assert got == [("a", "v1", 3, None, True), ("a", "v2", 1, -2, False), ("b", "v2", 2, None, False)]


def test_anomaly_review(spark):
    records = (
        [{"component": "big", "anomaly_id": f"b{i}", "portion_used": i < 2} for i in range(9)]
        + [{"component": "big", "anomaly_id": f"p{i}", "priority": "high"} for i in range(9)]
        + [{"component": "small", "anomaly_id": f"s{i}", "portion_used": None} for i in range(4)]
    )
    kept = tr.anomaly_review_list(make(spark, "anomalies", *records), limit=4).collect()
    big = [r for r in kept if r.component == "big"]
    assert len([r for r in big if r.priority]) == 9
    sampled = [r for r in big if not r.priority]
    assert len(sampled) == 4 and {"b0", "b1"} <= {r.anomaly_id for r in sampled}
    assert len([r for r in kept if r.component == "small"]) == 4


def test_duplicate_ids(spark):
    reqs = make(spark, "requirements", {"project_id": "p", "id": "1"}, {"project_id": "p", "id": "1"}, {"project_id": "q", "id": "1"})
    assert rows(tr.duplicate_ids(reqs, by=["project_id"])) == [("p", "1", 2)]


# ---- risk --------------------------------------------------------------------------------------


def test_matrices():
    levels = rk.LEVEL_MATRIX
    assert all(levels[i][j] == levels[j][i] for i in range(5) for j in range(5))
    scores = rk.SCORE_MATRIX
    assert scores[0] == (1, 1, 2, 2, 3) and scores[4] == (3, 4, 4, 5, 5)
    for m, order in ((levels, rk.RISK_LEVELS.index), (scores, int)):
        for i in range(5):
            for j in range(4):
                assert order(m[i][j]) <= order(m[i][j + 1]) and order(m[j][i]) <= order(m[j + 1][i])


def test_levels(spark):
    risks = make(
        spark,
        "risks",
        {"id": "hz-1", "severity": "Catastrophic", "probability": "Low"},
        {"id": "hz-2", "severity": "Catastrophic", "probability": "High", "residual_probability": "Extremely Low", "control_measures": "c"},
        {"id": "hz-3", "severity": "Odd", "probability": "Low"},
        {"id": "hz-4", "severity": "Critical", "probability": "High", "residual_severity": "Minor"},
        {"id": "hz-5", "severity": "Minor", "probability": "Low"},
    )
    got = rows(rk.risk_level(risks).select("id", "level", "residual_level"))
    assert got == [
        ("hz-1", "Medium", "Medium"), ("hz-2", "High", "Low"), ("hz-3", None, None), ("hz-4", "Medium", "Low"), ("hz-5", "Low", "Low"),
    ]
    assert rows(rk.residual_risk_open(risks).select("id", "reason")) == [
        ("hz-1", "residual level too high"), ("hz-3", "residual level too high"), ("hz-4", "no control measure"),
    ]
    assert rows(rk.residual_risk_open(risks, ("Low", "Medium")).select("id")) == [("hz-3",)]


def test_scores(spark):
    df = spark.createDataFrame(
        [(i, inj, many, like) for i, (inj, many, like) in enumerate(
            [("death or permanent", True, "Very High"), ("death or permanent", False, "Low"), ("severe", True, "Medium"),
             ("minor, quick recovery", False, "High"), ("minor, slow recovery", False, "Very Low"), ("other", False, "Low")])],
        "id int, injury string, multiple boolean, likelihood string",
    )
    got = rows(rk.risk_score(rk.severity_class(df)).select("id", "severity", "score", "band"))
    assert got == [
        (0, "Catastrophic", 5, "unacceptable"), (1, "Major", 3, "undesirable"), (2, "Major", 3, "undesirable"),
        (3, "Minor", 2, "acceptable"), (4, "Significant", 1, "acceptable"), (5, None, None, None),
    ]


def test_trace(spark, reqs, auto_tests):
    risks = make(spark, "risks", *[{"id": f"h{i}", "hazard": "x"} for i in range(5)])
    controls = spark.createDataFrame(
        [("h0", "r1"), ("h1", "r2"), ("h2", "r3"), ("h3", "none"), ("h0", "r2")], "risk_id string, req_id string"
    )
    got = rows(rk.risk_trace(risks, controls, reqs, auto_tests).select("risk_id", "req_id", "n_tests", "trace"))
    assert got == [
        ("h0", "r1", 2, "test fails"), ("h0", "r2", 1, "complete"), ("h1", "r2", 1, "complete"), ("h2", "r3", 0, "not tested"),
        ("h3", "none", None, "unknown requirement"), ("h4", None, None, "no control"),
    ]


def test_release_gate(spark, requests, reqs, auto_tests):
    risks = make(spark, "risks", {"project_id": "p", "id": "h", "severity": "Catastrophic", "probability": "High"})
    gate = {r.project_id: r for r in tr.release_gate(requests, None, reqs, auto_tests, rk.residual_risk_open(risks)).collect()}
    p = gate["p"]
    assert (p.n_requests_open, p.n_known_anomalies, p.n_uncovered, p.n_unjustified, p.n_open_risks, p.ready) == (1, 1, 1, 1, 1, False)
    assert gate["q"].ready and gate["q"].n_known_anomalies == 1


def test_trends_show_releases_without_reports(spark):
    reports = [("a", 1)] * 10 + [("b", 2)] + [("a", 3)] * 5 + [("b", 4)] * 2 + [("c", 4)]
    got = rows(tr.problem_trends(spark.createDataFrame(reports, "software_item string, release int"), 7))
    assert got == [
        ("a", 1, 10, None, True), ("a", 2, 0, -10, False), ("a", 3, 5, 5, False), ("a", 4, 0, -5, False),
        ("b", 2, 1, None, False), ("b", 3, 0, -1, False), ("b", 4, 2, 2, False), ("c", 4, 1, None, False),
    ]


def test_an_empty_note_justifies_nothing(spark):
    tests = spark.createDataFrame([("unit", "fail", ""), ("more", "fail", "known"), ("none", "fail", None)], "kind string, result string, note string")
    got = {r.kind: r.passed for r in tr.suite_verdict(tests).collect()}
    assert got == {"unit": False, "more": True, "none": False}


def test_check_lists_folded_into_one_line(spark):
    content = "done - [x] first item - [ ] second, with - dash\n- [X] third"
    changes = spark.createDataFrame(
        [("1", [(None, None, content)])], "id string, approvals array<struct<id:string,reviewer:struct<name:string,id:string>,content:string>>"
    )
    got = tr.approval_checklist(changes).orderBy("item_position").select("item", "ticked").collect()
    assert [tuple(r) for r in got] == [("first item", True), ("second, with - dash", False), ("third", True)]
