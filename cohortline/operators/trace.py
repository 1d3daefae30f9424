"""Traceability between requirements, tests, changes and releases.

Every table may carry ``project_id`` columns; name them in ``by`` and one job covers all projects.
Links between records are either arrays of ids or tables with one row per link.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import stable_hash
from .joins import keep_both, keep_left
from .ranks import first_rows

# Texts shown where a third-party component leaves a field out.
NO_MANUFACTURER = (
    "SOUP was developed collaboratively by the free open-source software community, and does not have a "
    "manufacturer in the traditional sense."
)
NO_REQUIREMENTS = "No noteworthy software or hardware requirements."
NO_ANOMALY_LIST = "Known anomaly list is not available."
NO_RELEVANT_ANOMALY = (
    "No anomalies found that would result in incorrect behaviour for {device} leading to a hazardous situation."
)
IN_PROGRESS = "in progress"

PASS, FAIL = "pass", "fail"


# ---- change requests and changes ---------------------------------------------------------------


def _is_problem() -> Column:
    return F.coalesce("is_problem_report", F.lit(False))


def change_links(change_requests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(cr_id, position, change_id)``: one row per change a request names, in list order."""
    return change_requests.select(
        *by, F.col("id").alias("cr_id"), F.posexplode("change_ids").alias("position", "change_id")
    )


def plain_change_requests(change_requests: DataFrame) -> DataFrame:
    """Requests that are not problem reports; a missing flag counts as no."""
    return change_requests.where(~_is_problem())


def problem_reports_addressed(
    change_requests: DataFrame, links: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Problem reports with at least one change."""
    problems = change_requests.where(_is_problem())
    if links is None:
        return problems.where(F.size(F.coalesce("change_ids", F.array())) > 0)
    return problems.join(links.select(*by, F.col("cr_id").alias("id")).distinct(), [*by, "id"], "left_semi")


def unresolved_anomalies(
    change_requests: DataFrame, links: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Problem reports without any change: the known anomalies."""
    problems = change_requests.where(_is_problem())
    if links is None:
        return problems.where(F.size(F.coalesce("change_ids", F.array())) == 0)
    return problems.join(links.select(*by, F.col("cr_id").alias("id")).distinct(), [*by, "id"], "left_anti")


def resolve_changes(
    change_requests: DataFrame,
    changes: DataFrame,
    links: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Each request with its changes in list order: implementer (first author) and verifier (last
    approval). Requests without changes keep one row; a change id without a change has ``found``
    false."""
    people = changes.select(
        *by,
        F.col("id").alias("change_id"),
        F.get("authors", F.lit(0)).getField("name").alias("implemented_by"),
        F.try_element_at("approvals", F.lit(-1)).getField("reviewer").getField("name").alias("verified_by"),
        F.lit(True).alias("found"),
    )
    heads = change_requests.select(*by, F.col("id").alias("cr_id"), "title", "change_ids")
    if links is None:
        named = heads.select(*by, "cr_id", "title", F.posexplode_outer("change_ids").alias("position", "change_id"))
    else:
        named = keep_left(heads.drop("change_ids"), links, [*by, "cr_id"])
    # Links are the preserved side: a change named by very many requests can be split.
    return named.join(people, [*by, "change_id"], "left").select(
        *by,
        "cr_id",
        "title",
        "position",
        "change_id",
        "implemented_by",
        "verified_by",
        F.when(F.col("change_id").isNotNull(), F.coalesce("found", F.lit(False))).alias("found"),
    )


def review_check(changes: DataFrame) -> DataFrame:
    """Changes with no approval, or approved by their own authors only."""
    authors = F.transform(F.coalesce("authors", F.array()), lambda a: a.id)
    reviewers = F.transform(F.coalesce("approvals", F.array()), lambda a: a.reviewer.id)
    independent = F.exists(reviewers, lambda r: ~F.array_contains(authors, r))
    finding = F.when(F.size(reviewers) == 0, "not approved").when(
        ~F.coalesce(independent, F.lit(False)), "approved by authors only"
    )
    checked = changes.withColumn("n_approvals", F.size(reviewers)).withColumn("finding", finding)
    return checked.where(F.col("finding").isNotNull())


#: An item runs to the end of its line or to the next mark, since folded texts hold several on one line.
CHECK_ITEM = r"- \[([ xX])\] ((?:(?!\s- \[[ xX]\] )[^\n])*)"


def approval_checklist(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Items of the check lists in approval texts: one row per item with its tick."""
    texts = changes.select(
        *by, F.col("id").alias("change_id"), F.posexplode("approvals").alias("approval_position", "approval")
    )
    marks = F.regexp_extract_all(F.col("approval.content"), F.lit(CHECK_ITEM), F.lit(1))
    names = F.regexp_extract_all(F.col("approval.content"), F.lit(CHECK_ITEM), F.lit(2))
    lines = F.arrays_zip(marks.alias("mark"), names.alias("item"))
    return texts.select(
        *by, "change_id", "approval_position", F.posexplode(lines).alias("item_position", "line")
    ).select(
        *by,
        "change_id",
        "approval_position",
        "item_position",
        F.trim("line.item").alias("item"),
        (F.lower("line.mark") == "x").alias("ticked"),
    )


def checklist_counts(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ticked and unticked items per change."""
    return items.groupBy(*by, "change_id").agg(
        F.count_if("ticked").alias("n_ticked"), F.count_if(~F.col("ticked")).alias("n_unticked")
    )


# ---- tests and requirements --------------------------------------------------------------------


def all_test_results(unit: DataFrame, integration: DataFrame, manual: DataFrame) -> DataFrame:
    """One table of unit, integration and manual test results; a missing note is an empty text."""

    def automatic(tests: DataFrame, kind: str) -> DataFrame:
        return tests.select(
            F.lit(kind).alias("kind"),
            F.col("test_key").cast("string").alias("name"),
            F.lit(None).cast("int").alias("step"),
            "result",
            "req_ids",
            F.coalesce("note", F.lit("")).alias("note"),
        )

    steps = manual.select("name", F.explode("steps").alias("s")).select(
        F.lit("manual").alias("kind"),
        "name",
        F.col("s.step").alias("step"),
        F.col("s.result").alias("result"),
        F.col("s.req_ids").alias("req_ids"),
        F.coalesce("s.note", F.lit("")).alias("note"),
    )
    parts = [automatic(unit, "unit"), automatic(integration, "integration"), steps]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def spec_to_requirement(specs: DataFrame, reqs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each specification with its requirement; ``status`` shows what is unmatched on either side."""
    mine = specs.select(*by, F.col("id").alias("spec_id"), "req_id", F.lit(True).alias("has_spec"))
    named = reqs.select(
        *by, F.col("id").alias("req_id"), F.col("title").alias("req_title"), F.lit(True).alias("has_req")
    )
    status = (
        F.when(F.col("has_spec").isNull(), "requirement without specification")
        .when(F.col("has_req").isNull(), "specification without requirement")
        .otherwise("mapped")
    )
    return keep_both(named, mine, [*by, "req_id"]).select(
        *by, "spec_id", "req_id", "req_title", status.alias("status")
    )


def requirement_coverage(reqs: DataFrame, tests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tests, passes and failures per requirement; tests without a requirement are fine.

    Results are counted per requirement before the join, so both of its sides are unique.
    """
    per_req = (
        tests.select(*by, F.explode("req_ids").alias("id"), "result")
        .groupBy(*by, "id")
        .agg(
            F.count(F.lit(1)).alias("n_tests"),
            F.count_if(F.col("result") == PASS).alias("n_pass"),
            F.count_if(F.col("result") == FAIL).alias("n_fail"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return reqs.join(per_req, [*by, "id"], "left").select(
        *by,
        "id",
        "title",
        *[F.coalesce(c, zero).alias(c) for c in ("n_tests", "n_pass", "n_fail")],
        (F.col("n_tests").isNotNull()).alias("covered"),
    )


def uncovered_requirements(reqs: DataFrame, tests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requirements that no test names."""
    named = tests.select(*by, F.explode("req_ids").alias("id")).distinct()
    return reqs.join(named, [*by, "id"], "left_anti")


def suite_verdict(tests: DataFrame, by: Sequence[str] = ("kind",)) -> DataFrame:
    """A suite passes if each test passes or its failure is justified by a note; a blank note is none."""
    fine = (F.col("result") == PASS) | (F.trim("note") != "")
    return tests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_tests"),
        F.count_if(F.col("result") != PASS).alias("n_fail"),
        F.count_if(~F.coalesce(fine, F.lit(False))).alias("n_unjustified"),
        F.bool_and(F.coalesce(fine, F.lit(False))).alias("passed"),
    )


def failures_without_report(
    tests: DataFrame, reports: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Failed tests that no problem report names; ``reports`` has ``test_key`` and the flag."""
    failed = tests.where(F.col("result") == FAIL)
    named = reports.where(_is_problem()).select(*by, "test_key").distinct()
    return failed.join(named, [*by, "test_key"], "left_anti")


# ---- components, people, releases --------------------------------------------------------------


def default_fields(soup: DataFrame, safety_class: str | Column = "B", device: str = "the device") -> DataFrame:
    """Third-party components with fixed texts for absent fields.

    Purpose, requirements and anomaly fields are shown only for a safety class other than A.
    """
    level = F.lit(safety_class) if isinstance(safety_class, str) else safety_class
    shown = level != "A"

    def field(name: str) -> Column:
        return F.col(name) if name in soup.columns else F.lit(None).cast("string")

    anomalies = F.when(field("anomaly_reference").isNull(), NO_ANOMALY_LIST).otherwise(
        F.coalesce(field("relevant_anomalies"), F.lit(NO_RELEVANT_ANOMALY.format(device=device)))
    )
    return soup.select(
        "title",
        F.coalesce(field("manufacturer"), F.lit(NO_MANUFACTURER)).alias("manufacturer"),
        "version",
        F.when(shown, field("purpose")).alias("purpose"),
        F.when(shown, F.coalesce(field("requirements"), F.lit(NO_REQUIREMENTS))).alias("requirements"),
        F.when(shown, anomalies).alias("anomalies"),
        F.when(shown, field("anomaly_reference")).alias("anomaly_reference"),
    )


def people_by_role(people: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per role, person and user name. Long form: a role may hold most of the people."""
    return people.select(*by, "name", F.explode("roles").alias("role"), "git_host_usernames").select(
        *by, "role", "name", F.explode_outer("git_host_usernames").alias("username")
    )


def role_counts(people: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """People and user names per role, with the first and last name."""
    users = F.size(F.coalesce("git_host_usernames", F.array()))
    return (
        people.select(*by, "name", F.explode("roles").alias("role"), users.alias("users"))
        .groupBy(*by, "role")
        .agg(
            F.count(F.lit(1)).alias("n_people"),
            F.sum("users").alias("n_usernames"),
            F.min("name").alias("first_name"),
            F.max("name").alias("last_name"),
        )
    )


def sorted_terms(definitions: DataFrame) -> DataFrame:
    """Definitions in order of their term."""
    return definitions.orderBy(F.lower("term"), "term")


def release_history(versions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per change line of each release; sort by ``position`` down, then ``line``.

    A release without a date is in progress; one without changes keeps a row.
    """
    date = F.when(F.coalesce("date", F.lit("")) == "", IN_PROGRESS).otherwise(F.col("date"))
    return versions.select(
        *by, "position", "release_id", date.alias("date"), F.posexplode_outer("changes").alias("line", "change")
    )


def problem_trends(
    reports: DataFrame, limit: int, by: Sequence[str] = ("software_item",), release: str = "release"
) -> DataFrame:
    """Problem reports per software item and release, the change since the release before, and whether the
    count is over the limit.

    The releases are those with any report of any item, in order. Where an item has none in the release after one
    of its own, a row with 0 says so; a longer pause has no further rows. The windows see counted rows only.
    """
    counts = reports.groupBy(*by, release).agg(F.count(F.lit(1)).alias("n_reports"))
    # One row per release.
    after = F.lead(release).over(Window.partitionBy(F.lit(0)).orderBy(release))
    releases = counts.select(release).distinct().withColumn("next_release", after)
    known = counts.join(releases, release)
    mine = Window.partitionBy(*by).orderBy(release)
    stopped = F.col("next_release").isNotNull() & ~F.lead(release).over(mine).eqNullSafe(F.col("next_release"))
    zero = F.when(F.col("stopped"), F.struct(F.col("next_release").alias("at"), F.lit(0).cast("bigint").alias("n")))
    filled = (
        known.withColumn("stopped", stopped)
        .select(*by, F.array_compact(F.array(F.struct(F.col(release).alias("at"), F.col("n_reports").alias("n")), zero)).alias("rows"))
        .select(*by, F.inline("rows").alias(release, "n_reports"))
    )
    # After a pause the release before had no report either.
    placed = filled.join(releases, release).withColumn(
        "before", F.when(F.lag("next_release").over(mine) == F.col(release), F.lag("n_reports").over(mine)).otherwise(0)
    )
    seen_before = F.lag(release).over(mine).isNotNull()
    return placed.select(
        *by,
        release,
        "n_reports",
        F.when(seen_before, F.col("n_reports") - F.col("before")).alias("change"),
        (F.col("n_reports") > limit).alias("over_limit"),
    )


def anomaly_review_list(anomalies: DataFrame, limit: int = 100, seed: object = 42) -> DataFrame:
    """Anomalies to review per component.

    All anomalies with a priority are kept. Those without one are kept too, unless a component has
    more than ``limit`` of them: then ``limit`` are sampled, portions in use first. ``review_class``
    is 1 for portions in use, 2 for the rest.
    """
    used = F.coalesce("portion_used", F.lit(False))
    ready = anomalies.withColumn("review_class", F.when(used, 1).otherwise(2))
    order = [F.col("review_class"), stable_hash(seed, "component", "anomaly_id"), F.col("anomaly_id")]
    # A component with no more than ``limit`` of them keeps all, so no count is needed.
    sampled = first_rows(ready.where(F.col("priority").isNull()), ["component"], order, limit).drop("place")
    return ready.where(F.col("priority").isNotNull()).unionByName(sampled)


def duplicate_ids(records: DataFrame, key: str | Sequence[str] = "id", by: Sequence[str] = ()) -> DataFrame:
    """Record ids that occur more than once within a project."""
    keys = [key] if isinstance(key, str) else list(key)
    return records.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


CHANGE_NUMBER = r"#[0-9]+"
SUBJECT_LENGTH, BODY_LENGTH = 50, 72


def commit_check(commits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Commits ``(sha, subject, body)`` and the message rules they break: one row per rule.

    The body is all that follows the first line, so a message with the due blank line has a body that starts with it.
    """
    subject, body = F.coalesce("subject", F.lit("")), F.coalesce("body", F.lit(""))
    rules = [
        ("no change request number", ~subject.rlike(CHANGE_NUMBER) & ~body.rlike(CHANGE_NUMBER)),
        ("subject too long", F.length(subject) > SUBJECT_LENGTH),
        ("subject not capitalised", subject.rlike(r"^\p{Ll}")),
        ("subject ends with a period", subject.endswith(".")),
        ("no blank line between subject and body", body.rlike(r"^[^\n]*\S")),
        ("body line too long", F.exists(F.split(body, "\n"), lambda line: F.length(line) > BODY_LENGTH)),
    ]
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules]))
    return commits.select(*by, "sha", F.explode(broken).alias("broken_rule"))


def release_gate(
    change_requests: DataFrame,
    links: DataFrame | None,
    reqs: DataFrame,
    tests: DataFrame,
    open_risks: DataFrame,
    by: str = "project_id",
    reports: DataFrame | None = None,
    accepted: DataFrame | None = None,
) -> DataFrame:
    """One row per project: what blocks a release, and whether nothing does.

    Planned requests must have changes, requirements must be tested, failures must be justified,
    and no risk may be left open. With ``reports`` (see ``failures_without_report``) a failed test that no
    problem report names blocks, and with ``accepted (by, id)`` a known anomaly that is not accepted does. Each part is counted per project, and the counts are stacked and
    summed, so no join between parts is needed.
    """
    if links is None:
        links = change_links(change_requests, [by])
    named = links.select(by, F.col("cr_id").alias("id")).distinct()
    count = F.count(F.lit(1))
    undone = change_requests.join(named, [by, "id"], "left_anti").groupBy(by).agg(
        F.count_if(~_is_problem()).alias("n_requests_open"), F.count_if(_is_problem()).alias("n_known_anomalies")
    )
    covered = requirement_coverage(reqs, tests, [by]).groupBy(by)
    parts = [
        change_requests.select(by).distinct(),
        undone,
        covered.agg(F.count_if(~F.col("covered")).alias("n_uncovered")),
        suite_verdict(tests, [by]).select(by, "n_unjustified"),
        open_risks.groupBy(by).agg(count.alias("n_open_risks")),
    ]
    blocking = ["n_requests_open", "n_uncovered", "n_unjustified", "n_open_risks"]
    if reports is not None:
        unnamed = failures_without_report(tests, reports, [by])
        parts.append(unnamed.groupBy(by).agg(count.alias("n_unreported_failures")))
        blocking.append("n_unreported_failures")
    if accepted is not None:
        known = change_requests.where(_is_problem()).join(named, [by, "id"], "left_anti")
        left = known.join(accepted.select(by, "id").distinct(), [by, "id"], "left_anti")
        parts.append(left.groupBy(by).agg(count.alias("n_unaccepted_anomalies")))
        blocking.append("n_unaccepted_anomalies")
    counts = [blocking[0], "n_known_anomalies", *blocking[1:]]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    zero = F.lit(0).cast("bigint")
    gate = together.groupBy(by).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in counts])
    return gate.withColumn("ready", reduce(lambda a, b: a & b, [F.col(c) == 0 for c in blocking]))
