"""Traceability queries over orders, lineitem, supplier, part, events and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import risk as rk
from ...operators import trace as tr
from .. import driver_tables as dt
from .registry import query

TESTS = """
tests AS (
  SELECT user_id % 25 AS project_id, user_id AS suite, event_id AS test_key, event_type AS name,
         CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END AS result,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS req_id,
         CASE WHEN value > 400 THEN 'justified: ' || event_id END AS note
  FROM events
)"""

REQUESTS = """
requests AS (
  SELECT o_custkey % 25 AS project_id, o_orderkey AS id, o_orderpriority AS title, o_orderstatus = 'P' AS is_problem_report,
         CASE WHEN o_totalprice < 50000 THEN CAST([] AS BIGINT[]) ELSE [o_custkey % 120, o_orderkey % 120] END AS change_ids
  FROM orders
)"""

CHANGES = """
changes AS (
  SELECT s_suppkey AS change_id, s_name AS implemented_by,
         CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal > 9000 THEN s_name ELSE 'nation ' || s_nationkey END AS verified_by
  FROM supplier
)"""


# ---- change requests and changes ---------------------------------------------------------------


@query(f"WITH {REQUESTS} SELECT id, title FROM requests WHERE NOT is_problem_report")
def change_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.plain_change_requests(dt.change_requests(spark, sf_dir)).select("id", "title")


@query(f"WITH {REQUESTS} SELECT id, title FROM requests WHERE is_problem_report AND len(change_ids) > 0")
def problem_reports_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.problem_reports_addressed(dt.change_requests(spark, sf_dir)).select("id", "title")


@query(
    f"""WITH {REQUESTS} SELECT id, title FROM requests
        WHERE is_problem_report AND id IN (SELECT l_orderkey FROM lineitem)"""
)
def problem_reports_addressed_by_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = dt.line_links(spark, sf_dir)
    return tr.problem_reports_addressed(dt.change_requests(spark, sf_dir), links).select("id", "title")


@query(
    """SELECT o_orderkey AS id, o_orderpriority AS title FROM orders
       WHERE o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def unresolved_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = dt.line_links(spark, sf_dir)
    return tr.unresolved_anomalies(dt.change_requests(spark, sf_dir), links).select("id", "title")


@query(f"WITH {REQUESTS} SELECT id, title FROM requests WHERE is_problem_report AND len(change_ids) = 0")
def unresolved_anomalies_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.unresolved_anomalies(dt.change_requests(spark, sf_dir)).select("id", "title")


RESOLVED = """SELECT r.id AS cr_id, r.title, l.position, l.change_id, c.implemented_by, c.verified_by,
                     CASE WHEN l.change_id IS NOT NULL THEN c.change_id IS NOT NULL END AS found
              FROM requests r LEFT JOIN links l ON l.cr_id = r.id LEFT JOIN changes c ON c.change_id = l.change_id"""


@query(
    f"""WITH {REQUESTS}, {CHANGES},
        links AS (SELECT l_orderkey AS cr_id, l_linenumber AS position, l_suppkey AS change_id FROM lineitem)
        {RESOLVED}"""
)
def resolve_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.resolve_changes(
        dt.change_requests(spark, sf_dir), dt.changes(spark, sf_dir), dt.line_links(spark, sf_dir)
    )


@query(
    f"""WITH {REQUESTS}, {CHANGES},
        links AS (SELECT id AS cr_id, CAST(i - 1 AS INTEGER) AS position, change_ids[i] AS change_id
                  FROM requests, generate_series(1, 2) g(i) WHERE i <= len(change_ids))
        {RESOLVED}"""
)
def resolve_changes_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.resolve_changes(dt.change_requests(spark, sf_dir), dt.changes(spark, sf_dir))


@query(
    """SELECT o_orderkey AS id, CASE WHEN o_totalprice < 50000 THEN 'not approved' ELSE 'approved by authors only' END
                AS finding, CASE WHEN o_totalprice < 50000 THEN 0 ELSE 1 END AS n_approvals
       FROM orders WHERE o_totalprice < 50000 OR o_totalprice > 450000 OR o_orderkey % 1000 = o_custkey"""
)
def review_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.review_check(dt.order_changes(spark, sf_dir)).select("id", "finding", "n_approvals")


@query(
    """SELECT o_orderkey AS change_id, 0 AS item_position, 'implements ' || o_orderkey AS item, o_orderstatus = 'F' AS ticked
       FROM orders WHERE o_totalprice BETWEEN 50000 AND 450000
       UNION ALL SELECT o_orderkey, 1, 'priority: ' || o_orderpriority, true
       FROM orders WHERE o_totalprice BETWEEN 50000 AND 450000"""
)
def approval_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = tr.approval_checklist(dt.order_changes(spark, sf_dir))
    return items.select("change_id", "item_position", "item", "ticked")


@query(
    """SELECT o_orderkey AS change_id, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END::BIGINT AS n_ticked,
              CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END::BIGINT AS n_unticked
       FROM orders WHERE o_totalprice BETWEEN 50000 AND 450000"""
)
def checklist_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.checklist_counts(tr.approval_checklist(dt.order_changes(spark, sf_dir)))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.duplicate_ids(dt.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- tests and requirements --------------------------------------------------------------------


@query(
    f"""WITH {TESTS}
        SELECT CASE WHEN name IN ('view', 'click') THEN 'unit' WHEN name IN ('signup', 'error') THEN 'integration'
                    ELSE 'manual' END AS kind,
               CASE WHEN name = 'purchase' THEN 'suite ' || suite ELSE CAST(test_key AS VARCHAR) END AS name,
               CASE WHEN name = 'purchase' THEN 1 END AS step, result, CAST(req_id AS VARCHAR) AS req_ids,
               coalesce(note, '') AS note FROM tests
        UNION ALL SELECT 'manual', 'suite ' || suite, 2, 'pass', CAST(req_id AS VARCHAR), ''
        FROM tests WHERE name = 'purchase'"""
)
def all_test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = dt.tests(spark, sf_dir)
    first = F.struct(
        F.lit(1).alias("step"), F.col("result"), F.col("req_ids"), F.col("note")
    )
    second = F.struct(
        F.lit(2).alias("step"), F.lit("pass").alias("result"), F.col("req_ids"), F.lit(None).cast("string").alias("note")
    )
    manual = tests.where(F.col("name") == "purchase").select(
        dt.text("suite ", F.col("suite")).alias("name"), F.array(first, second).alias("steps")
    )
    results = tr.all_test_results(
        tests.where(F.col("name").isin("view", "click")), tests.where(F.col("name").isin("signup", "error")), manual
    )
    return results.withColumn("req_ids", F.array_join("req_ids", ","))


@query(
    """SELECT s.o_orderkey AS spec_id, coalesce(s.req_id, c_custkey) AS req_id, c_name AS req_title,
              CASE WHEN s.o_orderkey IS NULL THEN 'requirement without specification'
                   WHEN c_custkey IS NULL THEN 'specification without requirement' ELSE 'mapped' END AS status
       FROM (SELECT o_orderkey, o_custkey + 20 AS req_id FROM orders) s
       FULL OUTER JOIN customer ON c_custkey = s.req_id"""
)
def spec_requirement_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = dt.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") + 20).alias("req_id")
    )
    reqs = dt.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    return tr.spec_to_requirement(specs, reqs)


@query(
    f"""WITH {TESTS}
        SELECT p_partkey AS id, p_name AS title, count(test_key) AS n_tests,
               count(*) FILTER (WHERE result = 'pass') AS n_pass, count(*) FILTER (WHERE result = 'fail') AS n_fail,
               count(test_key) > 0 AS covered
        FROM part LEFT JOIN tests ON req_id = p_partkey GROUP BY 1, 2"""
)
def requirement_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.requirement_coverage(dt.part_requirements(spark, sf_dir), dt.tests(spark, sf_dir))


@query(f"WITH {TESTS} SELECT p_partkey AS id, p_name AS title FROM part WHERE p_partkey NOT IN (SELECT req_id FROM tests)")
def uncovered_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = tr.uncovered_requirements(dt.part_requirements(spark, sf_dir), dt.tests(spark, sf_dir))
    return gaps.select("id", "title")


@query(
    f"""WITH {TESTS}
        SELECT suite, count(*) AS n_tests, count(*) FILTER (WHERE result <> 'pass') AS n_fail,
               count(*) FILTER (WHERE result <> 'pass' AND note IS NULL) AS n_unjustified,
               bool_and(result = 'pass' OR note IS NOT NULL) AS passed
        FROM tests GROUP BY 1"""
)
def suite_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.suite_verdict(dt.tests(spark, sf_dir), ["suite"])


@query(
    f"""WITH {TESTS} SELECT suite, test_key FROM tests WHERE result = 'fail'
        AND test_key NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""
)
def failures_without_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = dt.change_requests(spark, sf_dir).withColumn("test_key", F.col("id"))
    return tr.failures_without_report(dt.tests(spark, sf_dir), reports).select("suite", "test_key")


# ---- components, people, releases --------------------------------------------------------------

SOUP_SQL = (
    f"""SELECT p_name || ' ' || p_partkey AS title,
              coalesce(nullif(p_brand, 'Brand#1'), '{tr.NO_MANUFACTURER}') AS manufacturer,
              CAST(p_size AS VARCHAR) AS version, """
    + """{shown}
       FROM part"""
)
SHOWN_B = f"""p_type AS purpose, coalesce(nullif(p_type, 'ECONOMY'), '{tr.NO_REQUIREMENTS}') AS requirements,
              CASE WHEN p_size > 25 THEN '{tr.NO_ANOMALY_LIST}'
                   WHEN p_size > 10 THEN '{tr.NO_RELEVANT_ANOMALY.format(device="DEVICE")}' ELSE 'see ' || p_partkey END AS anomalies,
              CASE WHEN p_size <= 25 THEN 'list/' || p_partkey END AS anomaly_reference"""
SHOWN_A = """CAST(NULL AS VARCHAR) AS purpose, CAST(NULL AS VARCHAR) AS requirements, CAST(NULL AS VARCHAR) AS anomalies,
             CAST(NULL AS VARCHAR) AS anomaly_reference"""


def soup(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return dt.table(spark, sf_dir, "part").select(
        dt.text(F.col("p_name"), " ", F.col("p_partkey")).alias("title"),
        F.nullif("p_brand", F.lit("Brand#1")).alias("manufacturer"),
        size.cast("string").alias("version"),
        F.col("p_type").alias("purpose"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("requirements"),
        F.when(size <= 25, dt.text("list/", F.col("p_partkey"))).alias("anomaly_reference"),
        F.when(size <= 10, dt.text("see ", F.col("p_partkey"))).alias("relevant_anomalies"),
    )


@query(SOUP_SQL.format(shown=SHOWN_B))
def default_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.default_fields(soup(spark, sf_dir), "B", "DEVICE")


@query(SOUP_SQL.format(shown=SHOWN_A))
def default_fields_class_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.default_fields(soup(spark, sf_dir), "A", "DEVICE")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as people: segment and nation are their roles; a negative balance has no user name."""
    return dt.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.array(F.col("c_mktsegment"), dt.text("nation ", F.col("c_nationkey"))).alias("roles"),
        F.when(F.col("c_acctbal") < 0, F.array().cast("array<string>"))
        .otherwise(F.array(dt.text("user", F.col("c_custkey"))))
        .alias("git_host_usernames"),
    )


ROLES = """WITH roles AS (
  SELECT c_name AS name, c_mktsegment AS role, CASE WHEN c_acctbal >= 0 THEN 'user' || c_custkey END AS username FROM customer
  UNION ALL
  SELECT c_name, 'nation ' || c_nationkey, CASE WHEN c_acctbal >= 0 THEN 'user' || c_custkey END FROM customer
)"""


@query(ROLES + "SELECT role, name, username FROM roles")
def people_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.people_by_role(people(spark, sf_dir))


@query(
    ROLES
    + """SELECT role, count(*) AS n_people, count(username) AS n_usernames, min(name) AS first_name, max(name) AS last_name
         FROM roles GROUP BY 1"""
)
def role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.role_counts(people(spark, sf_dir))


@query("SELECT p_name AS term, p_partkey AS text FROM part")
def sorted_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = dt.table(spark, sf_dir, "part").select(F.col("p_name").alias("term"), F.col("p_partkey").alias("text"))
    return tr.sorted_terms(terms)


@query(
    r"""WITH lines AS (
          SELECT conv_id AS project_id, turn AS position, role,
                 CASE WHEN role = 'user' THEN 'in progress' ELSE 'turn ' || turn END AS date,
                 CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS changes FROM conversations)
        SELECT project_id, position, role || '-' || position AS release_id, date,
               CAST(unnest(range(len(changes))) AS INTEGER) AS line, unnest(changes) AS change
        FROM lines WHERE len(changes) > 0
        UNION ALL SELECT project_id, position, role || '-' || position, date, NULL, NULL FROM lines WHERE len(changes) = 0"""
)
def release_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.when(F.coalesce("text", F.lit("")) == "", F.array()).otherwise(F.split("text", "\n", -1))
    versions = dt.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("project_id"),
        F.col("turn").alias("position"),
        dt.text(F.col("role"), "-", F.col("turn")).alias("release_id"),
        F.when(F.col("role") != "user", dt.text("turn ", F.col("turn"))).alias("date"),
        lines.alias("changes"),
    )
    return tr.release_history(versions, ["project_id"])


@query(
    """WITH counts AS (
         SELECT p_brand AS software_item, year(o_orderdate) * 100 + month(o_orderdate) AS release, count(*) AS n_reports
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
         WHERE o_orderstatus = 'P' GROUP BY 1, 2)
       , releases AS (SELECT release, row_number() OVER (ORDER BY release) AS n FROM (SELECT DISTINCT release FROM counts)),
       filled AS (
         SELECT software_item, n, n_reports FROM counts JOIN releases USING (release)
         UNION ALL
         SELECT software_item, n + 1, 0 FROM counts JOIN releases r USING (release)
         WHERE EXISTS (SELECT 1 FROM releases x WHERE x.n = r.n + 1)
           AND NOT EXISTS (SELECT 1 FROM counts c JOIN releases x USING (release)
                           WHERE c.software_item = counts.software_item AND x.n = r.n + 1))
       SELECT f.software_item, CAST(release AS INTEGER) AS release, f.n_reports,
              CASE WHEN f.n > min(f.n) OVER (PARTITION BY f.software_item)
                   THEN f.n_reports - coalesce(b.n_reports, 0) END AS change,
              f.n_reports > 12 AS over_limit
       FROM filled f JOIN releases USING (n) LEFT JOIN filled b ON b.software_item = f.software_item AND b.n = f.n - 1"""
)
def problem_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dt.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    release = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    lines = dt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = dt.table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("software_item"))
    reports = (
        lines.join(orders.select("o_orderkey", release.alias("release")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select("software_item", "release")
    )
    return tr.problem_trends(reports, 12)


ANOMALIES = """
WITH anomalies AS (
  SELECT l_partkey AS component,
         l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || CAST(l_extendedprice * 100 AS BIGINT) AS anomaly_id,
         CASE l_returnflag WHEN 'A' THEN 'high' WHEN 'R' THEN 'low' END AS priority,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS review_class
  FROM lineitem)
"""


@query(
    ANOMALIES
    + """SELECT component, anomaly_id, priority, review_class FROM anomalies WHERE priority IS NOT NULL
         UNION ALL
         SELECT component, anomaly_id, priority, review_class FROM (
           SELECT *, row_number() OVER (PARTITION BY component ORDER BY review_class,
                                        md5('42:' || component || ':' || anomaly_id), anomaly_id) AS rn
           FROM anomalies WHERE priority IS NULL) WHERE rn <= 8"""
)
def anomaly_review_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    anomalies = dt.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("component"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", cents).alias("anomaly_id"),
        F.when(flag == "A", "high").when(flag == "R", "low").alias("priority"),
        (F.col("l_linestatus") == "O").alias("portion_used"),
    )
    return tr.anomaly_review_list(anomalies, limit=8).drop("portion_used")


@query(
    r"""WITH commits AS (
          SELECT conv_id || '-' || turn AS sha, text, string_split(text, chr(10)) AS lines FROM conversations)
        SELECT sha, 'no change request number' AS broken_rule FROM commits WHERE NOT regexp_matches(text, '#[0-9]+')
        UNION ALL SELECT sha, 'subject too long' FROM commits WHERE length(lines[1]) > 50
        UNION ALL SELECT sha, 'subject not capitalised' FROM commits WHERE regexp_matches(lines[1], '^\p{Ll}')
        UNION ALL SELECT sha, 'subject ends with a period' FROM commits WHERE lines[1] LIKE '%.'
        UNION ALL SELECT sha, 'no blank line between subject and body' FROM commits WHERE regexp_matches(lines[2], '\S')
        UNION ALL SELECT sha, 'body line too long' FROM commits
                  WHERE len([x FOR x IN lines[2:] IF length(x) > 72]) > 0"""
)
def commit_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.commit_check(dt.commits(spark, sf_dir))


# ---- risk --------------------------------------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


RISKS = f"""
WITH matrix AS (
  SELECT i, j, m[i][j] AS level FROM (SELECT [{', '.join(_list(row) for row in rk.LEVEL_MATRIX)}] AS m),
         generate_series(1, 5) a(i), generate_series(1, 5) b(j)
), risks AS (
  SELECT p_partkey % 25 AS project_id, p_partkey AS id, p_size % 5 + 1 AS p,
         CASE WHEN CAST(floor(p_retailprice) AS BIGINT) % 6 < 5 THEN CAST(floor(p_retailprice) AS BIGINT) % 6 + 1 END AS s,
         CASE WHEN p_size > 20 THEN 2 ELSE p_size % 5 + 1 END AS rp,
         CASE WHEN p_size > 30 THEN 2
              WHEN CAST(floor(p_retailprice) AS BIGINT) % 6 < 5 THEN CAST(floor(p_retailprice) AS BIGINT) % 6 + 1 END AS rs,
         p_size > 10 AS controlled
  FROM part
), leveled AS (
  SELECT r.*, m.level, n.level AS residual_level FROM risks r
  LEFT JOIN matrix m ON m.i = r.p AND m.j = r.s LEFT JOIN matrix n ON n.i = r.rp AND n.j = r.rs
), open_risks AS (
  SELECT project_id, id, CASE WHEN residual_level IS NULL OR residual_level <> 'Low' THEN 'residual level too high'
                  ELSE 'no control measure' END AS reason
  FROM leveled WHERE residual_level IS NULL OR residual_level <> 'Low'
             OR ((level IS NULL OR level <> 'Low') AND NOT controlled)
)"""


@query(RISKS + "SELECT id, level, residual_level FROM leveled")
def risk_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rk.risk_level(dt.risks(spark, sf_dir)).select("id", "level", "residual_level")


@query(RISKS + "SELECT id, reason FROM open_risks")
def residual_risk_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rk.residual_risk_open(dt.risks(spark, sf_dir)).select("id", "reason")


INJURIES = list(rk.SEVERITY_BY_INJURY)

HAZARDS = f"""
WITH hazards AS (
  SELECT p_partkey AS id, ({_list(INJURIES)})[CAST(floor(p_retailprice) AS BIGINT) % 4 + 1] AS injury, p_size > 25 AS multiple,
         ({_list(rk.LIKELIHOODS)})[p_size % 5 + 1] AS likelihood FROM part
), classed AS (
  SELECT *, CASE injury
    WHEN 'death or permanent' THEN CASE WHEN multiple THEN 'Catastrophic' ELSE 'Major' END
    WHEN 'severe' THEN CASE WHEN multiple THEN 'Major' ELSE 'Considerable' END
    WHEN 'minor, slow recovery' THEN CASE WHEN multiple THEN 'Considerable' ELSE 'Significant' END
    WHEN 'minor, quick recovery' THEN CASE WHEN multiple THEN 'Significant' ELSE 'Minor' END END AS severity
  FROM hazards
), scored AS (
  SELECT *, ([{', '.join(str(list(row)) for row in rk.SCORE_MATRIX)}])
            [list_position({_list(rk.LIKELIHOODS)}, likelihood)]
            [list_position({_list(rk.CLINICAL_SEVERITIES)}, severity)] AS score FROM classed
)"""


def hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    injury = F.get(F.array(*[F.lit(i) for i in INJURIES]), (F.floor("p_retailprice") % 4).cast("int"))
    likelihood = F.get(F.array(*[F.lit(v) for v in rk.LIKELIHOODS]), (F.col("p_size") % 5).cast("int"))
    return dt.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        injury.alias("injury"),
        (F.col("p_size") > 25).alias("multiple"),
        likelihood.alias("likelihood"),
    )


@query(HAZARDS + "SELECT id, injury, multiple, severity FROM classed")
def severity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rk.severity_class(hazards(spark, sf_dir)).select("id", "injury", "multiple", "severity")


@query(
    HAZARDS
    + """SELECT id, likelihood, severity, CAST(score AS INTEGER) AS score,
                CASE WHEN score <= 2 THEN 'acceptable' WHEN score = 3 THEN 'undesirable' ELSE 'unacceptable' END AS band
         FROM scored"""
)
def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rk.risk_score(rk.severity_class(hazards(spark, sf_dir)))
    return scored.select("id", "likelihood", "severity", "score", "band")


@query(
    """WITH tested AS (
         SELECT l_orderkey AS req_id, count(*) AS n_tests, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_pass
         FROM lineitem GROUP BY 1)
       SELECT p_partkey AS risk_id, p_brand AS software_item, p_type AS events, p_name AS hazard, c.req_id,
              CASE WHEN o_orderkey IS NOT NULL THEN coalesce(n_tests, 0) END AS n_tests,
              CASE WHEN o_orderkey IS NOT NULL THEN coalesce(n_pass, 0) END AS n_pass,
              CASE WHEN c.req_id IS NULL THEN 'no control' WHEN o_orderkey IS NULL THEN 'unknown requirement'
                   WHEN n_tests IS NULL THEN 'not tested' WHEN n_pass < n_tests THEN 'test fails' ELSE 'complete' END AS trace
       FROM part LEFT JOIN (SELECT p_partkey AS k, p_partkey * 10 AS req_id FROM part WHERE p_size > 10) c ON c.k = p_partkey
       LEFT JOIN orders ON o_orderkey = c.req_id LEFT JOIN tested ON tested.req_id = o_orderkey"""
)
def risk_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    risks = dt.risks(spark, sf_dir)
    controls = risks.where(F.col("control_measures").isNotNull()).select(
        F.col("id").alias("risk_id"), (F.col("id") * 10).alias("req_id")
    )
    reqs = dt.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title")
    )
    tests = dt.table(spark, sf_dir, "lineitem").select(
        F.array("l_orderkey").alias("req_ids"),
        F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass").alias("result"),
    )
    return rk.risk_trace(risks, controls, reqs, tests)


@query(
    RISKS
    + f""", {TESTS}, {REQUESTS},
      projects AS (SELECT project_id FROM requests UNION SELECT p_partkey % 25 FROM part UNION SELECT project_id FROM tests),
      linked AS (SELECT *, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = id) AS done FROM requests),
      gate AS (
        SELECT project_id,
               (SELECT count(*) FROM linked l WHERE l.project_id = p.project_id AND NOT is_problem_report AND NOT done)
                 AS n_requests_open,
               (SELECT count(*) FROM linked l WHERE l.project_id = p.project_id AND is_problem_report AND NOT done)
                 AS n_known_anomalies,
               (SELECT count(*) FROM part WHERE p_partkey % 25 = p.project_id AND NOT EXISTS (
                  SELECT 1 FROM tests t WHERE t.req_id = p_partkey AND t.project_id = p.project_id)) AS n_uncovered,
               (SELECT count(*) FROM tests t WHERE t.project_id = p.project_id AND result = 'fail' AND note IS NULL)
                 AS n_unjustified,
               (SELECT count(*) FROM open_risks r WHERE r.project_id = p.project_id) AS n_open_risks
        FROM projects p)
      SELECT *, n_requests_open = 0 AND n_uncovered = 0 AND n_unjustified = 0 AND n_open_risks = 0 AS ready FROM gate"""
)
def release_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = dt.line_links(spark, sf_dir).join(
        dt.change_requests(spark, sf_dir).select("project_id", F.col("id").alias("cr_id")), "cr_id"
    )
    return tr.release_gate(
        dt.change_requests(spark, sf_dir),
        links,
        dt.part_requirements(spark, sf_dir),
        dt.tests(spark, sf_dir),
        rk.residual_risk_open(dt.risks(spark, sf_dir)),
    )


@query(
    RISKS
    + """, levels AS (
           SELECT n_nationkey AS project_id, i, j, ['Low', 'Medium', 'High'][(i + j + n_nationkey) % 3 + 1] AS level
           FROM nation, generate_series(1, 5) a(i), generate_series(1, 5) b(j))
         SELECT r.id, m.level, n.level AS residual_level FROM risks r
         LEFT JOIN levels m ON m.project_id = r.project_id AND m.i = r.p AND m.j = r.s
         LEFT JOIN levels n ON n.project_id = r.project_id AND n.i = r.rp AND n.j = r.rs"""
)
def risk_level_by_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every project has its own matrix, a table of 25 cells."""
    cells = [
        F.struct(F.lit(p).alias("probability"), F.lit(s).alias("severity"), F.lit(i + j).alias("sum"))
        for i, p in enumerate(rk.PROBABILITY_LEVELS, 1)
        for j, s in enumerate(rk.SEVERITY_LEVELS, 1)
    ]
    names = F.array(F.lit("Low"), F.lit("Medium"), F.lit("High"))
    nations = dt.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("project_id"), F.explode(F.array(*cells)).alias("c")
    )
    matrix = nations.select(
        "project_id", "c.probability", "c.severity", F.get(names, (F.col("c.sum") + F.col("project_id")).cast("int") % 3).alias("level")
    )
    return rk.risk_level(dt.risks(spark, sf_dir), matrix, ["project_id"]).select("id", "level", "residual_level")


@query(
    f"""WITH {TESTS}, {REQUESTS},
        linked AS (SELECT *, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = id) AS done FROM requests)
        SELECT p.project_id,
               (SELECT count(*) FROM tests t WHERE t.project_id = p.project_id AND result = 'fail' AND NOT EXISTS (
                  SELECT 1 FROM requests r WHERE r.project_id = t.project_id AND r.id = t.test_key AND is_problem_report))
                 AS n_unreported_failures,
               (SELECT count(*) FROM linked l WHERE l.project_id = p.project_id AND is_problem_report AND NOT done
                  AND id % 2 = 1) AS n_unaccepted_anomalies
        FROM (SELECT project_id FROM requests UNION SELECT p_partkey % 25 FROM part UNION SELECT project_id FROM tests) p"""
)
def release_gate_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures that no problem report names, and known anomalies that are not accepted."""
    requests = dt.change_requests(spark, sf_dir)
    links = dt.line_links(spark, sf_dir).join(requests.select("project_id", F.col("id").alias("cr_id")), "cr_id")
    reports = requests.select("project_id", F.col("id").alias("test_key"), "is_problem_report")
    gate = tr.release_gate(
        requests,
        links,
        dt.part_requirements(spark, sf_dir),
        dt.tests(spark, sf_dir),
        rk.residual_risk_open(dt.risks(spark, sf_dir)),
        reports=reports,
        accepted=requests.where("id % 2 = 0").select("project_id", "id"),
    )
    return gate.select("project_id", "n_unreported_failures", "n_unaccepted_anomalies")
