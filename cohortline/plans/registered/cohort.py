"""Catalog, samples, splits and statistics over customer, orders, lineitem and part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.classes import map_labels
from ...operators import catalog as cat
from ...operators import profiles
from ...operators import samples as smp
from ...operators import splits, stats
from ...sources.storage import settle
from .. import driver_tables as dt
from ..cohort_run import label_action, run_cohort, scan_action
from .registry import query

SCAN_CODES, LABEL_CODES = ("URGENT", "HIGH"), ("URGENT", "MEDIUM")
REQUIRED = ("fetch_xr", "fetch_label")
LABEL_DICT = {"Urgent": 1, "High": 2, "Medium": 3, "Unspecified": 4, "Low": 5}
SEGMENTS = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": None}


def actions() -> list[smp.Action]:
    return [scan_action(SCAN_CODES), label_action(LABEL_CODES)]


def built(spark: SparkSession, sf_dir: str, on_failure: str = "keep_partial") -> smp.Samples:
    return smp.build_samples(dt.catalog(spark, sf_dir), actions(), on_failure)


def cohort(spark: SparkSession, sf_dir: str):
    return run_cohort(dt.catalog(spark, sf_dir), actions(), REQUIRED)


CATALOG = """
WITH subjects AS (
  SELECT c_custkey AS subject_key, c_name AS subject_id, '/subjects/' || c_custkey AS subject_uri FROM customer
), experiments AS (
  SELECT o_custkey AS subject_key, CAST(o_orderkey AS VARCHAR) AS exp_key,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS exp_ordinal,
         o_orderpriority AS modality,
         CASE WHEN o_totalprice > 490000 THEN o_orderstatus
              ELSE o_orderstatus || '_' || substr(o_orderpriority, 1, 1) END AS label
  FROM orders
), scans AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS exp_key,
         l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS BIGINT) AS scan_key,
         CAST(l_linenumber AS BIGINT) AS scan_ordinal, l_returnflag || l_linestatus AS series_description,
         '/scans/' || l_orderkey || '/' || l_linenumber || '/' || l_partkey || '-' || l_suppkey AS uri
  FROM lineitem
)"""

SCAN_ROWS = """
, xr AS (
  SELECT e.subject_key, s.uri, e.exp_ordinal, e.exp_key, s.scan_ordinal, s.scan_key
  FROM experiments e JOIN scans s ON e.exp_key = s.exp_key
  WHERE contains(e.modality, 'URGENT') OR contains(e.modality, 'HIGH')
), matched AS (
  SELECT subject_key, exp_ordinal, exp_key, TRY_CAST(split_part(label, '_', 2) AS BIGINT) AS number
  FROM experiments WHERE contains(modality, 'URGENT') OR contains(modality, 'MEDIUM')
), latest AS (
  SELECT subject_key, number,
         row_number() OVER (PARTITION BY subject_key ORDER BY exp_ordinal DESC, exp_key DESC) AS rn,
         bool_or(number IS NULL) OVER (PARTITION BY subject_key) AS error
  FROM matched
), lab AS (
  SELECT subject_key, CASE WHEN NOT error THEN number END AS label, error FROM latest WHERE rn = 1
), states AS (
  SELECT s.*, CASE WHEN x.n IS NULL THEN 'missing' ELSE 'ok' END AS xr_state, coalesce(x.n, 0) AS n_xr,
         CASE WHEN l.error THEN 'error' WHEN l.label IS NULL THEN 'missing' ELSE 'ok' END AS lab_state, l.label
  FROM subjects s
  LEFT JOIN (SELECT subject_key, count(*) AS n FROM xr GROUP BY 1) x ON x.subject_key = s.subject_key
  LEFT JOIN lab l ON l.subject_key = s.subject_key
)"""

PARTIAL_ITEMS = """
, items AS (
  SELECT st.subject_key, st.subject_id, 0 AS action_ordinal, 'fetch_xr' AS source_action, x.uri AS action_data,
         'xnat_uri' AS data_type, 'image' AS data_label, x.exp_ordinal, x.exp_key, x.scan_ordinal, x.scan_key
  FROM states st JOIN xr x ON x.subject_key = st.subject_key
  UNION ALL
  SELECT subject_key, subject_id, 1, 'fetch_label', CAST(label AS VARCHAR), 'value', 'label',
         NULL, NULL, NULL, NULL
  FROM states WHERE xr_state = 'ok' AND lab_state = 'ok'
)"""

VALID = """
, valid AS (SELECT * FROM states WHERE xr_state = 'ok' AND lab_state = 'ok')
, split AS (
  SELECT *, CASE WHEN u < 0.5 THEN 'train' WHEN u < 0.75 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, CAST(('0x' || substr(md5('42:' || subject_key), 1, 8)) AS UBIGINT) / 4294967296.0 AS u FROM valid)
)"""

COHORT = CATALOG + SCAN_ROWS
ITEM_COLUMNS = ["subject_id", "action_ordinal", "source_action", "action_data", "data_type", "data_label"]

STATS = """
, counts AS (
  SELECT split, label, count(*) AS n FROM split GROUP BY 1, 2
), stats AS (
  SELECT split, 'n_samples' AS stat, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value
  FROM split GROUP BY 1
  UNION ALL SELECT split, 'N', CAST(label AS VARCHAR), CAST(n AS DOUBLE) FROM counts
  UNION ALL
  SELECT c.split, 'class_weights', CAST(c.label AS VARCHAR), round(t.n / (t.k * c.n), 6)
  FROM counts c JOIN (SELECT split, sum(n)::DOUBLE AS n, count(*) AS k FROM counts GROUP BY 1) t ON c.split = t.split
)"""


@query(
    """SELECT 'subjects' AS level, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'experiments', count(*) FROM orders
       UNION ALL SELECT 'scans', count(*) FROM lineitem
       UNION ALL SELECT 'resources', count(*) FROM part"""
)
def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.catalog_counts(dt.catalog(spark, sf_dir))


@query("SELECT '/subjects/' || c_custkey AS subject_uri, c_name AS subject_id FROM customer")
def sample_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.sample_base(dt.catalog(spark, sf_dir)).drop("subject_key")


@query(
    CATALOG
    + """SELECT s.subject_id, e.exp_key, e.label, c.uri, c.series_description
         FROM subjects s LEFT JOIN experiments e ON s.subject_key = e.subject_key
         LEFT JOIN scans c ON e.exp_key = c.exp_key"""
)
def catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = cat.catalog_join(dt.catalog(spark, sf_dir))
    return joined.select("subject_id", "exp_key", "label", "uri", "series_description")


@query(
    CATALOG
    + """SELECT e.subject_key, e.exp_key, s.uri FROM experiments e JOIN scans s ON e.exp_key = s.exp_key
         WHERE contains(e.modality, 'URGENT') OR contains(e.modality, 'HIGH')"""
)
def scans_by_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.scans_by_modality(dt.catalog(spark, sf_dir), SCAN_CODES).select("subject_key", "exp_key", "uri")


@query(
    CATALOG
    + """SELECT subject_key, exp_key, uri, series_description FROM (
           SELECT e.subject_key, e.exp_key, s.uri, s.series_description, row_number() OVER (
             PARTITION BY e.subject_key
             ORDER BY e.exp_ordinal, e.exp_key, s.scan_ordinal, s.scan_key, s.series_description, s.uri) AS rn
           FROM experiments e JOIN scans s ON e.exp_key = s.exp_key
           WHERE contains(e.label, 'P_') AND contains(s.series_description, 'N')) WHERE rn = 1"""
)
def first_scan_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = cat.scans_by_series(dt.catalog(spark, sf_dir), "P_", "N")
    return first.select("subject_key", "exp_key", "uri", "series_description")


@query(COHORT + "SELECT subject_key, label, error FROM lab")
def label_from_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.label_from_experiment(dt.catalog(spark, sf_dir), LABEL_CODES)


@query(
    """SELECT CAST(trim(split_part(o_orderpriority, '-', 1)) AS BIGINT) AS label, false AS error, o_custkey AS subject_key
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
               ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn
             FROM orders WHERE contains(o_orderpriority, 'U') OR contains(o_orderpriority, 'LOW')) WHERE rn = 1"""
)
def label_from_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dataclasses import replace

    catalog = dt.catalog(spark, sf_dir)
    named = replace(catalog, experiments=catalog.experiments.withColumn("label", F.col("modality")))
    return cat.label_from_experiment(named, ("U", "LOW"), "-", 0)


@query(
    COHORT + PARTIAL_ITEMS + f"SELECT {', '.join(ITEM_COLUMNS)} FROM items"
)
def build_samples_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).items.select(*ITEM_COLUMNS)


@query(
    COHORT
    + """SELECT st.subject_id, 0 AS action_ordinal, 'fetch_xr' AS source_action, x.uri AS action_data,
                'xnat_uri' AS data_type, 'image' AS data_label
         FROM states st JOIN xr x ON x.subject_key = st.subject_key WHERE st.lab_state <> 'error'"""
)
def build_samples_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.surviving(built(spark, sf_dir, "drop")).items.select(*ITEM_COLUMNS)


@query(
    COHORT
    + """SELECT subject_id, xr_state AS status, 0 AS action_ordinal FROM states
         UNION ALL SELECT subject_id, lab_state, 1 FROM states WHERE xr_state = 'ok'"""
)
def action_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).status.select("subject_id", "status", "action_ordinal")


@query(
    COHORT
    + """SELECT subject_id, n_items FROM (
           SELECT subject_id, n_xr + CASE WHEN xr_state = 'ok' AND lab_state = 'ok' THEN 1 ELSE 0 END AS n_items
           FROM states) WHERE n_items >= 2"""
)
def complete_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = smp.complete_samples(built(spark, sf_dir))
    return complete.subjects.select("subject_id", complete.n_items().alias("n_items"))


@query(COHORT + "SELECT subject_id FROM states WHERE xr_state = 'ok' AND lab_state = 'ok'")
def complete_samples_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.complete_samples(built(spark, sf_dir), by="groups").subjects.select("subject_id")


@query(
    COHORT
    + """SELECT subject_key AS subject_id, subject_id AS subject_label,
                CASE WHEN xr_state = 'missing' THEN 'fetch_xr' ELSE 'fetch_label' END AS failed_action
         FROM states WHERE xr_state = 'missing' OR lab_state = 'missing'"""
)
def missing_data_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.missing_data_log(built(spark, sf_dir))


@query(COHORT + VALID + "SELECT subject_id FROM valid")
def validate_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.validate_samples(built(spark, sf_dir), REQUIRED).subjects.select("subject_id")


@query(
    COHORT
    + """SELECT count(*) FILTER (WHERE NOT (xr_state = 'ok' AND lab_state = 'ok')) AS n_invalid,
                count(*) AS n_samples FROM states"""
)
def invalid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.invalid_count(built(spark, sf_dir), REQUIRED)


NESTED_SQL = (
    COHORT
    + PARTIAL_ITEMS
    + """, placed AS (
           SELECT *, row_number() OVER (PARTITION BY subject_key ORDER BY action_ordinal, exp_ordinal, exp_key,
                                        scan_ordinal, scan_key, action_data) - 1 AS at FROM items
         ), whole AS (
           SELECT st.subject_id, coalesce(p.at // {size}, 0) AS chunk, count(p.at) AS n_items,
                  arg_min(p.action_data, p.at) AS first_item, arg_max(p.action_data, p.at) AS last_item,
                  CASE WHEN st.xr_state <> 'ok' THEN 0 WHEN st.lab_state <> 'ok' THEN 1 ELSE 2 END AS n_groups
           FROM states st LEFT JOIN placed p ON p.subject_key = st.subject_key GROUP BY ALL
         )
         SELECT subject_id, chunk, max(chunk) OVER (PARTITION BY subject_id) + 1 AS n_chunks, n_groups, n_items,
                first_item, last_item FROM whole"""
)


def _nested(nested: DataFrame) -> DataFrame:
    flat = smp.flatten_items(nested.withColumn("n_groups", F.size("data")))
    return flat.select(
        "subject_id",
        "chunk",
        "n_chunks",
        "n_groups",
        F.size("data").cast("bigint").alias("n_items"),
        F.get("data", F.lit(0)).getField("action_data").alias("first_item"),
        F.try_element_at("data", F.lit(-1)).getField("action_data").alias("last_item"),
    )


@query(NESTED_SQL.format(size=10000))
def nest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(smp.nest_items(built(spark, sf_dir)))


@query(NESTED_SQL.format(size=20))
def nest_items_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(smp.nest_items(built(spark, sf_dir), chunk_size=20))


@query(
    """SELECT '/resources/' || l_partkey AS uri, l_orderkey, l_linenumber,
              CASE WHEN p_size <= 25 THEN p_name || '.dcm,' || p_type || '.txt' END AS files
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""
)
def resource_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = dt.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", dt.text("/resources/", F.col("l_partkey")).alias("action_data")
    )
    found = cat.attach_resource_files(items, dt.catalog(spark, sf_dir).resources)
    files = F.when(F.col("resource_files").isNotNull(), F.array_join("resource_files", ","))
    return found.select(F.col("action_data").alias("uri"), "l_orderkey", "l_linenumber", files.alias("files"))


@query(
    COHORT
    + PARTIAL_ITEMS
    + "SELECT subject_id, data_label, count(*) AS n_items FROM items GROUP BY 1, 2 HAVING count(*) > 1"
)
def duplicate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.duplicate_labels(built(spark, sf_dir).items).drop("subject_key")


@query(COHORT + VALID + "SELECT subject_id, CAST(label AS VARCHAR) AS label FROM valid")
def promote_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.promote_values(built(spark, sf_dir).value_items, ["label"]).select("subject_id", "label")


@query("SELECT c_custkey AS subject_key, c_name AS subject_id FROM customer")
def select_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smp.select_items(dt.catalog(spark, sf_dir).subjects, ["image", "subject_key", "subject_id"])


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
              WHEN 'FURNITURE' THEN 2 END AS label FROM customer"""
)
def label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = map_labels(F.col("c_mktsegment"), SEGMENTS)
    return dt.table(spark, sf_dir, "customer").select("c_custkey", label.alias("label"))


@query(COHORT + VALID + "SELECT subject_id, label FROM valid")
def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = smp.validate_samples(built(spark, sf_dir), REQUIRED)
    return stats.get_labels(valid.value_items).select("subject_id", "label")


@query(
    """WITH counts AS (SELECT quality AS label, count(*) AS n_class FROM labels GROUP BY 1)
       SELECT label, n_class, round((SELECT sum(n_class)::DOUBLE FROM counts) /
              ((SELECT count(*) FROM counts) * n_class), 6) AS weight FROM counts"""
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = stats.class_weights(dt.table(spark, sf_dir, "labels").select(F.col("quality").alias("label")))
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    """WITH counts AS (SELECT lang, quality AS label, count(*) AS n_class
                       FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2)
       SELECT c.lang, c.label, c.n_class, round(t.n / (t.k * c.n_class), 6) AS weight
       FROM counts c JOIN (SELECT lang, sum(n_class)::DOUBLE AS n, count(*) AS k FROM counts GROUP BY 1) t
       ON c.lang = t.lang"""
)
def class_weights_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = dt.table(spark, sf_dir, "labels").join(
        dt.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id"
    )
    weights = stats.class_weights(labelled.select("lang", F.col("quality").alias("label")), ["lang"])
    return weights.withColumn("weight", F.round("weight", 6))


@query(COHORT + VALID + STATS + "SELECT split, stat, key, value FROM stats")
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort(spark, sf_dir).stats().withColumn("value", F.round("value", 6))


@query(
    COHORT
    + VALID
    + STATS
    + """SELECT split, stat, key, value FROM stats
         UNION ALL SELECT NULL, 'N_patients', NULL, CAST(count(*) AS DOUBLE) FROM valid
         UNION ALL SELECT NULL, 'labels', name, id FROM (VALUES ('Urgent', 1.0::DOUBLE), ('High', 2.0), ('Medium', 3.0),
                                                                ('Unspecified', 4.0), ('Low', 5.0)) v(name, id)"""
)
def data_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort(spark, sf_dir).manifest(LABEL_DICT).withColumn("value", F.round("value", 6))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
                   count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value,
                   CAST(max({c}) AS VARCHAR) AS max_value FROM documents"""
        for c in ("doc_id", "lang", "source", "n_chars")
    )
)
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dataset_profile(dt.table(spark, sf_dir, "documents"), ["doc_id", "lang", "source", "n_chars"])


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM documents"
        for c in ("doc_id", "lang", "source", "n_chars", "text")
    )
)
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts included: only digests travel."""
    return profiles.exact_distinct(dt.table(spark, sf_dir, "documents"), ["doc_id", "lang", "source", "n_chars", "text"])


def _near(estimate: Column, exact: Column, share: float = 0.1) -> Column:
    """Within six standard errors of the sketches, which is true of any table but one in millions."""
    return F.abs(estimate - exact) <= F.lit(share) * exact


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
                   CAST(min({m}) AS DOUBLE) AS low, CAST(max({m}) AS DOUBLE) AS high, true AS distinct_near, true AS median_near
            FROM documents"""
        for c, m in (("doc_id", "doc_id"), ("n_chars", "n_chars"), ("text", "length(text)"))
    )
)
def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored per source and language, merged without the rows, next to the exact counts.

    The median is near if the share of rows below it is within five standard errors of one half.
    """
    columns = ["doc_id", "n_chars", "text"]
    docs = dt.table(spark, sf_dir, "documents").select("source", "lang", *columns)
    stored = settle(profiles.profile_sketches(docs, columns, ["source", "lang"]))
    by_source = profiles.merge_sketches(stored, ["source"])
    read = profiles.read_profile(profiles.merge_sketches(by_source))
    median = read.select("column_name", F.get("quantiles", F.lit(2)).alias("median"), "n_rows", "n_null")
    measures = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), (F.length(c) if c == "text" else F.col(c)).cast("double").alias("measure"))
            for c in columns
        ]
    )
    below = (
        docs.select(F.inline(measures))
        .join(median, "column_name")
        .groupBy("column_name")
        .agg(
            F.count_if(F.col("measure") < F.col("median")).alias("less"),
            F.count_if(F.col("measure") <= F.col("median")).alias("upto"),
            F.count("measure").alias("n"),
        )
    )
    half = (F.col("less") <= 0.57 * F.col("n")) & (F.col("upto") >= 0.43 * F.col("n"))
    exact = profiles.exact_distinct(docs, columns)
    return (
        read.withColumnRenamed("n_distinct", "estimate")
        .join(exact, "column_name")
        .join(below.select("column_name", half.alias("median_near")), "column_name")
        .select(
            "column_name", "n_rows", "n_null", "n_distinct", "low", "high",
            _near(F.col("estimate"), F.col("n_distinct")).alias("distinct_near"), "median_near",
        )
    )


@query(
    """WITH g AS (SELECT DISTINCT o_orderpriority AS p, o_custkey AS c FROM orders WHERE o_custkey IS NOT NULL),
            n AS (SELECT p, count(*) AS n FROM g GROUP BY p)
       SELECT a.p AS left_group, b.p AS right_group, count(*) AS n_shared, true AS shared_near
       FROM g a JOIN g b ON a.c = b.c AND a.p < b.p GROUP BY 1, 2"""
)
def shared_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that two groups of experiments share, by theta sketches, next to the exact count.

    The estimate of a shared part errs with the size of both groups: near is within a tenth of the smaller.
    """
    orders = dt.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_custkey").alias("c"))
    estimated = profiles.shared_values(profiles.profile_sketches(orders, ["c"], ["p"]), "p", "c")
    groups = orders.where(F.col("c").isNotNull()).groupBy("c").agg(F.sort_array(F.collect_set("p")).alias("ps"))
    # A subject has at most as many entries here as there are priorities.
    pairs = groups.select(F.explode("ps").alias("left_group"), "ps").select("left_group", F.explode("ps").alias("right_group"))
    exact = (
        pairs.where(F.col("left_group") < F.col("right_group"))
        .groupBy("left_group", "right_group")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    least = F.least("n_left", "n_right")
    return (
        estimated.withColumnRenamed("n_shared", "estimate")
        .join(exact, ["left_group", "right_group"])
        .select("left_group", "right_group", "n_shared", (F.abs(F.col("estimate") - F.col("n_shared")) <= 0.1 * least).alias("shared_near"))
    )


@query(
    """WITH joined AS (SELECT lang, quality AS label FROM labels JOIN documents USING (doc_id)),
       c AS (SELECT lang, label, count(*)::DOUBLE AS n FROM joined GROUP BY 1, 2)
       SELECT lang, label, CAST(n AS BIGINT) AS n, round(n / (SELECT sum(n) FROM c i WHERE i.lang = c.lang), 6) AS share,
              round(n / (SELECT sum(n) FROM c i WHERE i.lang = c.lang)
                    - (SELECT sum(n) FROM c i WHERE i.label = c.label) / (SELECT sum(n) FROM c), 6) AS bias
       FROM c"""
)
def label_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = dt.table(spark, sf_dir, "labels").join(
        dt.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id"
    )
    bias = stats.label_bias(labelled.select("lang", F.col("quality").alias("label")), "lang")
    return bias.withColumn("share", F.round("share", 6)).withColumn("bias", F.round("bias", 6))


@query(
    """SELECT user_id AS run_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch,
              event_type AS metric, round(sum(value * w) / sum(w), 9) AS value, count(*) AS n_steps
       FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS w FROM events)
       GROUP BY 1, 2, 3"""
)
def epoch_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of amounts in cents often end in an exact half at six places, where the order of a sum
    of doubles decides the rounding; nine places keep clear of that."""
    return stats.epoch_metric(dt.metric_log(spark, sf_dir)).withColumn("value", F.round("value", 9))


# ---- splits ------------------------------------------------------------------------------------

HASHED = """
WITH hashed AS (SELECT c_custkey AS subject_key, c_name AS subject_id, md5('42:' || c_custkey) AS h FROM customer)
"""


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.catalog(spark, sf_dir).subjects.select("subject_key", "subject_id")


@query(HASHED + "SELECT subject_key, subject_id FROM hashed ORDER BY h, subject_key LIMIT 100")
def bounded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.bounded_sample(subjects(spark, sf_dir), 100)


SPLIT = (
    HASHED
    + """, split AS (
           SELECT *, CASE WHEN u < 0.5 THEN 'train' WHEN u < 0.75 THEN 'validation' ELSE 'test' END AS split
           FROM (SELECT *, CAST(('0x' || substr(h, 1, 8)) AS UBIGINT) / 4294967296.0 AS u FROM hashed))"""
)


@query(SPLIT + "SELECT subject_key, split FROM split WHERE split = 'train' ORDER BY md5('7:' || subject_key), 1 LIMIT 24")
def preview_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = splits.split_samples(subjects(spark, sf_dir))
    return splits.preview_sample(split, 24, seed=7).select("subject_key", "split")


@query(SPLIT + "SELECT subject_key, split FROM split")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_samples(subjects(spark, sf_dir)).select("subject_key", "split")


@query(
    HASHED
    + """, placed AS (SELECT *, row_number() OVER (ORDER BY h, subject_key) AS r, count(*) OVER () AS n FROM hashed)
         SELECT subject_key, CASE WHEN r <= n - ceil(n / 2.0) THEN 'train'
                                  WHEN r <= n - ceil(ceil(n / 2.0) / 2.0) THEN 'validation' ELSE 'test' END AS split
         FROM placed"""
)
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_samples(subjects(spark, sf_dir), exact=True).select("subject_key", "split")


@query(SPLIT + "SELECT subject_id FROM split WHERE split = 'test'")
def held_out_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.held_out_ids(splits.split_samples(subjects(spark, sf_dir)))


SHARDS_SQL = (
    HASHED
    + """, placed AS (
           SELECT subject_key, CAST(CAST(('0x' || substr(h, 9, 8)) AS UBIGINT) % 4 AS INTEGER) AS shard,
                  {order} AS o FROM hashed),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY o, subject_key) - 1 AS position FROM placed)
         SELECT subject_key, shard, position, position // 8 AS batch FROM ranked"""
)


@query(SHARDS_SQL.format(order="md5('42:3:' || subject_key)"))
def training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = splits.training_shards(subjects(spark, sf_dir), batch_size=8, n_shards=4, epoch=3)
    return sharded.select("subject_key", "shard", "position", "batch")


@query(SHARDS_SQL.format(order="h"))
def evaluation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = splits.training_shards(subjects(spark, sf_dir), batch_size=8, n_shards=4)
    return sharded.select("subject_key", "shard", "position", "batch")


# Several projects with the same subject keys inside: the customer number is cut in two.
PROJECTS = """
WITH subjects AS (
  SELECT c_custkey // 100 AS project_id, c_custkey % 100 AS subject_key, c_name AS subject_id FROM customer
), experiments AS (
  SELECT o_custkey // 100 AS project_id, o_custkey % 100 AS subject_key, o_orderkey AS exp_key,
         o_orderpriority AS modality, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS exp_ordinal,
         o_orderstatus || '_' || substr(o_orderpriority, 1, 1) AS label FROM orders
), scans AS (
  SELECT o_custkey // 100 AS project_id, l_orderkey AS exp_key, '/scans/' || l_orderkey || '/' || l_linenumber AS uri
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


@query(
    PROJECTS
    + """SELECT s.project_id::VARCHAR AS project_id, s.subject_key, s.subject_id, e.exp_key::VARCHAR AS exp_key, c.uri
         FROM subjects s LEFT JOIN experiments e ON s.project_id = e.project_id AND s.subject_key = e.subject_key
         LEFT JOIN scans c ON c.project_id = e.project_id AND c.exp_key = e.exp_key"""
)
def catalog_join_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = cat.catalog_join(dt.project_catalog(spark, sf_dir))
    return joined.select("project_id", "subject_key", "subject_id", "exp_key", "uri")


@query(
    PROJECTS
    + """, found AS (
           SELECT s.project_id, s.subject_key,
                  count(*) FILTER (WHERE (contains(e.modality, 'URGENT') OR contains(e.modality, 'HIGH'))
                                   AND e.exp_key IN (SELECT exp_key FROM scans)) AS n_xr,
                  arg_max(TRY_CAST(split_part(e.label, '_', 2) AS BIGINT), (e.exp_ordinal, e.exp_key::VARCHAR))
                    FILTER (WHERE contains(e.modality, 'URGENT') OR contains(e.modality, 'MEDIUM')) AS label
           FROM subjects s JOIN experiments e ON s.project_id = e.project_id AND s.subject_key = e.subject_key
           GROUP BY 1, 2
         ), valid AS (SELECT * FROM found WHERE n_xr > 0 AND label IS NOT NULL)
         , split AS (
           SELECT *, CASE WHEN u < 0.5 THEN 'train' WHEN u < 0.75 THEN 'validation' ELSE 'test' END AS split
           FROM (SELECT *, CAST(('0x' || substr(md5('42:' || project_id || ':' || subject_key), 1, 8)) AS UBIGINT)
                           / 4294967296.0 AS u FROM valid)
         ), counts AS (SELECT project_id, split, label, count(*) AS n FROM split GROUP BY ALL)
         , stats AS (
           SELECT project_id, split, 'n_samples' AS stat, CAST(NULL AS VARCHAR) AS key, count(*)::DOUBLE AS value
           FROM split GROUP BY ALL
           UNION ALL SELECT project_id, split, 'N', label::VARCHAR, n::DOUBLE FROM counts
           UNION ALL
           SELECT project_id, split, 'class_weights', label::VARCHAR,
                  round(sum(n) OVER w / (count(*) OVER w * n)::DOUBLE, 6) FROM counts WINDOW w AS (PARTITION BY project_id, split)
         ) SELECT project_id::VARCHAR AS project_id, split, stat, key, value FROM stats"""
)
def dataset_stats_by_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_cohort(dt.project_catalog(spark, sf_dir), actions(), REQUIRED)
    return run.stats(["project_id"]).withColumn("value", F.round("value", 6))
