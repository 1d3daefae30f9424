"""The driver's star-schema tables seen as catalog, image, prediction and record tables.

Only projections of whole tables: no row is left out, and every rule here is repeated in the SQL
of the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import Catalog


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from a file footer once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def text(*parts: Column | str) -> Column:
    """Parts joined to one text; strings are literal."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# ---- catalog ---------------------------------------------------------------------------------


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """Customers as subjects, orders as experiments, line items as scans, parts as resources: one project."""
    c = F.col
    subjects = table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("subject_key"),
        c("c_name").alias("subject_id"),
        text("/subjects/", c("c_custkey")).alias("subject_uri"),
    )
    named = text(c("o_orderstatus"), "_", F.substring("o_orderpriority", 1, 1))
    experiments = table(spark, sf_dir, "orders").select(
        c("o_custkey").alias("subject_key"),
        c("o_orderkey").cast("string").alias("exp_key"),
        F.unix_date(c("o_orderdate").cast("date")).cast("bigint").alias("exp_ordinal"),
        c("o_orderpriority").alias("modality"),
        F.when(c("o_totalprice") > 490000, c("o_orderstatus")).otherwise(named).alias("label"),
    )
    scans = table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").cast("string").alias("exp_key"),
        F.concat_ws("-", "l_partkey", "l_suppkey", c("l_quantity").cast("bigint")).alias("scan_key"),
        c("l_linenumber").cast("bigint").alias("scan_ordinal"),
        F.concat("l_returnflag", "l_linestatus").alias("series_description"),
        text("/scans/", c("l_orderkey"), "/", c("l_linenumber"), "/", c("l_partkey"), "-", c("l_suppkey")).alias(
            "uri"
        ),
    )
    resources = table(spark, sf_dir, "part").select(
        text("/resources/", c("p_partkey")).alias("uri"),
        F.when(
            c("p_size") <= 25, F.array(F.concat("p_name", F.lit(".dcm")), F.concat("p_type", F.lit(".txt")))
        ).alias("resource_files"),
    )
    return Catalog(subjects, experiments, scans, resources)


def project_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """As ``catalog``, in projects of a hundred customers whose keys repeat from project to project."""
    c = F.col

    def cut(number: str) -> list[Column]:
        project = F.floor(c(number) / 100).cast("string").alias("project_id")
        return [project, (c(number) % 100).alias("subject_key")]

    subjects = table(spark, sf_dir, "customer").select(
        *cut("c_custkey"), c("c_name").alias("subject_id"), text("/subjects/", c("c_custkey")).alias("subject_uri")
    )
    orders = table(spark, sf_dir, "orders")
    experiments = orders.select(
        *cut("o_custkey"),
        c("o_orderkey").cast("string").alias("exp_key"),
        F.unix_date(c("o_orderdate").cast("date")).cast("bigint").alias("exp_ordinal"),
        c("o_orderpriority").alias("modality"),
        text(c("o_orderstatus"), "_", F.substring("o_orderpriority", 1, 1)).alias("label"),
    )
    lines = table(spark, sf_dir, "lineitem").join(
        orders.select("o_orderkey", cut("o_custkey")[0]), c("l_orderkey") == c("o_orderkey")
    )
    scans = lines.select(
        "project_id",
        c("l_orderkey").cast("string").alias("exp_key"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("scan_key"),
        c("l_linenumber").cast("bigint").alias("scan_ordinal"),
        F.concat("l_returnflag", "l_linestatus").alias("series_description"),
        text("/scans/", c("l_orderkey"), "/", c("l_linenumber")).alias("uri"),
    )
    return Catalog(subjects, experiments, scans)


# ---- images and predictions ------------------------------------------------------------------


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 64-value embedding as an 8 x 8 image with a channel and a trailing dimension."""
    pixels = F.col("embedding").cast("array<double>")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.array(F.lit(1), F.lit(8), F.lit(8), F.lit(1)).alias("dims"),
        pixels.alias("pixels"),
        F.struct(F.lit(8).alias("height"), F.lit(8).alias("width"), pixels.alias("pixels")).alias("image"),
        "label",
    )


def pixel_rows(df: DataFrame, image: str = "image", key: str = "image_id") -> DataFrame:
    """Long form ``(image_id, height, width, idx, value)``, the value to 6 places."""
    return df.select(
        key,
        F.col(f"{image}.height").alias("height"),
        F.col(f"{image}.width").alias("width"),
        F.posexplode(f"{image}.pixels").alias("idx", "v"),
    ).select(key, "height", "width", "idx", F.round(F.col("v").cast("double"), 6).alias("value"))


def predictions(spark: SparkSession, sf_dir: str, n_classes: int = 10) -> DataFrame:
    """Embedding labels with the first ``n_classes`` values as logits."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sample_id"),
        F.col("label").alias("y"),
        F.slice("embedding", 1, n_classes).cast("array<double>").alias("logits"),
    )


def binary_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels 5 to 9 as the positive class, with two logits."""
    return predictions(spark, sf_dir, 2).withColumn("y", (F.col("y") >= 5).cast("int"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logged steps: user = run, day = epoch, type = metric, batch size from the props."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.unix_date(F.col("ts").cast("date")).alias("epoch"),
        F.col("event_id").alias("step"),
        F.col("event_type").alias("metric"),
        "value",
        (F.get_json_object("props", "$.k").cast("int") + 1).alias("batch_size"),
    )


# ---- records ---------------------------------------------------------------------------------


def tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as test results: errors fail, and values above 400 come with a note."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 25).alias("project_id"),
        F.col("user_id").alias("suite"),
        F.col("event_id").alias("test_key"),
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") == "error", "fail").otherwise("pass").alias("result"),
        F.array(F.get_json_object("props", "$.k").cast("bigint")).alias("req_ids"),
        F.when(F.col("value") > 400, text("justified: ", F.col("event_id"))).alias("note"),
    )


def change_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as change requests: status P is a problem report; cheap orders name no change."""
    first, second = F.col("o_custkey") % 120, F.col("o_orderkey") % 120
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 25).alias("project_id"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        (F.col("o_orderstatus") == "P").alias("is_problem_report"),
        F.when(F.col("o_totalprice") < 50000, F.array().cast("array<bigint>"))
        .otherwise(F.array(first, second))
        .alias("change_ids"),
    )


def line_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as links from a request (order) to a change (supplier)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("cr_id"), F.col("l_linenumber").alias("position"), F.col("l_suppkey").alias("change_id")
    )


def _no_approvals() -> Column:
    return F.array().cast("array<struct<id:string,reviewer:struct<name:string,id:string>,content:string>>")


def _person(name: Column, key: Column) -> Column:
    return F.struct(name.alias("name"), key.cast("string").alias("id"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as changes: the supplier is the author, its nation reviews; a negative balance has
    no approval, a balance above 9000 only the author's own."""
    me = _person(F.col("s_name"), F.col("s_suppkey"))
    other = _person(text("nation ", F.col("s_nationkey")), text("n", F.col("s_nationkey")))

    def approval(who: Column) -> Column:
        return F.struct(F.lit("a").alias("id"), who.alias("reviewer"), F.lit("").alias("content"))

    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.array(me).alias("authors"),
        F.when(F.col("s_acctbal") < 0, _no_approvals())
        .when(F.col("s_acctbal") > 9000, F.array(approval(me)))
        .otherwise(F.array(approval(me), approval(other)))
        .alias("approvals"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes with check lists in the approval text."""
    tick = F.when(F.col("o_orderstatus") == "F", "x").otherwise(" ")
    content = text(
        "\n- [", tick, "] implements ", F.col("o_orderkey"), "\n- [x] priority: ", F.col("o_orderpriority"), "\nend"
    )
    author = _person(text("c", F.col("o_custkey")), F.col("o_custkey"))
    reviewer = _person(text("c", F.col("o_orderkey") % 1000), F.col("o_orderkey") % 1000)
    approval = F.struct(F.lit("a").alias("id"), reviewer.alias("reviewer"), content.alias("content"))
    own = F.struct(F.lit("b").alias("id"), author.alias("reviewer"), F.lit("").alias("content"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.array(author).alias("authors"),
        F.when(F.col("o_totalprice") < 50000, _no_approvals())
        .when(F.col("o_totalprice") > 450000, F.array(own))
        .otherwise(F.array(approval))
        .alias("approvals"),
    )


def part_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 25).alias("project_id"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title")
    )


def risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as risks: bands of size and price as probability and severity; one price band has a
    label that the matrix does not know."""
    from ..operators.risk import PROBABILITY_LEVELS, SEVERITY_LEVELS

    probability = F.get(F.array(*[F.lit(p) for p in PROBABILITY_LEVELS]), (F.col("p_size") % 5).cast("int"))
    band = (F.floor("p_retailprice") % 6).cast("int")
    severity = F.coalesce(F.get(F.array(*[F.lit(s) for s in SEVERITY_LEVELS]), band), F.lit("Unrated"))
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 25).alias("project_id"),
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("hazard"),
        F.col("p_brand").alias("software_item"),
        F.col("p_type").alias("events"),
        severity.alias("severity"),
        probability.alias("probability"),
        F.when(F.col("p_size") > 10, text("control ", F.col("p_partkey"))).alias("control_measures"),
        F.when(F.col("p_size") > 30, F.lit("Minor")).alias("residual_severity"),
        F.when(F.col("p_size") > 20, F.lit("Low")).alias("residual_probability"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as commits: the first line is the subject."""
    return table(spark, sf_dir, "conversations").select(
        text(F.col("conv_id"), "-", F.col("turn")).alias("sha"),
        F.substring_index("text", "\n", 1).alias("subject"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("body"),
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")
