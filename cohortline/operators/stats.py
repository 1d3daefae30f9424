"""Label counts, class weights, manifests, data profiles and epoch means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABEL = "label"


def get_labels(items: DataFrame, data_label: str = LABEL) -> DataFrame:
    """Label items as integers: all columns of the item plus ``label``."""
    return items.where(F.col("data_label") == data_label).withColumn(
        "label", F.col("action_data").try_cast("bigint")
    )


def class_weights(labels: DataFrame, by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """n / (k * n_class) for each class, over all rows or per group.

    Rows are counted before the shuffle; see ``weights_of_counts`` for the rest.
    """
    counts = (
        labels.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_class"))
    )
    return weights_of_counts(counts, by, label)


def weights_of_counts(counts: DataFrame, by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Class weights from ``n_class`` counts: the window sees one row per group and class."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return counts.select(
        *by,
        label,
        "n_class",
        (F.sum("n_class").over(group) / (F.count(F.lit(1)).over(group) * F.col("n_class"))).alias("weight"),
    )


def _stat_row(split: Column, stat: str, key: Column, value: Column) -> Column:
    return F.struct(
        split.cast("string").alias("split"),
        F.lit(stat).alias("stat"),
        key.cast("string").alias("key"),
        value.cast("double").alias("value"),
    )


def _cohort_counts(subjects: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Patients (0 if there are none at all), samples per split and labels per split, counted in one pass."""
    none, one = F.lit(None), F.lit(1)
    facts = F.concat(
        F.array(_stat_row(none, "N_patients", none, one), _stat_row(F.col("split"), "n_samples", none, one)),
        F.transform("labels", lambda label: _stat_row(F.col("split"), "N", label, one)),
    )
    rows = subjects.select(*by, F.inline(facts))
    if not by:
        nobody = subjects.sparkSession.range(1).select(
            F.inline(F.array(_stat_row(none, "N_patients", none, F.lit(0))))
        )
        rows = rows.unionByName(nobody)
    return rows.groupBy(*by, "split", "stat", "key").agg(F.sum("value").alias("value"))


def _with_class_weights(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add a ``class_weights`` row to each label count; the window sees one row per split and class."""
    group = Window.partitionBy(*by, "split", "stat")
    known = (F.col("stat") == "N") & F.col("key").isNotNull()
    weight = F.sum("value").over(group) / (F.count(F.lit(1)).over(group) * F.col("value"))
    both = F.array(
        _stat_row(F.col("split"), "N", F.col("key"), F.col("value")),
        _stat_row(F.col("split"), "class_weights", F.col("key"), F.col("weight")),
    )
    same = F.array(F.struct("split", "stat", "key", "value"))
    return counts.withColumn("weight", weight).select(*by, F.inline(F.when(known, both).otherwise(same)))


def dataset_stats(subjects: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics per split, and per group of ``by`` such as the project, in long form ``(split, stat, key, value)``.

    ``subjects`` has one row per subject with its ``split`` and its ``labels`` (an array, mostly of
    one label). Stats are ``n_samples``, ``N`` (count of a label) and ``class_weights``.
    """
    return _with_class_weights(_cohort_counts(subjects, by), by).where(F.col("stat") != "N_patients")


def data_manifest(
    subjects: DataFrame, label_dict: Mapping[str, int | None], by: Sequence[str] = ()
) -> DataFrame:
    """Patient total, statistics of the splits and the label dictionary, in the same long form.

    With ``by`` the dictionary, which is common to all groups, has null there.
    """
    names = subjects.sparkSession.createDataFrame(
        [(None, "labels", k, None if v is None else float(v)) for k, v in label_dict.items()],
        "split string, stat string, key string, value double",
    )
    return _with_class_weights(_cohort_counts(subjects, by), by).unionByName(names, allowMissingColumns=True)


def nested_manifest(manifest: DataFrame) -> DataFrame:
    """The manifest as one row with a struct per split, ready for one JSON document.

    Its size is set by the number of splits and classes, not by the number of samples.
    """

    def split(name: str):
        mine = F.col("split") == name
        return F.struct(
            F.max(F.when(mine & (F.col("stat") == "n_samples"), F.col("value")))
            .cast("bigint")
            .alias("n_samples"),
            F.map_from_entries(
                F.array_sort(
                    F.collect_list(
                        F.when(
                            mine & (F.col("stat") == "N"),
                            F.struct(
                                F.concat(F.lit("N_"), "key").alias("key"), F.col("value").cast("bigint").alias("value")
                            ),
                        )
                    )
                )
            ).alias("counts"),
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.when(
                            mine & (F.col("stat") == "class_weights"),
                            F.struct(F.col("key").cast("bigint").alias("key"), "value"),
                        )
                    )
                ),
                lambda e: e.value,
            ).alias("class_weights"),
        ).alias(name)

    labels = F.map_from_entries(
        F.collect_list(F.when(F.col("stat") == "labels", F.struct("key", F.col("value").cast("int").alias("value"))))
    )
    return manifest.agg(
        F.max(F.when(F.col("stat") == "N_patients", F.col("value"))).cast("bigint").alias("N_patients"),
        split("train"),
        split("validation"),
        split("test"),
        labels.alias("labels"),
    )


def dataset_profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Completeness, distinct values and range of columns: one row per column, one pass.

    Exact distinct counts shuffle every distinct value; ``approx`` uses a sketch instead.
    """
    names = list(columns or df.columns)
    distinct = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(names)],
        *[distinct(c).alias(f"d_{i}") for i, c in enumerate(names)],
        *[F.min(c).cast("string").alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(c).cast("string").alias(f"hi_{i}") for i, c in enumerate(names)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("n_rows").alias("n_rows"),
                (F.col("n_rows") - F.col(f"n_{i}")).alias("n_null"),
                F.col(f"d_{i}").alias("n_distinct"),
                F.col(f"lo_{i}").alias("min_value"),
                F.col(f"hi_{i}").alias("max_value"),
            )
            for i, c in enumerate(names)
        ]
    )
    return wide.select(F.inline(lines))


def label_bias(df: DataFrame, attribute: str, label: str = "label") -> DataFrame:
    """How labels spread over an attribute: counts, share inside the attribute value, and the
    difference from the share over all rows.

    Windows see one row per attribute value and label; the overall shares are one row per label.
    """
    counts = df.groupBy(attribute, label).agg(F.count(F.lit(1)).alias("n"))
    labels = counts.groupBy(label).agg(F.sum("n").alias("n_label"))
    overall = labels.select(
        F.col(label).alias("overall_label"),
        (F.col("n_label") / F.sum("n_label").over(Window.partitionBy(F.lit(0)))).alias("overall"),
    )
    share = F.col("n") / F.sum("n").over(Window.partitionBy(attribute))
    return (
        counts.withColumn("share", share)
        .join(overall, F.col(label).eqNullSafe(F.col("overall_label")))
        .select(attribute, label, "n", "share", (F.col("share") - F.col("overall")).alias("bias"))
    )


def epoch_metric(step_log: DataFrame, weight: str = "batch_size") -> DataFrame:
    """Mean of the step values of each run, epoch and metric, weighted by batch size.

    A step without a value has no weight; the mean is null where no weight is left.
    """
    counted = F.when(F.col("value").isNotNull(), F.col(weight))
    return step_log.groupBy("run_id", "epoch", "metric").agg(
        F.try_divide(F.sum(F.col("value") * counted), F.sum(counted).cast("double")).alias("value"),
        F.count(F.lit(1)).alias("n_steps"),
    )
