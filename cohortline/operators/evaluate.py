"""Classification metrics from predictions ``(run_id, sample_id, y, logits)``.

Count-based metrics start from the confusion counts, which are combined before their shuffle and
have at most n_classes**2 rows per group; everything after them is small whatever the table size.
Rank-based metrics (ROC, AUROC) use the running totals of ``ranks``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import argmax, log_probability, softmax
from .ranks import first_rows, running_totals


def with_prediction(preds: DataFrame) -> DataFrame:
    """Add the predicted class, the index of the largest logit."""
    return preds.withColumn("pred", argmax(F.col("logits").cast("array<double>")))


def with_probabilities(preds: DataFrame) -> DataFrame:
    return preds.withColumn("probabilities", softmax(F.col("logits")))


def accuracy(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of correct predictions."""
    hit = (F.col("y") == F.col("pred")).cast("double")
    return with_prediction(preds).groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_counts(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Non-zero cells of the confusion matrix."""
    return with_prediction(preds).groupBy(*by, "y", "pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(preds: DataFrame, n_classes: int, by: Sequence[str] = ()) -> DataFrame:
    """Dense n_classes x n_classes counts per group of ``by``, truth by prediction, zeros included.

    Predictions whose truth or predicted class is null or outside the classes are counted in one more row, with null
    in both, so the counts always add up to the predictions.
    """
    cells = preds.sparkSession.range(n_classes * n_classes).select(
        F.floor(F.col("id") / n_classes).cast("int").alias("y"), (F.col("id") % n_classes).cast("int").alias("pred")
    )
    inside = F.col("y").between(0, n_classes - 1) & F.col("pred").between(0, n_classes - 1)
    counts = confusion_counts(preds, by).select(
        *by, F.col("y").cast("int").alias("y"), "pred", "n", F.coalesce(inside, F.lit(False)).alias("inside")
    )
    none = F.lit(None).cast("int")
    outside = counts.where("NOT inside").groupBy(*by).agg(F.sum("n").alias("n")).where("n > 0")
    if by:
        # Each group's own cells: an array of fixed size, not a join.
        grid = F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(p).alias("pred")) for y in range(n_classes) for p in range(n_classes)]))
        cells = counts.select(*by).distinct().select(*by, grid.alias("cell")).select(*by, "cell.*")
    # Added up, not joined, so that a null group keeps its counts.
    found = cells.withColumn("n", F.lit(0).cast("bigint")).unionByName(counts.where("inside").select(*by, "y", "pred", "n"))
    return found.groupBy(*by, "y", "pred").agg(F.sum("n").alias("n")).unionByName(
        outside.select(*by, none.alias("y"), none.alias("pred"), "n")
    )


def class_counts(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest TP, FP, FN, TN of every class that occurs in truth or prediction."""
    cells = confusion_counts(preds, by)
    hit = F.col("y") == F.col("pred")
    # Each cell counts for its truth class and for its predicted class.
    sides = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("y").cast("int").alias("label"),
                    F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                    F.lit(0).cast("bigint").alias("fp"),
                    F.when(hit, 0).otherwise(F.col("n")).alias("fn"),
                    F.col("n").alias("of_total"),
                ),
                F.struct(
                    F.col("pred").cast("int").alias("label"),
                    F.lit(0).cast("bigint").alias("tp"),
                    F.when(hit, 0).otherwise(F.col("n")).alias("fp"),
                    F.lit(0).cast("bigint").alias("fn"),
                    F.lit(0).cast("bigint").alias("of_total"),
                ),
            )
        ),
    )
    sums = sides.groupBy(*by, "label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "of_total")]
    )
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return sums.withColumn("n", F.sum("of_total").over(group)).select(
        *by, "label", "tp", "fp", "fn", (F.col("n") - F.col("tp") - F.col("fp") - F.col("fn")).alias("tn")
    )


def _ratio(above: Column, below: Column) -> Column:
    return F.coalesce(F.try_divide(above.cast("double"), below.cast("double")), F.lit(0.0))


def class_scores(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return class_counts(preds, by).select(
        *by,
        "label",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
        "tp",
        "fp",
        "fn",
    )


def precision_recall(preds: DataFrame, average: str = "macro", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall over classes; classes absent from truth and prediction are left out."""
    scores = class_scores(preds, by).groupBy(*by)
    if average == "macro":
        return scores.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"))
    if average == "micro":
        return scores.agg(
            _ratio(F.sum("tp"), F.sum(F.col("tp") + F.col("fp"))).alias("precision"),
            _ratio(F.sum("tp"), F.sum(F.col("tp") + F.col("fn"))).alias("recall"),
        )
    raise ValueError("average is 'macro' or 'micro'")


def f1_score(preds: DataFrame, average: str = "micro", by: Sequence[str] = ()) -> DataFrame:
    """F1; micro equals accuracy when each sample has one label."""
    scores = class_scores(preds, by).groupBy(*by)
    if average == "macro":
        return scores.agg(F.avg("f1").alias("f1"))
    if average == "micro":
        both = F.sum(2 * F.col("tp"))
        return scores.agg(_ratio(both, both + F.sum("fp") + F.sum("fn")).alias("f1"))
    raise ValueError("average is 'macro' or 'micro'")


def classification_report(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by``: per class and summary rows ``(name, precision, recall, f1, support)``.

    The accuracy row carries the share of correct predictions in all three score columns.
    """
    scores = class_scores(preds, by)
    n = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / n

    right = F.sum("tp") / n
    # The names of the summary rows.
    summary = scores.groupBy(*by).agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("name"),
                right.alias("precision"),
                right.alias("recall"),
                right.alias("f1"),
                n.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("name"),
                F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"),
                F.avg("f1").alias("f1"),
                n.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("name"),
                weighted("precision").alias("precision"),
                weighted("recall").alias("recall"),
                weighted("f1").alias("f1"),
                n.alias("support"),
            ),
        ).alias("lines")
    ).select(*by, F.inline("lines"))
    per_class = scores.select(*by, F.col("label").cast("string").alias("name"), "precision", "recall", "f1", "support")
    return per_class.unionByName(summary)


# ---- rank metrics ----------------------------------------------------------------------------


def _score_counts(preds: DataFrame, positive: int | None, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct (class, score); combined before the shuffle."""
    scored = with_probabilities(preds)
    if positive is None:
        rows = scored.select(*by, "y", F.posexplode("probabilities").alias("label", "score"))
        hit = F.col("y") == F.col("label")
    else:
        rows = scored.select(
            *by, "y", F.lit(positive).alias("label"), F.get("probabilities", F.lit(positive)).alias("score")
        )
        hit = F.col("y") == positive
    return (
        rows.groupBy(*by, "label", "score")
        .agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
        .withColumn("down", -F.col("score"))
    )


def _curve(preds: DataFrame, positive: int | None, by: Sequence[str] = ()) -> DataFrame:
    """True and false positives at every distinct score, counted from the highest score down."""
    return running_totals(
        _score_counts(preds, positive, by),
        [*by, "label"],
        ["down"],
        {"tp": "pos", "fp": "neg"},
        {"next_pos": "pos", "next_neg": "neg"},
    )


def _areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the curve per class: trapezoids under each distinct score. Ties give half."""
    under = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")))
    pairs = F.sum("pos") * F.sum("neg")
    return curve.groupBy(*by, "label").agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.try_divide(under.cast("double"), (2 * pairs).cast("double")).alias("auroc"),
    )


def auroc_by_class(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest area per class, and per group such as a run or epoch; null for a class with no positives or no negatives."""
    return _areas(_curve(preds, None, by), by)


def auroc(preds: DataFrame, average: str = "macro", by: Sequence[str] = ()) -> DataFrame:
    """Mean of the one-vs-rest areas, undefined classes left out."""
    areas = auroc_by_class(preds, by)
    if average == "macro":
        return areas.groupBy(*by).agg(F.avg("auroc").alias("auroc"))
    if average == "weighted":
        defined = F.col("auroc").isNotNull()
        return areas.where(defined).groupBy(*by).agg((F.sum(F.col("auroc") * F.col("n_pos")) / F.sum("n_pos")).alias("auroc"))
    raise ValueError("average is 'macro' or 'weighted'")


def roc_curve(preds: DataFrame, positive: int = 1, drop_intermediate: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """``(threshold, fpr, tpr)`` per distinct score, with a (0, 0) start at an infinite threshold, for each group of ``by``.

    ``drop_intermediate`` leaves out inner points on a straight line between their neighbours; the first and the last distinct
    score always stay.
    """
    curve = _curve(preds, positive, by)
    if drop_intermediate:
        last = F.col("next_pos").isNull()
        bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        curve_points = curve.where(first | last | bend)
    else:
        curve_points = curve
    hit = F.col("y") == positive
    counts = [F.count_if(hit).alias("p"), F.count_if(~hit).alias("n")]
    begin = [F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")]
    if by:
        ends = preds.groupBy(*by).agg(*counts)
        same = reduce(Column.__and__, [curve_points[c].eqNullSafe(ends[c]) for c in by])
        located = curve_points.join(ends.select(*by, "p", "n"), same).select(*[curve_points[c] for c in by], "score", "fp", "tp", "p", "n")
        p, n, start = F.col("p"), F.col("n"), ends.select(*by, *begin)
    else:
        ends = preds.agg(F.struct(*counts).alias("ends")).scalar()
        located, p, n = curve_points, ends.getField("p"), ends.getField("n")
        start = preds.sparkSession.range(1).select(*begin)
    points = located.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), n.cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), p.cast("double")).alias("tpr"),
    )
    return start.unionByName(points)


def roc_auc(preds: DataFrame, positive: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under ``roc_curve``, per group of ``by``."""
    return _areas(_curve(preds, positive, by), by).select(*by, F.col("auroc").alias("roc_auc"), "n_pos", "n_neg")


# ---- loss, thresholds, best epoch ------------------------------------------------------------


def weighted_cross_entropy(
    preds: DataFrame, weights: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of w_y * -log p_y over the sum of w_y; unweighted if no ``(label, weight)`` is given.

    Rows are first reduced to one row per true class, so the weights join is tiny. A class without a weight fails the job.
    """
    losses = preds.select(*by, "y", (-log_probability(F.col("logits"), F.col("y"))).alias("loss"))
    per_class = losses.groupBy(*by, "y").agg(F.sum("loss").alias("loss"), F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = per_class.withColumn("weight", F.lit(1.0))
    else:
        given = weights.select(F.col("label").alias("y"), "weight")
        unknown = F.raise_error(F.concat(F.lit("no weight for class "), F.coalesce(F.col("y").cast("string"), F.lit("null")))).cast("double")
        weighed = per_class.join(given, "y", "left").withColumn("weight", F.coalesce(F.col("weight").cast("double"), unknown))
    w = F.col("weight")
    return weighed.groupBy(*by).agg((F.sum(w * F.col("loss")) / F.sum(w * F.col("n"))).alias("loss"))


def class_rates(preds: DataFrame) -> DataFrame:
    """Counts, sensitivity, specificity and the false rates of every class."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")

    def rate(above: Column, below: Column) -> Column:
        return F.try_divide(above.cast("double"), below.cast("double"))

    return class_counts(preds).select(
        "label",
        "tp",
        "fp",
        "fn",
        "tn",
        rate(tp, tp + fn).alias("sensitivity"),
        rate(tn, tn + fp).alias("specificity"),
        rate(fp, fp + tn).alias("false_positive_rate"),
        rate(fn, fn + tp).alias("false_negative_rate"),
    )


def meets_thresholds(rates: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per class and limited metric: its value, the limit and whether it holds.

    ``limits`` maps a metric column to ``('min', value)`` or ``('max', value)``. A metric that is
    undefined for a class does not meet its limit.
    """
    lines = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.col(metric).alias("value"),
                F.lit(kind).alias("limit_kind"),
                F.lit(float(limit)).alias("limit_value"),
                F.coalesce(
                    F.col(metric) >= limit if kind == "min" else F.col(metric) <= limit, F.lit(False)
                ).alias("met"),
            )
            for metric, (kind, limit) in limits.items()
        ]
    )
    return rates.select("label", F.inline(lines))


def best_checkpoint(metric_log: DataFrame, monitor: str = "val_loss", mode: str = "min", k: int = 1) -> DataFrame:
    """The ``k`` best epochs of each run by the monitored metric; the earlier epoch wins a tie, null and NaN are no values."""
    if mode not in ("min", "max"):
        raise ValueError("mode is 'min' or 'max'")
    value = F.col("value").asc() if mode == "min" else F.col("value").desc()
    seen = metric_log.where((F.col("metric") == monitor) & F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    best = first_rows(seen.select("run_id", "value", "epoch"), ["run_id"], [value, F.col("epoch").asc()], k)
    return best.select(
        "run_id",
        F.lit(monitor).alias("monitored_metric"),
        F.col("value").alias("metric_value"),
        F.lit(mode).alias("mode"),
        "epoch",
        "place",
    )
