"""Classification metrics over embedding labels, best epochs over events, baseline model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.classes import argmax, softmax
from ...operators import evaluate as ev
from ...operators import stats
from ...operators.model import fit_weighted_classifier, score, score_with
from ...operators.splits import TRAIN, split_samples
from .. import driver_tables as dt
from .registry import query

PREDS = """
WITH raw AS (
  SELECT vec_id AS sample_id, label AS y, [CAST(x AS DOUBLE) FOR x IN embedding[1:10]] AS z FROM embeddings
), powers AS (
  SELECT *, [exp(x - list_max(z)) FOR x IN z] AS e, list_position(z, list_max(z)) - 1 AS pred FROM raw
), preds AS (SELECT *, [x / list_sum(e) FOR x IN e] AS p FROM powers)
"""

COUNTS = (
    PREDS
    + """, classes AS (SELECT y AS label FROM preds UNION SELECT pred FROM preds),
  counts AS (
    SELECT label, count(*) FILTER (WHERE y = label AND pred = label) AS tp,
           count(*) FILTER (WHERE y <> label AND pred = label) AS fp,
           count(*) FILTER (WHERE y = label AND pred <> label) AS fn,
           count(*) FILTER (WHERE y <> label AND pred <> label) AS tn
    FROM classes, preds GROUP BY 1
  ), scores AS (
    SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp)::DOUBLE END AS prec,
           CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn)::DOUBLE END AS rec,
           CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1,
           tp + fn AS support
    FROM counts
  )
"""
)

BINARY = """
WITH raw AS (
  SELECT CAST(label >= 5 AS INTEGER) AS y, CAST(embedding[1] AS DOUBLE) AS z0, CAST(embedding[2] AS DOUBLE) AS z1
  FROM embeddings
), preds AS (
  SELECT y, exp(z1 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) AS s FROM raw
), cells AS (
  SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM preds GROUP BY 1
), curve AS (
  SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
         lead(pos) OVER (ORDER BY s DESC) AS next_pos, lead(neg) OVER (ORDER BY s DESC) AS next_neg,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM cells
)
"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    PREDS
    + """SELECT sample_id, CAST(pred AS INTEGER) AS pred, round(list_max(p), 6) AS top, round(p[1], 6) AS first,
                round(p[10], 6) AS last FROM preds"""
)
def softmax_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = dt.predictions(spark, sf_dir).select(
        "sample_id", argmax(F.col("logits")).alias("pred"), softmax(F.col("logits")).alias("p")
    )
    picked = shares.select(
        "sample_id",
        "pred",
        F.array_max("p").alias("top"),
        F.get("p", F.lit(0)).alias("first"),
        F.get("p", F.lit(9)).alias("last"),
    )
    return _rounded(picked, "top", "first", "last")


@query(PREDS + "SELECT round(avg(CAST(y = pred AS INTEGER)), 6) AS accuracy, count(*) AS n FROM preds")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.accuracy(dt.predictions(spark, sf_dir)), "accuracy")


@query(
    PREDS
    + """SELECT CAST(sample_id % 5 AS BIGINT) AS run_id, round(avg(CAST(y = pred AS INTEGER)), 6) AS accuracy, count(*) AS n
         FROM preds GROUP BY 1"""
)
def accuracy_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = dt.predictions(spark, sf_dir).withColumn("run_id", F.col("sample_id") % 5)
    return _rounded(ev.accuracy(runs, ["run_id"]), "accuracy")


@query(PREDS + "SELECT round(avg(CAST(y = pred AS INTEGER)), 6) AS f1 FROM preds")
def f1_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.f1_score(dt.predictions(spark, sf_dir)), "f1")


@query(COUNTS + "SELECT round(avg(f1), 6) AS f1 FROM scores")
def f1_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.f1_score(dt.predictions(spark, sf_dir), "macro"), "f1")


@query(COUNTS + 'SELECT round(avg(prec), 6) AS "precision", round(avg(rec), 6) AS recall FROM scores')
def precision_recall_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.precision_recall(dt.predictions(spark, sf_dir)), "precision", "recall")


@query(
    PREDS
    + """SELECT CAST(a AS INTEGER) AS y, CAST(b AS INTEGER) AS pred,
                (SELECT count(*) FROM preds WHERE preds.y = a AND preds.pred = b) AS n
         FROM generate_series(0, 9) t(a), generate_series(0, 9) u(b)"""
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(dt.predictions(spark, sf_dir), 10)


@query(
    COUNTS
    + """SELECT CAST(label AS VARCHAR) AS name, round(prec, 6) AS "precision", round(rec, 6) AS recall, round(f1, 6) AS f1,
                support FROM scores
         UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
                          round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
         UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f1), 6),
                          CAST(sum(support) AS BIGINT) FROM scores
         UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6),
                          round(sum(rec * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                          CAST(sum(support) AS BIGINT) FROM scores"""
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.classification_report(dt.predictions(spark, sf_dir)), "precision", "recall", "f1")


RANKED = (
    PREDS
    + """, long AS (
    SELECT c AS label, p[CAST(c + 1 AS INTEGER)] AS s, CAST(y = c AS INTEGER) AS hit FROM preds, generate_series(0, 9) g(c)
  ), ranked AS (
    SELECT label, hit, rank() OVER (PARTITION BY label ORDER BY s)
           + (count(*) OVER (PARTITION BY label, s) - 1) / 2.0 AS mid FROM long
  ), areas AS (
    SELECT label, sum(hit) AS n_pos, sum(1 - hit) AS n_neg,
           (sum(mid * hit) - sum(hit) * (sum(hit) + 1) / 2.0) / (sum(hit) * sum(1 - hit)) AS auroc
    FROM ranked GROUP BY 1
  )
"""
)


@query(
    RANKED
    + """SELECT CAST(label AS INTEGER) AS label, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
                round(auroc, 6) AS auroc FROM areas"""
)
def auroc_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.auroc_by_class(dt.predictions(spark, sf_dir)), "auroc")


@query(RANKED + "SELECT round(avg(auroc), 6) AS auroc FROM areas")
def auroc_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.auroc(dt.predictions(spark, sf_dir)), "auroc")


START = "SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "


@query(BINARY + START + "SELECT round(s, 6), round(fp / n, 6), round(tp / p, 6) FROM curve")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = ev.roc_curve(dt.binary_predictions(spark, sf_dir), drop_intermediate=False)
    return _rounded(curve, "threshold", "fpr", "tpr")


@query(
    BINARY
    + START
    + """SELECT round(s, 6), round(fp / n, 6), round(tp / p, 6)
         FROM (SELECT *, lag(fp) OVER w AS fp0, lag(tp) OVER w AS tp0, lead(fp) OVER w AS fp2, lead(tp) OVER w AS tp2
               FROM curve WINDOW w AS (ORDER BY s DESC))
         WHERE fp0 IS NULL OR fp2 IS NULL OR (fp - fp0) <> (fp2 - fp) OR (tp - tp0) <> (tp2 - tp)"""
)
def roc_curve_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = ev.roc_curve(dt.binary_predictions(spark, sf_dir))
    return _rounded(curve, "threshold", "fpr", "tpr")


@query(
    BINARY
    + """, steps AS (
           SELECT fp / n AS x, tp / p AS y, coalesce(lag(fp / n) OVER (ORDER BY s DESC), 0.0) AS x0,
                  coalesce(lag(tp / p) OVER (ORDER BY s DESC), 0.0) AS y0, p, n FROM curve)
         SELECT round(sum((x - x0) * (y + y0) / 2), 6) AS roc_auc, CAST(max(p) AS BIGINT) AS n_pos,
                CAST(max(n) AS BIGINT) AS n_neg FROM steps"""
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.roc_auc(dt.binary_predictions(spark, sf_dir)), "roc_auc")


@query(
    PREDS
    + """, w AS (SELECT y, (SELECT count(*) FROM preds)::DOUBLE / ((SELECT count(DISTINCT y) FROM preds) * count(*)) AS weight
                 FROM preds GROUP BY 1)
         SELECT round(sum(weight * -ln(p[y + 1])) / sum(weight), 6) AS loss FROM preds JOIN w USING (y)"""
)
def weighted_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = dt.predictions(spark, sf_dir)
    weights = stats.class_weights(preds.select(F.col("y").alias("label")))
    return _rounded(ev.weighted_cross_entropy(preds, weights), "loss")


@query(PREDS + "SELECT round(avg(-ln(p[y + 1])), 6) AS loss FROM preds")
def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.weighted_cross_entropy(dt.predictions(spark, sf_dir)), "loss")


RATES = """SELECT CAST(label AS INTEGER) AS label, tp, fp, fn, tn, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS sensitivity,
                  round(tn / nullif(tn + fp, 0)::DOUBLE, 6) AS specificity,
                  round(fp / nullif(fp + tn, 0)::DOUBLE, 6) AS false_positive_rate,
                  round(fn / nullif(fn + tp, 0)::DOUBLE, 6) AS false_negative_rate FROM counts"""


@query(COUNTS + RATES)
def class_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        ev.class_rates(dt.predictions(spark, sf_dir)),
        "sensitivity",
        "specificity",
        "false_positive_rate",
        "false_negative_rate",
    )


@query(
    COUNTS
    + f""", rates AS ({RATES})
         SELECT label, 'sensitivity' AS metric, sensitivity AS value, 'min' AS limit_kind, 0.1::DOUBLE AS limit_value,
                coalesce(sensitivity >= 0.1, false) AS met FROM rates
         UNION ALL SELECT label, 'false_positive_rate', false_positive_rate, 'max', 0.1,
                coalesce(false_positive_rate <= 0.1, false) FROM rates"""
)
def meets_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"sensitivity": ("min", 0.1), "false_positive_rate": ("max", 0.1)}
    return _rounded(ev.meets_thresholds(ev.class_rates(dt.predictions(spark, sf_dir)), limits), "value")


@query(
    """SELECT run_id, 'purchase' AS monitored_metric, value AS metric_value, 'min' AS mode, epoch, place FROM (
         SELECT user_id AS run_id, value, event_id AS epoch,
                CAST(row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS INTEGER) AS place
         FROM events WHERE event_type = 'purchase') WHERE place <= 1"""
)
def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = dt.metric_log(spark, sf_dir).withColumn("epoch", F.col("step"))
    return ev.best_checkpoint(log, "purchase")


@query(
    """SELECT run_id, 'view' AS monitored_metric, value AS metric_value, 'max' AS mode, epoch, place FROM (
         SELECT user_id AS run_id, value, event_id AS epoch,
                CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS place
         FROM events WHERE event_type = 'view') WHERE place <= 3"""
)
def best_checkpoints_by_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = dt.metric_log(spark, sf_dir).withColumn("epoch", F.col("step"))
    return ev.best_checkpoint(log, "view", "max", 3)


@query()
def score_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline model fitted on the train split and scored on all; an iterative fit has no SQL form."""
    rows = dt.table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "features")
    split = split_samples(rows, key="vec_id")
    train = split.where(F.col("split") == TRAIN)
    weights = stats.class_weights(train.select("label"))
    scored = score(fit_weighted_classifier(train, weights, max_iter=20), split)
    return scored.select(
        "vec_id", "split", "label", argmax(F.col("logits")).alias("pred"), F.round(F.array_max("probabilities"), 6).alias("top")
    )


# Three runs, told apart by the sample's number.
BY_RUN = PREDS + ", runs AS (SELECT *, sample_id % 3 AS run_id FROM preds)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.predictions(spark, sf_dir).withColumn("run_id", F.col("sample_id") % 3)


@query(
    BY_RUN
    + """SELECT r AS run_id, CAST(a AS INTEGER) AS y, CAST(b AS INTEGER) AS pred,
                (SELECT count(*) FROM runs WHERE run_id = r AND y = a AND pred = b) AS n
         FROM generate_series(0, 2) s(r), generate_series(0, 9) t(a), generate_series(0, 9) u(b)"""
)
def confusion_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(_runs(spark, sf_dir), 10, ["run_id"])


@query(
    BY_RUN
    + """SELECT CAST(CASE WHEN y < 5 AND pred < 5 THEN y END AS INTEGER) AS y,
                CAST(CASE WHEN y < 5 AND pred < 5 THEN pred END AS INTEGER) AS pred, count(*) AS n
         FROM runs GROUP BY 1, 2"""
)
def confusion_with_unknown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the classes are not among those counted; their predictions are one row."""
    return ev.confusion_matrix(dt.predictions(spark, sf_dir), 5).where("n > 0")


@query(
    BY_RUN
    + """, long AS (
           SELECT run_id, c AS label, p[CAST(c + 1 AS INTEGER)] AS s, CAST(y = c AS INTEGER) AS hit
           FROM runs, generate_series(0, 9) g(c)
         ), ranked AS (
           SELECT run_id, label, hit, rank() OVER (PARTITION BY run_id, label ORDER BY s)
                  + (count(*) OVER (PARTITION BY run_id, label, s) - 1) / 2.0 AS mid FROM long
         ), areas AS (
           SELECT run_id, label, (sum(mid * hit) - sum(hit) * (sum(hit) + 1) / 2.0)
                                 / nullif(sum(hit) * sum(1 - hit), 0) AS auroc FROM ranked GROUP BY 1, 2)
         SELECT run_id, round(avg(auroc), 6) AS auroc FROM areas GROUP BY 1"""
)
def auroc_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.auroc(_runs(spark, sf_dir), by=["run_id"]), "auroc")


@query(
    BY_RUN
    + """, scored AS (
           SELECT run_id, p[2] AS s, CAST(y = 1 AS INTEGER) AS hit FROM runs
         ), steps AS (
           SELECT run_id, s, sum(hit) AS pos, sum(1 - hit) AS neg FROM scored GROUP BY 1, 2
         ), curve AS (
           SELECT run_id, s, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
           FROM steps WINDOW w AS (PARTITION BY run_id ORDER BY s DESC)
         ), ends AS (
           SELECT run_id, sum(hit) AS positives, sum(1 - hit) AS negatives FROM scored GROUP BY 1)
         SELECT run_id, CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM ends
         UNION ALL SELECT run_id, round(s, 6), round(fp / negatives, 6), round(tp / positives, 6) FROM curve JOIN ends USING (run_id)"""
)
def roc_curve_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = ev.roc_curve(_runs(spark, sf_dir), drop_intermediate=False, by=["run_id"])
    return _rounded(curve, "threshold", "fpr", "tpr")


def _given_model():
    """A linear model with known whole coefficients: ((feature + class) mod 3) - 1."""
    import numpy as np

    coefficients = (np.arange(64)[:, None] + np.arange(10)[None]) % 3 - 1.0
    return lambda features: features @ coefficients


@query(
    """SELECT vec_id, CAST(c AS INTEGER) AS class,
              CAST(list_sum([floor(256 * embedding[CAST(i AS INTEGER)]::DOUBLE) * ((i - 1 + c) % 3 - 1)
                             FOR i IN range(1, 65)]) AS BIGINT) AS logit
       FROM embeddings, generate_series(0, 9) g(c)"""
)
def score_given_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model whose scores SQL can state, through the batch scorer."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("float"))
    rows = dt.table(spark, sf_dir, "embeddings").select("vec_id", whole.alias("features"))
    scored = score_with(rows, _given_model, n_features=64)
    return scored.select("vec_id", F.posexplode("logits").alias("class", "logit")).withColumn("logit", F.col("logit").cast("bigint"))


@query("SELECT vec_id, label, 1.0::DOUBLE AS total, 10 AS n_classes, true AS pred_has_top FROM embeddings")
def fitted_model_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for any fit: probabilities of ten classes that add up to one, the largest logit on top."""
    rows = dt.table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "features")
    scored = score(fit_weighted_classifier(rows, None, max_iter=5), rows)
    total = F.aggregate("probabilities", F.lit(0.0), lambda acc, v: acc + v)
    top = F.get("probabilities", argmax(F.col("logits"))) == F.array_max("probabilities")
    return scored.select(
        "vec_id", "label", F.round(total, 9).alias("total"), F.size("probabilities").alias("n_classes"), top.alias("pred_has_top")
    )
