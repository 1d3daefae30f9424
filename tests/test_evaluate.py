from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.operators import evaluate as ev
from cohortline.operators.stats import class_weights, dataset_profile, dataset_stats, epoch_metric, label_bias, nested_manifest, data_manifest
from cohortline.plans.model_report import model_report, write_model_report

SCHEMA = "run_id string, sample_id int, y int, logits array<double>"


def make(spark, data):
    return spark.createDataFrame([("r", i, y, z) for i, (y, z) in enumerate(data)], SCHEMA)


def softmax(z):
    """Plain left-to-right sum: ``sum`` compensates, which would break ties by the last bit."""
    e = [math.exp(v - max(z)) for v in z]
    total = 0.0
    for v in e:
        total += v
    return [v / total for v in e]


@pytest.fixture(scope="module")
def data():
    """Three classes with coarse scores, so that many of them tie."""
    rng = random.Random(11)
    return [(rng.randint(0, 2), [float(rng.randint(0, 3)) for _ in range(3)]) for _ in range(300)]


@pytest.fixture(scope="module")
def preds(spark, data):
    return make(spark, data)


def predicted(z):
    return z.index(max(z))


def test_counts(preds, data):
    dense = {(r.y, r.pred): r.n for r in ev.confusion_matrix(preds, 4).collect()}
    assert len(dense) == 16
    for (y, p), n in dense.items():
        assert n == sum(1 for t, z in data if t == y and predicted(z) == p)


def test_accuracy_equals_micro_f1(preds, data):
    share = sum(t == predicted(z) for t, z in data) / len(data)
    assert ev.accuracy(preds).first().accuracy == pytest.approx(share)
    assert ev.f1_score(preds).first().f1 == pytest.approx(share)
    both = ev.precision_recall(preds, "micro").first()
    assert both.precision == pytest.approx(share) and both.recall == pytest.approx(share)
    assert ev.accuracy(preds, ["run_id"]).first().run_id == "r"
    with pytest.raises(ValueError):
        ev.f1_score(preds, "median")


def test_absent_and_never_predicted_classes(spark):
    # class 2 is true but never predicted; class 3 occurs nowhere
    preds = make(spark, [(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])])
    scores = {r.label: (r.precision, r.recall, r.f1, r.support) for r in ev.class_scores(preds).collect()}
    assert set(scores) == {0, 1, 2}
    assert scores[2] == (0.0, 0.0, 0.0, 2)
    assert scores[0][0] == pytest.approx(1 / 3)
    macro = ev.precision_recall(preds).first()
    assert macro.precision == pytest.approx((1 / 3 + 1) / 3) and macro.recall == pytest.approx(2 / 3)
    report = {r.name: r for r in ev.classification_report(preds).collect()}
    assert report["accuracy"].f1 == 0.5 and report["macro avg"].support == 4
    assert report["weighted avg"].recall == pytest.approx(0.5)


def pair_auc(scores):
    """Brute force over all pairs of a positive and a negative."""
    pos = [s for s, hit in scores if hit]
    neg = [s for s, hit in scores if not hit]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auroc_with_ties(preds, data):
    got = {r.label: r.auroc for r in ev.auroc_by_class(preds).collect()}
    expected = {k: pair_auc([(softmax(z)[k], t == k) for t, z in data]) for k in range(3)}
    assert got == pytest.approx(expected)
    assert ev.auroc(preds).first().auroc == pytest.approx(sum(expected.values()) / 3)
    counts = [sum(t == k for t, _ in data) for k in range(3)]
    weighted = sum(expected[k] * counts[k] for k in range(3)) / sum(counts)
    assert ev.auroc(preds, "weighted").first().auroc == pytest.approx(weighted)


def test_auroc_of_a_single_truth_class_is_null(spark):
    preds = make(spark, [(1, [0.0, 1.0]), (1, [1.0, 0.0])])
    assert {r.auroc for r in ev.auroc_by_class(preds).collect()} == {None}
    assert ev.auroc(preds).first().auroc is None
    assert ev.roc_auc(preds).first().roc_auc is None


def binary(data):
    return [(int(t > 0), z[:2]) for t, z in data]


def curve_of(data):
    scored = [(softmax(z)[1], t) for t, z in data]
    p, n = sum(t for _, t in scored), sum(1 - t for _, t in scored)
    points = [(math.inf, 0.0, 0.0)]
    for cut in sorted({s for s, _ in scored}, reverse=True):
        tp = sum(t for s, t in scored if s >= cut)
        fp = sum(1 - t for s, t in scored if s >= cut)
        points.append((cut, fp / n, tp / p))
    return points


def close(a, b):
    return len(a) == len(b) and all(x == pytest.approx(y) for x, y in zip(a, b))


def test_roc_curve(spark, data):
    preds = make(spark, binary(data))
    expected = curve_of(binary(data))
    got = sorted((tuple(r) for r in ev.roc_curve(preds, drop_intermediate=False).collect()), reverse=True)
    assert close(got, expected)
    area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(expected, expected[1:]))
    assert ev.roc_auc(preds).first().roc_auc == pytest.approx(area)
    by_class = {r.label: r.auroc for r in ev.auroc_by_class(preds).collect()}
    assert by_class[1] == pytest.approx(area)


def test_roc_curve_without_straight_points(spark):
    rng = random.Random(2)
    fine = [(int(rng.random() < i / 200), [0.0, i / 50]) for i in range(200)]
    preds = make(spark, fine)
    full = curve_of(fine)
    steps = [(b[1] - a[1], b[2] - a[2]) for a, b in zip(full, full[1:])]
    keep = [i for i in range(1, len(full)) if i in (1, len(full) - 1) or steps[i - 1] != pytest.approx(steps[i], abs=1e-12)]
    got = sorted((tuple(r) for r in ev.roc_curve(preds).collect()), reverse=True)
    assert close(got, [full[0]] + [full[i] for i in keep])
    assert len(got) < len(full)


def test_cross_entropy(spark, preds, data):
    losses = [-math.log(softmax(z)[t]) for t, z in data]
    assert ev.weighted_cross_entropy(preds).first().loss == pytest.approx(sum(losses) / len(losses))
    weights = {0: 0.5, 1: 2.0, 2: 1.5}
    table = spark.createDataFrame(list(weights.items()), "label int, weight double")
    total = sum(weights[t] * v for (t, _), v in zip(data, losses)) / sum(weights[t] for t, _ in data)
    assert ev.weighted_cross_entropy(preds, table).first().loss == pytest.approx(total)


def test_rates_and_thresholds(preds, data):
    rates = {r.label: r for r in ev.class_rates(preds).collect()}
    for k in range(3):
        tp = sum(t == k and predicted(z) == k for t, z in data)
        fn = sum(t == k and predicted(z) != k for t, z in data)
        fp = sum(t != k and predicted(z) == k for t, z in data)
        tn = len(data) - tp - fn - fp
        r = rates[k]
        assert (r.tp, r.fn, r.fp, r.tn) == (tp, fn, fp, tn)
        assert r.sensitivity == pytest.approx(tp / (tp + fn)) and r.specificity == pytest.approx(tn / (tn + fp))
    met = ev.meets_thresholds(ev.class_rates(preds), {"sensitivity": ("min", 0.0), "specificity": ("max", 0.0)})
    assert {(r.metric, r.met) for r in met.collect()} == {("sensitivity", True), ("specificity", False)}


def test_best_epoch(spark):
    log = spark.createDataFrame(
        [("a", 1, "val_loss", 0.5), ("a", 2, "val_loss", 0.3), ("a", 3, "val_loss", 0.3), ("a", 3, "acc", 0.1),
         ("b", 1, "val_loss", None), ("b", 2, "val_loss", 0.9)],
        "run_id string, epoch int, metric string, value double",
    )
    best = rows(ev.best_checkpoint(log).select("run_id", "epoch", "metric_value", "mode", "monitored_metric"))
    assert best == [("a", 2, 0.3, "min", "val_loss"), ("b", 2, 0.9, "min", "val_loss")]
    top = rows(ev.best_checkpoint(log, mode="max", k=2).select("run_id", "epoch", "place"))
    assert top == [("a", 1, 1), ("a", 2, 2), ("b", 2, 1)]
    with pytest.raises(ValueError):
        ev.best_checkpoint(log, mode="mean")


def test_epoch_means_are_weighted(spark):
    log = spark.createDataFrame(
        [("a", 1, "loss", 1.0, 8), ("a", 1, "loss", 4.0, 4), ("a", 2, "loss", 7.0, 1)],
        "run_id string, epoch int, metric string, value double, batch_size int",
    )
    assert rows(epoch_metric(log)) == [("a", 1, "loss", 2.0, 2), ("a", 2, "loss", 7.0, 1)]


def test_class_weights(spark):
    labels = spark.createDataFrame([("a", 0)] * 3 + [("a", 1)] + [("b", 5)] * 4 + [("b", None)], "g string, label int")
    by_group = rows(class_weights(labels, ["g"]).select("g", "label", "weight"))
    assert by_group == [("a", 0, pytest.approx(4 / 6)), ("a", 1, 2.0), ("b", 5, 1.0)]
    overall = class_weights(labels).collect()
    assert sum(r.n_class * r.weight for r in overall) == pytest.approx(8)
    assert class_weights(labels.where("g = 'x'")).count() == 0


def test_stats_and_nested_manifest(spark):
    people = spark.createDataFrame(
        [("1", "train", [0]), ("2", "train", [1]), ("3", "train", [1]), ("4", "test", [0, 1]), ("5", "test", [])],
        "subject_key string, split string, labels array<bigint>",
    )
    stats = {(r.split, r.stat, r.key): r.value for r in dataset_stats(people).collect()}
    assert stats[("train", "n_samples", None)] == 3 and stats[("test", "n_samples", None)] == 2
    assert stats[("train", "N", "1")] == 2 and stats[("train", "class_weights", "0")] == 1.5
    assert stats[("test", "N", "0")] == 1 and ("validation", "n_samples", None) not in stats
    nested = nested_manifest(data_manifest(people, {"Normal": 0, "Positive": 1, "None": None})).first()
    assert nested.N_patients == 5 and nested.labels == {"Normal": 0, "Positive": 1, "None": None}
    assert nested.train.counts == {"N_0": 1, "N_1": 2} and nested.train.class_weights == [1.5, 0.75]
    assert nested.validation.n_samples is None and nested.validation.class_weights == []


def test_profile_and_bias(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, None, 1), (2, "b", 1), (None, "b", 1)], "n int, s string, label int")
    profile = {r.column_name: tuple(r)[1:] for r in dataset_profile(df).collect()}
    assert profile["n"] == (4, 1, 2, "1", "2") and profile["s"] == (4, 1, 2, "a", "b")
    assert {r.column_name for r in dataset_profile(df, ["s"], approx=True).collect()} == {"s"}
    bias = {(r.s, r.label): (r.n, r.share, r.bias) for r in label_bias(df, "s").collect()}
    assert bias[("b", 1)] == (2, 1.0, 0.25) and bias[("a", 0)] == (1, 1.0, 0.75)


def test_model_report(spark, data, tmp_path):
    preds = make(spark, binary(data))
    assert set(model_report(preds, 2)) == {"confusion_matrix", "classification_report", "roc_curve", "roc_auc"}
    write_model_report(preds, 2, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/confusion_matrix").agg(F.sum("n")).first()[0] == len(data)


def test_model_report_per_run(spark, data):
    """The report of several runs, one of them without a name, is the report of each alone."""
    preds = make(spark, binary(data))
    other = make(spark, binary(data)[: len(data) // 2])
    both = preds.withColumn("run_id", F.lit("a")).unionByName(other.withColumn("run_id", F.lit(None).cast("string")))
    tables = model_report(both, 2, by=["run_id"])
    for run, alone in ((F.col("run_id") == "a", preds), (F.col("run_id").isNull(), other)):
        for name, table in model_report(alone, 2).items():
            assert rows(tables[name].where(run), *table.columns) == rows(table), name


def test_nothing_is_lost(spark):
    odd = make(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (7, [1.0, 0.0]), (None, [1.0, 0.0])])
    cells = {(r.y, r.pred): r.n for r in ev.confusion_matrix(odd, 2).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1, (None, None): 2}
    weights = spark.createDataFrame([(0, 1.0), (1, 2.0)], "label int, weight double")
    with pytest.raises(Exception, match="no weight for class"):
        ev.weighted_cross_entropy(odd.where("y = 7"), weights).collect()


def test_no_value_is_no_best_value(spark):
    log = spark.createDataFrame(
        [("a", 1, "m", 0.5), ("a", 2, "m", float("nan")), ("a", 3, "m", None)], "run_id string, epoch int, metric string, value double"
    )
    assert ev.best_checkpoint(log, "m", "max").first().epoch == 1
    steps = spark.createDataFrame(
        [("a", 1, "m", 2.0, 1), ("a", 1, "m", None, 9), ("a", 2, "m", 1.0, 0)], "run_id string, epoch int, metric string, value double, batch_size int"
    )
    assert rows(epoch_metric(steps)) == [("a", 1, "m", 2.0, 2), ("a", 2, "m", None, 1)]
