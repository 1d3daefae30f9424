from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.functions.classes import argmax
from cohortline.operators.model import fit_weighted_classifier, score, score_with
from cohortline.operators.stats import class_weights


@pytest.fixture(scope="module")
def rows_of_two_classes(spark):
    """Nine of ten rows are class 0, and the classes overlap."""
    rng = np.random.default_rng(7)
    data = [(i, int(i % 10 == 0), [float(v) for v in rng.normal(1.0 if i % 10 == 0 else 0.0, 1.0, 2)]) for i in range(600)]
    return spark.createDataFrame(data, "id int, label int, features array<float>")


def recall_of_rare(scored):
    hits = scored.where("label = 1").agg(F.avg((argmax(F.col("logits")) == 1).cast("double"))).first()[0]
    return hits


def test_weights_help_the_rare_class(rows_of_two_classes):
    df = rows_of_two_classes
    plain = score(fit_weighted_classifier(df), df)
    weighted = score(fit_weighted_classifier(df, class_weights(df)), df)
    assert weighted.columns == ["id", "label", "features", "logits", "probabilities"]
    assert recall_of_rare(weighted) > recall_of_rare(plain)
    shares = weighted.select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert shares[0] == pytest.approx(1) and shares[1] == pytest.approx(1)


def test_user_model(rows_of_two_classes):
    def make_predict():
        def predict(batch: np.ndarray) -> np.ndarray:
            return np.stack([-batch.sum(axis=1), batch.sum(axis=1)], axis=1)

        return predict

    scored = score_with(rows_of_two_classes, make_predict, n_features=2)
    worst = scored.select(F.max(F.abs(F.get("logits", F.lit(1)) - (F.get("features", F.lit(0)) + F.get("features", F.lit(1)))))).first()[0]
    assert worst < 1e-5
