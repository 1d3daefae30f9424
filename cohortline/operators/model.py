"""A weighted baseline classifier on feature columns, and scoring with any batch model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _features(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("features_vector", array_to_vector(F.col(features).cast("array<double>")))


def fit_weighted_classifier(
    train: DataFrame,
    weights: DataFrame | None = None,
    features: str = "features",
    label: str = "label",
    max_iter: int = 40,
    reg: float = 0.01,
) -> PipelineModel:
    """Multinomial logistic regression; each row weighs as its class does in ``weights``.

    ``weights`` is ``(label, weight)``, one row per class; a class of the rows without one fails the fit. Training makes a few passes over the
    rows and sends only gradients to the driver.
    """
    rows = _features(train.where(F.col(label).isNotNull()), features)
    if weights is not None:
        unknown = F.raise_error(F.concat(F.lit("no weight for class "), F.col(label).cast("string"))).cast("double")
        rows = rows.join(weights.select(F.col("label").alias(label), "weight"), label, "left")
        rows = rows.withColumn("weight", F.coalesce(F.col("weight").cast("double"), unknown))
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    fitted = LogisticRegression(
        featuresCol="features_vector",
        labelCol=label,
        weightCol="weight",
        maxIter=max_iter,
        regParam=reg,
        family="multinomial",
    ).fit(rows.select("features_vector", F.col(label).cast("double").alias(label), "weight"))
    return PipelineModel([fitted])


def score(model: PipelineModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``logits`` and ``probabilities`` arrays."""
    scored = model.transform(_features(df, features))
    return (
        scored.withColumn("logits", vector_to_array("rawPrediction"))
        .withColumn("probabilities", vector_to_array("probability"))
        .drop("features_vector", "rawPrediction", "probability", "prediction")
    )


def score_with(
    df: DataFrame,
    make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]],
    features: str = "features",
    n_features: int = 1,
    batch_size: int = 1024,
) -> DataFrame:
    """Add ``logits`` from a user model, loaded once per worker and called on batches."""
    predict = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=[[n_features]],
    )
    return df.withColumn("logits", predict(F.col(features).cast("array<float>")))
