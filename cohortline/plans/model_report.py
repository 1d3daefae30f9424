"""Model outputs to the tables of a model report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import evaluate
from ..sources.sinks import write_report


def model_report(preds: DataFrame, n_classes: int, positive: int = 1, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Confusion matrix, class report, ROC curve and its area, for each group of ``by`` such as a run."""
    return {
        "confusion_matrix": evaluate.confusion_matrix(preds, n_classes, by),
        "classification_report": evaluate.classification_report(preds, by),
        "roc_curve": evaluate.roc_curve(preds, positive, drop_intermediate=True, by=by),
        "roc_auc": evaluate.roc_auc(preds, positive, by),
    }


def write_model_report(preds: DataFrame, n_classes: int, path: str, positive: int = 1, by: Sequence[str] = ()) -> None:
    """Write each table of the report to its own folder."""
    for name, table in model_report(preds, n_classes, positive, by).items():
        write_report(table, f"{path}/{name}")
