"""Catalog to labelled, split and counted cohort: one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.catalog import label_from_experiment, scans_by_modality
from ..operators.samples import (
    LIST_ACTION,
    VALUE_ACTION,
    Action,
    Samples,
    build_samples,
    complete_samples,
    missing_data_log,
    validate_samples,
)
from ..operators.splits import bounded_sample, split_samples
from ..operators.stats import data_manifest, dataset_stats
from ..sources.catalog import Catalog


def scan_action(codes: Sequence[str] = ("CR", "DX"), name: str = "fetch_xr", label: str = "image") -> Action:
    """Scans by modality, as a list action."""
    return Action(name, label, LIST_ACTION, lambda catalog: scans_by_modality(catalog, codes))


def label_action(
    codes: Sequence[str] = ("CR", "DX"),
    sep: str = "_",
    index: int = 1,
    name: str = "fetch_label",
    label: str = "label",
) -> Action:
    """Label from the experiment name, as a value action."""
    return Action(
        name,
        label,
        VALUE_ACTION,
        lambda catalog: label_from_experiment(catalog, codes, sep, index).withColumnRenamed("label", "value"),
    )


@dataclass(frozen=True)
class Cohort:
    """A validated cohort: samples, subjects with split and labels, and the log of what was missing."""

    samples: Samples
    split: DataFrame
    missing: DataFrame

    def stats(self, by: Sequence[str] = ()) -> DataFrame:
        return dataset_stats(self.split, by)

    def manifest(self, label_dict: Mapping[str, int | None], by: Sequence[str] = ()) -> DataFrame:
        return data_manifest(self.split, label_dict, by)


def run_cohort(
    catalog: Catalog,
    actions: Sequence[Action],
    required: Sequence[str],
    test_batch: int = -1,
    on_failure: str = "keep_partial",
    seed: object = 42,
    fractions: Sequence[float] = (0.5, 0.25, 0.25),
    exact: bool = False,
) -> Cohort:
    """Sample subjects (optional), run the actions, check completeness, validate and split.

    Everything up to the statistics needs one row per subject, so no image item is ever shuffled.
    """
    keys = catalog.keys("subject_key")
    if test_batch > 0:
        catalog = catalog.with_subjects(bounded_sample(catalog.subjects, test_batch, seed, keys))
    built = build_samples(catalog, actions, on_failure)
    valid = validate_samples(complete_samples(built), required)
    labels = F.transform(valid.values_of("label"), lambda v: v.try_cast("bigint"))
    subjects = valid.subjects.select(*keys, "subject_id", "subject_uri", labels.alias("labels"))
    split = split_samples(subjects, seed, fractions, exact, keys)
    return Cohort(valid, split, missing_data_log(built))
