"""Selection of scans and labels from the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import contains_any, label_number
from ..schemas import POSITION
from ..sources.catalog import PROJECT, Catalog, check_scope
from .joins import keep_left


def sample_base(catalog: Catalog) -> DataFrame:
    """Subject address and subject id, the head of every sample."""
    return catalog.subjects.select(*catalog.keys("subject_key"), "subject_uri", "subject_id")


def catalog_join(catalog: Catalog) -> DataFrame:
    """Subject, experiment and scan in one row; subjects and experiments without children stay.

    From the top down, so that the largest level, the scans, is read and shuffled once.
    """
    people = keep_left(catalog.subjects, catalog.experiments, catalog.keys("subject_key"))
    return keep_left(people, catalog.scans, catalog.keys("exp_key"))


def catalog_counts(catalog: Catalog) -> DataFrame:
    """Rows per catalog level."""
    levels = [
        ("subjects", catalog.subjects),
        ("experiments", catalog.experiments),
        ("scans", catalog.scans),
        ("resources", catalog.resources),
    ]
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("level"), "n_rows")
        for name, table in levels
        if table is not None
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _scans_of(catalog: Catalog, experiments: Column) -> DataFrame:
    keys = catalog.keys("exp_key")
    chosen = catalog.experiments.where(experiments).select(*keys, "subject_key", "exp_ordinal")
    scans = catalog.scans.select(*keys, "scan_key", "scan_ordinal", "series_description", "uri")
    return chosen.join(scans, keys)


def scans_by_modality(catalog: Catalog, codes: Sequence[str] = ("CR", "DX")) -> DataFrame:
    """All scans of experiments whose modality contains any of the codes."""
    return _scans_of(catalog, contains_any(F.col("modality"), list(codes)))


def scans_by_series(
    catalog: Catalog, exp_contains: str, series_contains: str, first: bool = True
) -> DataFrame:
    """Scans whose experiment label and series description contain the given texts.

    ``first`` keeps the first one per subject in catalog order, by an aggregate that combines
    before the shuffle, so a subject with very many scans costs no more than others.
    """
    found = _scans_of(catalog, F.col("label").contains(exp_contains)).where(
        F.col("series_description").contains(series_contains)
    )
    if not first:
        return found
    best = F.min(F.struct(*POSITION, "series_description", "uri")).alias("best")
    keys = catalog.keys("subject_key")
    return found.groupBy(*keys).agg(best).select(*keys, "best.*")


def label_from_experiment(
    catalog: Catalog, codes: Sequence[str] = ("CR", "DX"), sep: str = "_", index: int = 1
) -> DataFrame:
    """Integer label of each subject with a matching experiment.

    The last matching experiment in catalog order wins. One malformed label among the matching
    experiments sets ``error`` for the subject. Subjects without a match have no row.
    """
    matching = catalog.experiments.where(contains_any(F.col("modality"), list(codes))).select(
        *catalog.keys("subject_key"), "exp_ordinal", "exp_key", label_number(F.col("label"), sep, index).alias("number")
    )
    per_subject = matching.groupBy(*catalog.keys("subject_key")).agg(
        F.max_by("number", F.struct("exp_ordinal", "exp_key")).alias("label"),
        F.bool_or(F.col("number").isNull()).alias("error"),
    )
    return per_subject.withColumn("label", F.when(~F.col("error"), F.col("label")))


def attach_resource_files(items: DataFrame, resources: DataFrame, uri: str = "action_data") -> DataFrame:
    """Add the file list of items that point at a resource; null for all others.

    An address is unique inside a project only: where both sides carry ``project_id`` it is part of the key, and
    ``ValueError`` if only one does. Items are the preserved side, so adaptive execution can split an address that many
    items share.
    """
    check_scope({"items": PROJECT in items.columns, "resources": PROJECT in resources.columns})
    scope = [PROJECT] if PROJECT in resources.columns else []
    lists = resources.select(*scope, F.col("uri").alias(uri), "resource_files")
    return items.drop("resource_files").join(lists, [*scope, uri], "left")
