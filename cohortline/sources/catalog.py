"""Imaging catalog: one table per level of project / subject / experiment / scan."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

PROJECT = "project_id"
LEVELS = {
    "subjects": schemas.SUBJECTS,
    "experiments": schemas.EXPERIMENTS,
    "scans": schemas.SCANS,
    "resources": schemas.RESOURCES,
}


@dataclass(frozen=True)
class Catalog:
    """The tables of one or many projects.

    ``subjects``    subject_key, subject_id, subject_uri
    ``experiments`` subject_key, exp_key, exp_ordinal, modality, label
    ``scans``       exp_key, scan_key, scan_ordinal, series_description, uri
    ``resources``   uri, resource_files

    Keys are unique inside a project only: where the tables carry ``project_id``, it is part of every key. Either all
    levels carry it or none does; a null project is no project, so ``read_catalog`` names it.
    """

    subjects: DataFrame
    experiments: DataFrame
    scans: DataFrame
    resources: DataFrame | None = None

    def __post_init__(self) -> None:
        levels = {name: getattr(self, name) for name in LEVELS}
        check_scope({name: PROJECT in table.columns for name, table in levels.items() if table is not None})

    @property
    def scope(self) -> list[str]:
        """``project_id`` if the levels carry it."""
        return [PROJECT] if PROJECT in self.subjects.columns else []

    def keys(self, name: str) -> list[str]:
        """The columns that make a key of one level unique."""
        return [*self.scope, name]

    def with_subjects(self, subjects: DataFrame) -> Catalog:
        """The catalog of some subjects, such as a sample: the experiments of others leave before
        any scan is joined."""
        keys = self.keys("subject_key")
        mine = self.experiments.join(subjects.select(*keys), keys, "left_semi")
        return replace(self, subjects=subjects, experiments=mine)


def check_scope(carries: dict[str, bool]) -> None:
    """``ValueError`` if some levels carry a project and others do not: their keys could not be matched."""
    if len(set(carries.values())) > 1:
        without = sorted(name for name, has in carries.items() if not has)
        raise ValueError(f"all levels of a catalog carry {PROJECT} or none; without it: {', '.join(without)}")


def _carries_project(spark: SparkSession, path: str) -> bool | None:
    """Whether files or partitions under a path name a project; none if there is no file to tell."""
    try:
        return PROJECT in spark.read.parquet(path).columns
    except AnalysisException as problem:
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_catalog(spark: SparkSession, path: str, projects: Iterable[str] | None = None) -> Catalog:
    """Read ``path/<level>`` parquet tables, with or without ``project_id``; ``resources`` may be absent.

    Tables written with ``partitionBy('project_id')`` are pruned to the asked projects. Rows without a project, in
    tables that have the column, belong to the project named by the empty text. ``ValueError`` if only some levels
    have the column, or if projects are asked of tables without it. A level without files is empty.
    """
    wanted = list(projects) if projects is not None else None
    carries: dict[str, bool | None] = {}
    for name in LEVELS:
        try:
            carries[name] = _carries_project(spark, f"{path}/{name}")
        except AnalysisException as problem:
            if name != "resources" or problem.getCondition() != "PATH_NOT_FOUND":
                raise
    check_scope({name: has for name, has in carries.items() if has is not None})
    scoped = any(carries.values())
    if wanted is not None and not scoped:
        raise ValueError(f"this catalog has no {PROJECT}, so no projects can be asked for")

    def level(name: str, schema: T.StructType) -> DataFrame:
        if not scoped:
            schema = T.StructType([f for f in schema if f.name != PROJECT])
        if carries[name] is None:
            return spark.createDataFrame([], schema)
        table = spark.read.schema(schema).parquet(f"{path}/{name}")
        if wanted is not None:
            table = table.where(F.col(PROJECT).isin(wanted))
        return table.withColumn(PROJECT, F.coalesce(PROJECT, F.lit(""))) if scoped else table

    return Catalog(**{name: level(name, LEVELS[name]) for name in carries})


def write_catalog(catalog: Catalog, path: str) -> None:
    """Write the levels, partitioned by project where they carry one: the layout ``read_catalog`` prunes."""
    for name in LEVELS:
        table = getattr(catalog, name)
        if table is not None:
            writer = table.write.mode("overwrite")
            (writer.partitionBy(PROJECT) if catalog.scope else writer).parquet(f"{path}/{name}")
