"""Samples: the result of running ordered actions on every subject.

An action is relational: it maps the catalog to rows of many subjects at once. Items stay in long
form, one row per item; what happened to each subject is one row per subject.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import POSITION
from ..sources.catalog import Catalog
from ..sources.storage import settle
from .ranks import ordered_position

# Kinds of item data, as they appear in results.
URI, VALUE = "xnat_uri", "value"

OK, MISSING, ERROR = "ok", "missing", "error"
LIST_ACTION, VALUE_ACTION = "list", "value"

_POSITION_TYPES = ("bigint", "string", "bigint", "string")


@dataclass(frozen=True)
class Action:
    """A named step that yields a list of catalog objects or one value per subject.

    ``fn(catalog)`` returns, for kind ``list``, one row per object with ``subject_key``, ``uri``
    (its address, never null) and the catalog position columns that apply; for kind ``value``, one row per subject
    with ``subject_key``, ``value`` and, if the step can fail, a boolean ``error``. A value action
    that ends in an aggregate by subject is joined where it lies, without another shuffle. A value action that gives a
    subject several rows has failed for it: the subject stays one row, with the status ``error``.
    A value counts as text if its column is a string column. Over a catalog of several projects the rows also
    carry ``project_id``.
    """

    name: str
    label: str
    kind: str
    fn: Callable[[Catalog], DataFrame]

    def rows(self, catalog: Catalog, ordinal: int) -> DataFrame:
        if self.kind not in (LIST_ACTION, VALUE_ACTION):
            raise ValueError(f"action kind is {LIST_ACTION!r} or {VALUE_ACTION!r}, not {self.kind!r}")
        found = self.fn(catalog)
        data = F.col("uri" if self.kind == LIST_ACTION else "value")
        is_text = dict(found.dtypes).get("value") == "string"

        def given(name: str, kind: str) -> Column:
            return (F.col(name) if name in found.columns else F.lit(None)).cast(kind).alias(name)

        return found.select(
            *catalog.keys("subject_key"),
            F.lit(ordinal).alias("action_ordinal"),
            data.cast("string").alias("action_data"),
            F.lit(self.kind == LIST_ACTION or is_text).alias("is_text"),
            F.coalesce(given("error", "boolean"), F.lit(False)).alias("error"),
            given("exp_ordinal", "bigint"),
            given("exp_key", "string"),
            given("scan_ordinal", "bigint"),
            given("scan_key", "string"),
        )


@dataclass(frozen=True)
class Samples:
    """Subjects with their action results.

    ``keys``        the columns that name a subject: subject_key, before it project_id over several projects
    ``subjects``    the keys, subject_id, subject_uri, status ARRAY, n_found ARRAY (kept items per
                    action), found_value ARRAY (kept value of each value action), first_fail
                    (ordinal of the first action that stopped, or null)
    ``object_rows`` objects found by the list actions for all subjects, before stops are applied

    Values live in the one row of their subject, so labels never need an item join.
    """

    subjects: DataFrame
    object_rows: DataFrame
    actions: tuple[Action, ...]
    strict: bool
    keys: tuple[str, ...] = ("subject_key",)

    def _name(self, pick: Callable[[Action], str], ordinal: Column) -> Column:
        names = F.array(*[F.lit(pick(a)) for a in self.actions]) if self.actions else F.array(F.lit(""))
        return F.get(names, ordinal)

    def _item_columns(self, data: Column, kind: str, position: bool) -> list[Column]:
        places = [F.col(c) for c in POSITION]
        if not position:
            places = [F.lit(None).cast(t).alias(c) for c, t in zip(POSITION, _POSITION_TYPES)]
        return [
            *[F.col(k) for k in self.keys],
            F.col("subject_id"),
            F.col("action_ordinal"),
            self._name(lambda a: a.name, F.col("action_ordinal")).alias("source_action"),
            data.alias("action_data"),
            F.lit(kind).alias("data_type"),
            self._name(lambda a: a.label, F.col("action_ordinal")).alias("data_label"),
            *places,
        ]

    def n_ran(self) -> Column:
        """Number of actions that gave a result: all before the first stop."""
        return F.coalesce("first_fail", F.lit(len(self.actions)))

    @property
    def object_items(self) -> DataFrame:
        """One row per catalog object of the kept subjects.

        One equi join; the side with one row per subject is the status table, so a subject with
        very many objects can be split.
        """
        ran = self.subjects.select(*self.keys, "subject_id", self.n_ran().alias("n_ran"))
        kept = self.object_rows.join(ran, list(self.keys)).where(F.col("action_ordinal") < F.col("n_ran"))
        return kept.select(*self._item_columns(F.col("action_data"), URI, True))

    @property
    def value_items(self) -> DataFrame:
        """One row per value of the kept subjects, straight from their status rows."""
        values = self.subjects.select(
            *self.keys,
            "subject_id",
            self.n_ran().alias("n_ran"),
            F.posexplode("found_value").alias("action_ordinal", "value"),
        ).where(F.col("value").isNotNull() & (F.col("action_ordinal") < F.col("n_ran")))
        return values.select(*self._item_columns(F.col("value"), VALUE, False))

    @property
    def items(self) -> DataFrame:
        """One row per item of the kept subjects, for actions before the first stop."""
        return self.object_items.unionByName(self.value_items)

    def values_of(self, label: str) -> Column:
        """Values under a label as an array, an expression on ``subjects``."""
        wanted = [k for k, a in enumerate(self.actions) if a.kind == VALUE_ACTION and a.label == label]
        found = [F.when(F.lit(k) < self.n_ran(), F.get("found_value", F.lit(k))) for k in wanted]
        if not found:
            return F.array().cast("array<string>")
        if len(found) == 1:
            return F.when(found[0].isNotNull(), F.array(found[0])).otherwise(F.array().cast("array<string>"))
        return F.array_compact(F.array(*found))

    @property
    def status(self) -> DataFrame:
        """One row per subject and action that ran: ok, missing or error."""
        ran = self.subjects.select(
            *self.keys, "subject_id", "first_fail", F.posexplode("status").alias("action_ordinal", "status")
        )
        return ran.where(
            F.col("first_fail").isNull() | (F.col("action_ordinal") <= F.col("first_fail"))
        ).select(
            *self.keys,
            "subject_id",
            "action_ordinal",
            self._name(lambda a: a.name, F.col("action_ordinal")).alias("source_action"),
            "status",
        )

    def n_items(self) -> Column:
        """Items of a subject, as an expression on ``subjects``; no item row is read for it."""
        ran = [F.when(F.lit(k) < self.n_ran(), F.get("n_found", F.lit(k))).otherwise(0) for k in range(len(self.actions))]
        return reduce(Column.__add__, ran, F.lit(0).cast("bigint"))

    def settled(self) -> Samples:
        """The same samples with the subject table written once, for runs with several outputs."""
        return replace(self, subjects=settle(self.subjects))

    def only(self, condition: Column) -> Samples:
        return replace(self, subjects=self.subjects.where(condition))


def build_samples(catalog: Catalog, actions: Sequence[Action], on_failure: str = "keep_partial") -> Samples:
    """Run the actions in order on every subject of the catalog.

    ``keep_partial``: a null, empty or failing action stops the subject; items of earlier actions
    stay. ``drop``: an empty list or an error removes the subject, a null value gives an empty
    group, and only text values are kept as items.
    """
    if on_failure not in ("keep_partial", "drop"):
        raise ValueError("on_failure is 'keep_partial' or 'drop'")
    strict = on_failure == "drop"
    keys = catalog.keys("subject_key")
    base = catalog.subjects.select(*keys, "subject_id", "subject_uri")
    if not actions:
        subjects = base.select(
            "*",
            F.array().cast("array<string>").alias("status"),
            F.array().cast("array<bigint>").alias("n_found"),
            F.array().cast("array<string>").alias("found_value"),
            F.lit(None).cast("int").alias("first_fail"),
        )
        rows = catalog.subjects.where(F.lit(False)).select(
            *keys,
            F.lit(0).alias("action_ordinal"),
            F.lit("").alias("action_data"),
            F.lit(True).alias("is_text"),
            F.lit(False).alias("error"),
            F.lit(None).cast("bigint").alias("exp_ordinal"),
            F.lit(None).cast("string").alias("exp_key"),
            F.lit(None).cast("bigint").alias("scan_ordinal"),
            F.lit(None).cast("string").alias("scan_key"),
        )
        return Samples(subjects, rows, (), strict, tuple(keys))

    tables = [a.rows(catalog, k) for k, a in enumerate(actions)]
    lists = [k for k, a in enumerate(actions) if a.kind == LIST_ACTION]
    objects = reduce(DataFrame.unionByName, [tables[k] for k in lists] or [tables[0].where(F.lit(False))])
    subjects = base
    if lists:
        # One hash aggregate for all list actions, with fixed-width buffers, combined before its shuffle.
        mine = {k: F.col("action_ordinal") == k for k in lists}
        counts = objects.groupBy(*keys).agg(
            *[F.count_if(mine[k]).alias(f"n_{k}") for k in lists],
            *[F.bool_or(mine[k] & F.col("error")).alias(f"bad_{k}") for k in lists],
        )
        subjects = subjects.join(counts, keys, "left")
    for k, action in enumerate(actions):
        if action.kind == VALUE_ACTION:
            value = tables[k].groupBy(*keys).agg(
                F.max("action_data").alias(f"value_{k}"),
                F.bool_or("is_text").alias(f"text_{k}"),
                (F.bool_or("error") | (F.count(F.lit(1)) > 1)).alias(f"bad_{k}"),
            )
            subjects = subjects.join(value, keys, "left")

    nothing, none = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    status, n_found, found_value = [], [], []
    for k, action in enumerate(actions):
        bad = F.coalesce(F.col(f"bad_{k}"), F.lit(False))
        if action.kind == LIST_ACTION:
            found = F.coalesce(F.col(f"n_{k}"), nothing)
            empty, value = found == 0, none
        else:
            kept = F.col(f"value_{k}").isNotNull() & (F.col(f"text_{k}") if strict else F.lit(True))
            found, value = F.when(kept, 1).otherwise(0).cast("bigint"), F.when(kept, F.col(f"value_{k}"))
            empty = F.lit(False) if strict else F.col(f"value_{k}").isNull()
        status.append(F.when(bad, ERROR).when(empty, MISSING).otherwise(OK))
        n_found.append(found)
        found_value.append(value)
    subjects = subjects.select(
        *base.columns,
        F.array(*status).alias("status"),
        F.array(*n_found).alias("n_found"),
        F.array(*found_value).alias("found_value"),
        F.coalesce(*[F.when(s != OK, F.lit(k)) for k, s in enumerate(status)]).alias("first_fail"),
    )
    return Samples(subjects, objects.where(~F.col("error")), tuple(actions), strict, tuple(keys))


def surviving(samples: Samples) -> Samples:
    """In strict mode the subjects that no action stopped; in partial mode all."""
    return samples.only(F.col("first_fail").isNull()) if samples.strict else samples


def complete_samples(samples: Samples, n_actions: int | None = None, by: str = "items") -> Samples:
    """Subjects with at least as many items (or action groups) as actions.

    Counting items is the lenient rule: two scans and no label pass it for two actions.
    """
    if by not in ("items", "groups"):
        raise ValueError("by is 'items' or 'groups'")
    need = len(samples.actions) if n_actions is None else n_actions
    have = samples.n_items() if by == "items" else samples.n_ran()
    return surviving(samples).only(have >= need)


def _has_all(samples: Samples, required: Sequence[str]) -> Column:
    ordinals = {a.name: k for k, a in enumerate(samples.actions)}
    ran = samples.n_ran()
    every = F.lit(True)
    for name in required:
        k = ordinals.get(name)
        every = every & (F.lit(False) if k is None else (F.lit(k) < ran) & (F.get("n_found", F.lit(k)) > 0))
    return every


def validate_samples(samples: Samples, required: Sequence[str] = ("fetch_xr", "fetch_label")) -> Samples:
    """Subjects with at least one item from every required action."""
    return surviving(samples).only(_has_all(samples, required))


def invalid_count(samples: Samples, required: Sequence[str] = ("fetch_xr", "fetch_label")) -> DataFrame:
    """Number of subjects that ``validate_samples`` removes."""
    return surviving(samples).subjects.agg(
        F.count_if(~_has_all(samples, required)).alias("n_invalid"), F.count(F.lit(1)).alias("n_samples")
    )


def missing_data_log(samples: Samples) -> DataFrame:
    """Subjects stopped by an action that found nothing; errors are not logged."""
    stopped = F.get("status", F.col("first_fail"))
    return samples.subjects.where(stopped == MISSING).select(
        *samples.keys[:-1],
        F.col("subject_key").alias("subject_id"),
        F.col("subject_id").alias("subject_label"),
        samples._name(lambda a: a.name, F.col("first_fail")).alias("failed_action"),
    )


# ---- item tables -----------------------------------------------------------------------------


def _subject_columns(items: DataFrame) -> list[str]:
    """What names a subject in an item table: its key and project as well as its id."""
    return [c for c in ("project_id", "subject_key", "subject_id") if c in items.columns]


def duplicate_labels(items: DataFrame) -> DataFrame:
    """Samples where one label occurs more than once."""
    return (
        items.groupBy(*_subject_columns(items), "data_label")
        .agg(F.count(F.lit(1)).alias("n_items"))
        .where(F.col("n_items") > 1)
    )


def promote_values(items: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Value items as named columns of their sample; a later action overwrites an earlier one."""
    values = items.where(F.col("data_type") == VALUE)
    last = [
        F.max_by(
            F.when(F.col("data_label") == name, F.col("action_data")),
            F.when(F.col("data_label") == name, F.col("action_ordinal")),
        ).alias(name)
        for name in labels
    ]
    return values.groupBy(*_subject_columns(items)).agg(*last)


def select_items(df: DataFrame, keys: Sequence[str], allow_missing: bool = True) -> DataFrame:
    """Only the listed columns; absent ones are skipped, or rejected if not allowed."""
    absent = [k for k in keys if k not in df.columns]
    if absent and not allow_missing:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    return df.select(*[k for k in keys if k in df.columns])


#: Items of a subject that are grouped in one array and cut there; the items of larger subjects are ordered over tasks.
WHOLE = 10_000


def nest_items(samples: Samples, chunk_size: int = 10_000) -> DataFrame:
    """Samples as rows ``(subject_key, subject_id, subject_uri, chunk, n_chunks, data)``.

    ``data`` is ``ARRAY<ARRAY<item>>``, one inner array per action that ran, in action order. A
    subject's items are cut by position into ``n_chunks`` rows of at most ``chunk_size``, at least one, so that
    no array grows without bound and no item is lost. How many items a subject has stands in its status row: those
    with one chunk, or WHOLE items at most, are grouped where the join by subject left them, only the items of the others are ordered
    over tasks.
    """
    kept = surviving(samples).settled()
    n_chunks = F.greatest(F.lit(1), F.ceil(kept.n_items() / chunk_size)).cast("bigint")
    keys = list(kept.keys)
    small = kept.n_items() <= max(chunk_size, WHOLE)
    grouped, several = kept.only(small), kept.only(~small)
    rows = grouped.object_items
    if chunk_size < WHOLE:
        # Where there are chunks to cut, the values have their place among the objects.
        rows = rows.unionByName(grouped.only(n_chunks > 1).value_items)
    lists = rows.groupBy(*keys).agg(_collected_items().alias("objects"))
    values = _value_list(grouped)
    alone = F.when(F.col("objects").isNull(), values).otherwise(F.concat("objects", values))
    starts = F.sequence(F.lit(1), F.array_size("objects"), F.lit(chunk_size))
    cut = F.when(n_chunks == 1, F.array(alone)).otherwise(F.transform(starts, lambda at: F.slice("objects", at, chunk_size)))
    heads = grouped.subjects.join(lists, keys, "left").select(*grouped.subjects.columns, F.posexplode(cut).alias("chunk", "found"))
    nested = _nested_rows(grouped, heads, F.col("chunk").cast("bigint"), n_chunks)
    # The subject table is written, so this looks at as many status rows as it takes to find one.
    if several.subjects.isEmpty():
        return nested
    placed = ordered_position(several.items, keys, ITEM_ORDER)
    pieces = (
        placed.withColumn("chunk", F.floor((F.col("position") - 1) / chunk_size))
        .groupBy(*keys, "chunk")
        .agg(_collected_items().alias("found"))
    )
    return nested.unionByName(_nested_rows(several, several.subjects.join(pieces, keys), F.col("chunk"), n_chunks))


ITEM_ORDER = ["action_ordinal", *POSITION, "action_data"]
_ITEM_REST = ["source_action", "data_type", "data_label"]


def _collected_items() -> Column:
    return F.array_sort(F.collect_list(F.struct(*ITEM_ORDER, *_ITEM_REST)))


def _value_list(samples: Samples) -> Column:
    """The value items of a subject as one array, an expression on ``subjects``."""

    def item(value: Column, ordinal: Column) -> Column:
        places = [F.lit(None).cast(t).alias(c) for c, t in zip(POSITION, _POSITION_TYPES)]
        return F.struct(
            ordinal.alias("action_ordinal"),
            *places,
            value.alias("action_data"),
            samples._name(lambda a: a.name, ordinal).alias("source_action"),
            F.lit(VALUE).alias("data_type"),
            samples._name(lambda a: a.label, ordinal).alias("data_label"),
        )

    ran = samples.n_ran()
    return F.filter(
        F.transform("found_value", item), lambda v: v.action_data.isNotNull() & (v.action_ordinal < ran)
    )


def _nested_rows(samples: Samples, heads: DataFrame, chunk: Column, n_chunks: Column) -> DataFrame:
    """Rows with the items in ``found`` cut into one inner array per action that ran."""
    ran = samples.n_ran()
    ordinals = F.when(ran > 0, F.sequence(F.lit(0), ran - 1)).otherwise(F.array().cast("array<int>"))
    return heads.select(
        *samples.keys,
        "subject_id",
        "subject_uri",
        chunk.alias("chunk"),
        n_chunks.alias("n_chunks"),
        F.transform(
            ordinals,
            lambda k: F.coalesce(F.filter("found", lambda item: item.action_ordinal == k), F.array()),
        ).alias("data"),
    )


def flatten_items(nested: DataFrame) -> DataFrame:
    """Inner arrays joined to one list per row, in action order."""
    return nested.withColumn("data", F.flatten("data"))
