"""Column profiles that merge: sketches stored per group, and added up later without reading rows again.

One row per group and column holds counts, range and three sketches: distinct values (HLL), order (KLL: of numbers their
values, of texts their lengths) and the value set (theta), which also tells how much two groups share. Their sizes are
fixed by the parameters below, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: log2 of HLL registers and of theta entries (relative standard error about 1.6 %), and the KLL size (rank error about 1.3 %).
HLL_LOG2, THETA_LOG2, KLL_SIZE = 12, 12, 200
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _one_zero(df: DataFrame, name: str) -> Column:
    """The column with one floating zero, since -0.0 equals 0.0."""
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return F.col(name) + F.lit(0.0) if floating else F.col(name)


def _measure(df: DataFrame, name: str) -> Column:
    """What is ordered: a number itself, the length of a text, nothing for other types; NaN has no place."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        number = _one_zero(df, name).cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(kind, T.StringType):
        return F.length(name).cast("double")
    return F.lit(None).cast("double")


def profile_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` and column: ``n_rows``, ``n_null``, ``low`` and ``high`` of the measure, and the sketches.

    One aggregate for all columns with buffers of fixed size, combined before its shuffle. A group without a value has
    empty sketches. ``by`` may be the project and the day, so that each day's rows are read once.
    """
    names = [c for c in (columns or df.columns) if c not in by]
    lines = df.select(
        *by,
        *[F.xxhash64(_one_zero(df, c)).alias(f"h_{i}") for i, c in enumerate(names)],
        *[F.col(c).isNotNull().alias(f"g_{i}") for i, c in enumerate(names)],
        *[_measure(df, c).alias(f"m_{i}") for i, c in enumerate(names)],
    )
    wide = lines.groupBy(*by).agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(~F.col(f"g_{i}")).alias("n_null"),
                F.min(f"m_{i}").alias("low"),
                F.max(f"m_{i}").alias("high"),
                F.hll_sketch_agg(F.when(F.col(f"g_{i}"), F.col(f"h_{i}")), HLL_LOG2).alias("distinct_sketch"),
                F.kll_sketch_agg_double(f"m_{i}", KLL_SIZE).alias("order_sketch"),
                F.theta_sketch_agg(F.when(F.col(f"g_{i}"), F.col(f"h_{i}")), THETA_LOG2).alias("set_sketch"),
            ).alias(f"line_{i}")
            for i, c in enumerate(names)
        ]
    )
    return wide.select(*by, F.inline(F.array(*[f"line_{i}" for i in range(len(names))])))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows added up per group of ``by`` and column, in the same form: days to months, projects to all."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("order_sketch", KLL_SIZE).alias("order_sketch"),
        F.theta_union_agg("set_sketch", THETA_LOG2).alias("set_sketch"),
    )


def read_profile(sketches: DataFrame) -> DataFrame:
    """Counts, estimated distinct values, range and quantiles of each sketch row; null quantiles where nothing is ordered."""
    ranks = F.array(*[F.lit(q) for q in QUANTILES])
    return sketches.select(
        *[c for c in sketches.columns if not c.endswith("_sketch")],
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("order_sketch", ranks)).alias("quantiles"),
    )


def shared_values(sketches: DataFrame, group: str, column: str) -> DataFrame:
    """How many values of a column each two groups share: ``(left_group, right_group, n_left, n_right, n_shared)``, estimated.

    For a check that splits do not overlap. Groups are paired by an equal column name, on sketch rows only: as many as there are
    groups, never the rows of the data.
    """
    mine = sketches.where(F.col("column_name") == column)
    one = mine.select("column_name", F.col(group).alias("left_group"), F.col("set_sketch").alias("left_set"))
    two = mine.select("column_name", F.col(group).alias("right_group"), F.col("set_sketch").alias("right_set"))
    pairs = one.join(two, "column_name").where(F.col("left_group") < F.col("right_group"))
    return pairs.select(
        "left_group",
        "right_group",
        F.theta_sketch_estimate("left_set").alias("n_left"),
        F.theta_sketch_estimate("right_set").alias("n_right"),
        F.theta_sketch_estimate(F.theta_intersection("left_set", "right_set")).alias("n_shared"),
    )


def exact_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n_distinct)`` of plain columns, in two levels: (column, value digest), then column.

    What travels is a digest of 16 bytes per different value of a task, never the value, so long texts cost no
    more than numbers. Nested columns are refused: their values have no one text form.
    An empty table gives no rows.
    """
    nested = [c for c in columns if isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    if nested:
        raise ValueError(f"no exact distinct count for nested columns: {', '.join(nested)}")

    def digest(name: str) -> Column:
        value = _one_zero(df, name)
        return F.unhex(F.md5(value if isinstance(df.schema[name].dataType, T.BinaryType) else value.cast("string")))

    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), digest(c).alias("digest")) for c in columns])
    values = df.select(F.inline(lines)).distinct()
    return values.groupBy("column_name").agg(F.count("digest").alias("n_distinct"))
