"""Risk levels, scores and their trace to controls, requirements and tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import keep_left
from .trace import requirement_coverage

# Ordered labels of the acceptability matrix, lowest first, and its levels.
PROBABILITY_LEVELS = ("Extremely Low", "Low", "Medium", "High", "Extremely High")
SEVERITY_LEVELS = ("Negligible", "Minor", "Serious", "Critical", "Catastrophic")
RISK_LEVELS = ("Low", "Medium", "High")
LEVEL_MATRIX = (
    ("Low", "Low", "Low", "Low", "Low"),
    ("Low", "Low", "Low", "Low", "Medium"),
    ("Low", "Low", "Low", "Medium", "Medium"),
    ("Low", "Low", "Medium", "Medium", "High"),
    ("Low", "Medium", "Medium", "High", "High"),
)

# Clinical score by likelihood (rows) and severity (columns), lowest first.
LIKELIHOODS = ("Very Low", "Low", "Medium", "High", "Very High")
CLINICAL_SEVERITIES = ("Minor", "Significant", "Considerable", "Major", "Catastrophic")
SCORE_MATRIX = (
    (1, 1, 2, 2, 3),
    (1, 2, 2, 3, 4),
    (2, 2, 3, 3, 4),
    (2, 3, 3, 4, 5),
    (3, 4, 4, 5, 5),
)

# Clinical severity by kind of injury, for a single patient and for multiple patients.
SEVERITY_BY_INJURY = {
    "death or permanent": ("Major", "Catastrophic"),
    "severe": ("Considerable", "Major"),
    "minor, slow recovery": ("Significant", "Considerable"),
    "minor, quick recovery": ("Minor", "Significant"),
}

ACCEPTABLE, UNDESIRABLE, UNACCEPTABLE = "acceptable", "undesirable", "unacceptable"


def _lookup(keys: Sequence[str], values: Sequence[object], key: Column) -> Column:
    pairs = [F.lit(x) for pair in zip(keys, values) for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def _cell(
    rows: Sequence[str], columns: Sequence[str], matrix: Sequence[Sequence[object]], row: Column, column: Column
) -> Column:
    """A matrix cell by two labels; null if either label is unknown. A literal map of 25 entries."""
    keys = [f"{r}|{c}" for r in rows for c in columns]
    return _lookup(keys, [v for line in matrix for v in line], F.concat_ws("|", row, column))


def level_of(probability: Column, severity: Column) -> Column:
    return _cell(PROBABILITY_LEVELS, SEVERITY_LEVELS, LEVEL_MATRIX, probability, severity)


def default_matrix(spark: SparkSession) -> DataFrame:
    """The fixed matrix as a table ``(probability, severity, level)``."""
    cells = [(p, s, LEVEL_MATRIX[i][j]) for i, p in enumerate(PROBABILITY_LEVELS) for j, s in enumerate(SEVERITY_LEVELS)]
    return spark.createDataFrame(cells, "probability string, severity string, level string")


def risk_level(risks: DataFrame, matrix: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Add ``level`` and ``residual_level``; a missing residual value is the initial one.

    ``matrix`` is ``(*by, probability, severity, level)``, such as one per project, one row per cell; without it the fixed one
    holds. Unknown labels give a null level.
    """
    probability, severity = F.col("probability"), F.col("severity")
    if matrix is not None:
        out = risks.withColumns(
            {
                "residual_p": F.coalesce("residual_probability", probability),
                "residual_s": F.coalesce("residual_severity", severity),
            }
        )
        cells = matrix.select(*by, "probability", "severity", "level")
        residual = matrix.select(
            *by, F.col("probability").alias("residual_p"), F.col("severity").alias("residual_s"), F.col("level").alias("residual_level")
        )
        first = out.join(cells, [*by, "probability", "severity"], "left")
        both = first.join(residual, [*by, "residual_p", "residual_s"], "left")
        return both.select(*risks.columns, "level", "residual_level")
    return risks.withColumn("level", level_of(probability, severity)).withColumn(
        "residual_level",
        level_of(
            F.coalesce("residual_probability", probability), F.coalesce("residual_severity", severity)
        ),
    )


def score_of(likelihood: Column, severity: Column) -> Column:
    return _cell(LIKELIHOODS, CLINICAL_SEVERITIES, SCORE_MATRIX, likelihood, severity)


def risk_band(score: Column) -> Column:
    """1 and 2 acceptable, 3 undesirable, 4 and 5 unacceptable."""
    return F.when(score <= 2, ACCEPTABLE).when(score == 3, UNDESIRABLE).when(score >= 4, UNACCEPTABLE)


def risk_score(hazards: DataFrame) -> DataFrame:
    """Add the clinical ``score`` (1 to 5) and its ``band``."""
    return hazards.withColumn("score", score_of(F.col("likelihood"), F.col("severity"))).withColumn(
        "band", risk_band(F.col("score"))
    )


def severity_class(df: DataFrame, injury: str = "injury", multiple: str = "multiple") -> DataFrame:
    """Add the clinical ``severity`` from the kind of injury and whether several patients are hit."""
    single = _lookup(list(SEVERITY_BY_INJURY), [v[0] for v in SEVERITY_BY_INJURY.values()], F.col(injury))
    several = _lookup(list(SEVERITY_BY_INJURY), [v[1] for v in SEVERITY_BY_INJURY.values()], F.col(injury))
    return df.withColumn("severity", F.when(F.col(multiple), several).otherwise(single))


def residual_risk_open(
    risks: DataFrame,
    acceptable: Sequence[str] = ("Low",),
    matrix: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Risks still above the acceptable level, or above it at first with no control measure.

    An unknown level counts as above. ``reason`` tells which.
    """
    leveled = risk_level(risks, matrix, by)

    def above(level: str) -> Column:
        return ~F.coalesce(F.col(level).isin(*acceptable), F.lit(False))

    reason = F.when(above("residual_level"), "residual level too high").when(
        above("level") & F.col("control_measures").isNull(), "no control measure"
    )
    return leveled.withColumn("reason", reason).where(F.col("reason").isNotNull())


def risk_trace(
    risks: DataFrame, controls: DataFrame, reqs: DataFrame, tests: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Software item, events, hazard, control, requirement and tests of each risk, and where the
    chain breaks.

    ``controls`` is ``(risk_id, req_id)``. Tests are counted per requirement first, so the trace has
    one row per risk and control however many tests a requirement has.
    """
    covered = requirement_coverage(reqs, tests, by).select(
        *by, F.col("id").alias("req_id"), "n_tests", "n_pass", F.lit(True).alias("known")
    )
    heads = risks.select(*by, F.col("id").alias("risk_id"), "software_item", "events", "hazard")
    controlled = keep_left(heads, controls.select(*by, "risk_id", "req_id"), [*by, "risk_id"])
    traced = controlled.join(covered, [*by, "req_id"], "left")
    broken = (
        F.when(F.col("req_id").isNull(), "no control")
        .when(F.col("known").isNull(), "unknown requirement")
        .when(F.col("n_tests") == 0, "not tested")
        .when(F.col("n_pass") < F.col("n_tests"), "test fails")
        .otherwise("complete")
    )
    return traced.select(
        *by, "risk_id", "software_item", "events", "hazard", "req_id", "n_tests", "n_pass", broken.alias("trace")
    )
