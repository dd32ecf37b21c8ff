"""Per-point means, position scores and the indicator table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.operators.cleaning import drop_duplicate_rows, nan_to_null, standard_values
from heliovane.operators.scoring import hybrid, score
from heliovane.schema import (
    IDENTITY_COLUMNS,
    MAIN_VARIABLES,
    MEAN_COLUMNS,
    SCORE_COLUMNS,
    present,
)


def _value(variable: str) -> Column:
    return nan_to_null(F.col(variable).cast("double"))


def _mean(df: DataFrame, variable: str) -> Column:
    return F.avg(_value(variable)) if variable in df.columns else F.lit(0.0)


def point_means(observations: DataFrame, variables: Sequence[str] = MAIN_VARIABLES) -> DataFrame:
    """Mean of each variable per point; an absent column gives 0.0, no values NULL."""
    return observations.groupBy("point_id").agg(*[_mean(observations, v).alias(f"{v}_mean") for v in variables])


def point_position_scores(observations: DataFrame) -> DataFrame:
    """Where each point's mean lies between its own lowest and highest day.

    No values (or no column) gives 0.0, a constant series 0.5.
    """

    def position(variable: str) -> Column:
        if variable not in observations.columns:
            return F.lit(0.0)
        value = _value(variable)
        mean, lo, hi = F.avg(value), F.min(value), F.max(value)
        return F.when(lo.isNull(), 0.0).when(hi <= lo, 0.5).otherwise((mean - lo) / (hi - lo))

    placed = observations.groupBy("point_id").agg(
        *[_mean(observations, v).alias(f"{v}_mean") for v in MAIN_VARIABLES],
        position("sw_dwn").alias("solar_position"),
        position("ws_100m").alias("wind_position"),
    )
    return placed.withColumn("hybrid_position", hybrid(F.col("solar_position"), F.col("wind_position")))


def indicator_means(points: DataFrame, observations: DataFrame, on_missing: str = "zero") -> DataFrame:
    """Every point with its four means over cleaned observations.

    ``on_missing`` says what a point without any observation gets: ``zero`` means,
    ``null`` means, or ``drop`` for no row.  Rows with no value left after nulling
    do not move a mean, so they are not filtered here: a point that only has such
    rows is told apart from one that has none, and gets NULL means.
    """
    if on_missing not in ("zero", "null", "drop"):
        raise ValueError(f"on_missing must be zero, null or drop, got {on_missing!r}")
    cleaned = drop_duplicate_rows(standard_values(observations))
    means = point_means(cleaned).withColumn("_seen", F.lit(True))
    joined = points.join(means, "point_id", "inner" if on_missing == "drop" else "left")
    absent = F.lit(0.0) if on_missing == "zero" else F.lit(None).cast("double")
    return joined.select(
        *present(joined, IDENTITY_COLUMNS),
        *[F.when(F.col("_seen"), F.col(m)).otherwise(absent).alias(m) for m in MEAN_COLUMNS],
    )


def indicators(points: DataFrame, observations: DataFrame, *weights: float, on_missing: str = "zero") -> DataFrame:
    """Clean, average per point, score across points: the 11-column indicator table.

    Two shuffles of the observations' side: full rows for duplicate removal, then
    per-point partial averages.  Points are joined after the aggregation.
    """
    scored = score(indicator_means(points, observations, on_missing), *weights)
    return scored.select(*present(scored, IDENTITY_COLUMNS), *MEAN_COLUMNS, *SCORE_COLUMNS)
