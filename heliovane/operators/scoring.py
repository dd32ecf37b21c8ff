"""Cross-point min-max scores and the hybrid score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.operators.cleaning import nan_to_null
from heliovane.schema import MEAN_COLUMNS, WEIGHT_HYBRID, WEIGHT_SOLAR, WEIGHT_WIND, present

SOURCE_OF_SCORE = {"solar_score": "sw_dwn_mean", "wind_score": "ws_100m_mean"}


def hybrid(
    solar: Column,
    wind: Column,
    weight_solar: float = WEIGHT_SOLAR,
    weight_wind: float = WEIGHT_WIND,
    weight_hybrid: float = WEIGHT_HYBRID,
) -> Column:
    return weight_solar * solar + weight_wind * wind + weight_hybrid * (solar * wind)


def minmax_scores(df: DataFrame, by: str | None = None) -> DataFrame:
    """Place each point's mean between the smallest and the largest of all points.

    A range of zero, or no values at all, scores every row 0.5.  The bounds come
    from one aggregate used as a scalar subquery, so nothing is sorted or gathered;
    it asks for all means so that its shuffle is the one the rows use too.  With
    ``by`` the bounds are taken within each group instead.
    """
    sources = {s: c for s, c in SOURCE_OF_SCORE.items() if c in df.columns}
    if not sources:
        return df
    asked = present(df, MEAN_COLUMNS)
    df = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in asked})
    extremes = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in asked]
    if by is None:
        bounded = df.withColumn("_b", df.agg(F.struct(*extremes)).scalar())
    else:
        bounded = df.join(df.groupBy(by).agg(F.struct(*extremes).alias("_b")), by, "left")

    def score(name: str) -> Column:
        lo, hi = F.col(f"_b.{name}.lo"), F.col(f"_b.{name}.hi")
        return F.when(hi > lo, (F.col(name) - lo) / (hi - lo)).otherwise(F.lit(0.5))

    return bounded.withColumns({s: score(c) for s, c in sources.items()}).drop("_b")


def hybrid_score(
    df: DataFrame,
    weight_solar: float = WEIGHT_SOLAR,
    weight_wind: float = WEIGHT_WIND,
    weight_hybrid: float = WEIGHT_HYBRID,
) -> DataFrame:
    """Add the hybrid score where both single scores are there."""
    if not {"solar_score", "wind_score"} <= set(df.columns):
        return df
    value = hybrid(F.col("solar_score"), F.col("wind_score"), weight_solar, weight_wind, weight_hybrid)
    return df.withColumn("hybrid_score", value)


def score(df: DataFrame, *weights: float, by: str | None = None) -> DataFrame:
    """Min-max scores, then the hybrid score."""
    return hybrid_score(minmax_scores(df, by), *weights)
