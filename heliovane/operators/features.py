"""Feature columns: selection, median imputation, standardisation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.functions.medians import exact_medians
from heliovane.operators.cleaning import nan_to_null
from heliovane.schema import MEAN_COLUMNS, present

# A spread this small beside the mean is rounding error, however many rows there are.
_ROUNDING = 1e-12


def feature_columns(df: DataFrame, wanted: Sequence[str] = MEAN_COLUMNS) -> list[str]:
    names = present(df, wanted)
    if not names:
        raise ValueError(f"none of the feature columns {list(wanted)} is in the table")
    return names


def feature_table(df: DataFrame, wanted: Sequence[str] = MEAN_COLUMNS, id_col: str = "point_id") -> DataFrame:
    return df.select(id_col, *feature_columns(df, wanted))


@dataclass(frozen=True)
class Scaling:
    """Per-feature median, mean and population deviation, fitted on a table of ``rows`` rows."""

    rows: int
    features: tuple[str, ...]
    medians: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def imputed(self, feature: str) -> Column:
        median = self.medians[self.features.index(feature)]
        return F.coalesce(nan_to_null(F.col(feature).cast("double")), F.lit(median))

    def impute(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f: self.imputed(f) for f in self.features})

    def standardize(self, df: DataFrame) -> DataFrame:
        """Imputed features at mean 0 and population deviation 1; constant ones at 0."""
        fitted = zip(self.features, self.means, self.deviations)
        return df.withColumns({f: (self.imputed(f) - F.lit(m)) / F.lit(s) for f, m, s in fitted})

    def original(self, center: Sequence[float]) -> list[float]:
        return [float(c) * s + m for c, m, s in zip(center, self.means, self.deviations)]

    def original_columns(self, df: DataFrame) -> DataFrame:
        """Scaled feature columns back in their own units."""
        fitted = zip(self.features, self.means, self.deviations)
        return df.withColumns({f: F.col(f) * F.lit(s) + F.lit(m) for f, m, s in fitted})


def fit_scaling(df: DataFrame, features: Sequence[str]) -> Scaling:
    """Medians for the gaps (0.0 for an empty feature), then mean and deviation.

    One pass over the table; features with gaps add the passes of their median, and
    the moments with the gaps filled follow from those without.
    """
    plain = df.select(*[nan_to_null(F.col(f).cast("double")).alias(f) for f in features])
    measures = {"n": F.count, "lo": F.min, "hi": F.max, "mean": F.avg, "var": F.var_pop}
    row = plain.agg(
        F.count(F.lit(1)).alias("rows"),
        *[measure(f).alias(f"{name}_{f}") for f in features for name, measure in measures.items()],
    ).first()
    n = row["rows"]
    if not n:
        raise ValueError("no rows to fit the scaling on")
    ranges = {f: (row[f"n_{f}"], row[f"lo_{f}"], row[f"hi_{f}"]) for f in features}
    holey = [f for f in features if 0 < row[f"n_{f}"] < n]
    found = exact_medians(plain, holey, ranges) if holey else {}
    medians, means, variances = [], [], []
    for f in features:
        known, median = row[f"n_{f}"], found.get(f, 0.0)
        mean, variance = (row[f"mean_{f}"], row[f"var_{f}"]) if known else (0.0, 0.0)
        filled = (known * mean + (n - known) * median) / n if known < n else mean
        if known < n:
            variance = (known * (variance + (mean - filled) ** 2) + (n - known) * (median - filled) ** 2) / n
        medians.append(float(median))
        means.append(float(filled))
        variances.append(float(variance))
    # A variance within rounding error of zero counts as constant: left unscaled.
    deviations = [
        1.0 if v <= (_ROUNDING * abs(m)) ** 2 else v**0.5 for m, v in zip(means, variances)
    ]
    return Scaling(n, tuple(features), tuple(medians), tuple(means), tuple(deviations))


def impute_median(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """NULL and NaN features replaced by the feature's exact median."""
    names = list(features or feature_columns(df))
    medians = exact_medians(df.select(*[nan_to_null(F.col(f).cast("double")).alias(f) for f in names]), names)
    return df.withColumns(
        {f: F.coalesce(nan_to_null(F.col(f).cast("double")), F.lit(float(medians[f] or 0.0))) for f in names}
    )


def standardize(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    names = list(features or feature_columns(df))
    return fit_scaling(df, names).standardize(df)
