"""Completeness reports and result validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.operators.cleaning import nan_to_null
from heliovane.schema import IDENTITY_COLUMNS, MAIN_VARIABLES, present


def completeness(
    df: DataFrame,
    columns: Sequence[str] | str = MAIN_VARIABLES,
    threshold: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows, rows with no NULL or NaN in the listed columns, their ratio and a verdict.

    ``columns='all'`` asks for every column of the frame.  A listed column that the
    frame lacks is missing in every row.  No rows give ratio 0.
    """
    asked = df.columns if columns == "all" else list(columns)
    kinds = dict(df.dtypes)

    def known(c: str) -> Column:
        if c not in kinds:
            return F.lit(False)
        value = nan_to_null(F.col(c)) if kinds[c] in ("double", "float") else F.col(c)
        return value.isNotNull()

    full = reduce(lambda a, b: a & b, [known(c) for c in asked], F.lit(True))
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(full).alias("complete_rows")
    )
    ratio = F.coalesce(F.try_divide("complete_rows", "total_rows"), F.lit(0.0))
    return counted.withColumn("completeness_ratio", ratio).withColumn(
        "is_valid", F.col("completeness_ratio") >= threshold
    )


def result_validation(labelled: DataFrame, expected_rows: int, label: str = "cluster_id") -> DataFrame:
    """One row: row and label counts, NULLs per identity column, and the verdict."""
    identity = present(labelled, IDENTITY_COLUMNS)
    counted = labelled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(label).alias("n_labels"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in identity],
    )
    whole = (F.col("n_rows") == expected_rows) & (F.col("n_labels") == expected_rows)
    known = reduce(lambda a, b: a & b, [F.col(f"null_{c}") == 0 for c in identity], F.lit(True))
    return counted.withColumn("is_complete", whole).withColumn("is_valid", whole & known)


def require_valid_result(labelled: DataFrame, expected_rows: int, label: str = "cluster_id") -> None:
    verdict = result_validation(labelled, expected_rows, label).first()
    if not verdict["is_complete"]:
        raise RuntimeError(f"incomplete result: {verdict['n_rows']} rows, {expected_rows} expected")
    if not verdict["is_valid"]:
        raise RuntimeError("result has missing identity values")
