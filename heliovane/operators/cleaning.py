"""Range nulling, duplicate removal, empty-row removal and row flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.schema import (
    CLEANING_RANGES,
    FILL_VALUE,
    MAIN_VARIABLES,
    PLAUSIBLE_RANGES,
    VARIABLES,
    present,
)

Ranges = Mapping[str, tuple[float, float]]


def nan_to_null(column: Column) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def fill_to_null(df: DataFrame, columns: Sequence[str] = VARIABLES, fill: float = FILL_VALUE) -> DataFrame:
    """Turn the fill value and NaN into NULL, the only missing marker used afterwards."""
    return df.withColumns(
        {c: F.nullif(nan_to_null(F.col(c).cast("double")), F.lit(fill)) for c in present(df, columns)}
    )


def null_out_of_range(df: DataFrame, ranges: Ranges = CLEANING_RANGES) -> DataFrame:
    """NULL for values outside their closed range; rows and other columns stay."""
    return df.withColumns(
        {c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in ranges.items() if c in df.columns}
    )


def drop_all_null(df: DataFrame, columns: Sequence[str] = VARIABLES) -> DataFrame:
    """Drop rows in which every variable column present is NULL."""
    names = present(df, columns)
    return df.dropna(how="all", subset=names) if names else df


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row per distinct full row, NULL equal to NULL.

    The shuffle key is the whole row, so one point holding a large share of the
    rows still spreads over all tasks, and copies collapse before the shuffle.
    """
    return df.dropDuplicates()


def standard_values(df: DataFrame, ranges: Ranges = CLEANING_RANGES) -> DataFrame:
    """Ranged variables nulled outside their range, the other ones NaN to NULL."""
    numeric = {name for name, kind in df.dtypes if kind in ("double", "float")}
    plain = [c for c in present(df, VARIABLES) if c in numeric and c not in ranges]
    if plain:
        df = df.withColumns({c: nan_to_null(F.col(c)) for c in plain})
    return null_out_of_range(df, ranges)


def clean(df: DataFrame, ranges: Ranges = CLEANING_RANGES, sort: bool = False) -> DataFrame:
    """Null implausible values, drop repeated rows, drop empty rows, optionally sort."""
    cleaned = drop_all_null(drop_duplicate_rows(standard_values(df, ranges)))
    return order_by_date(cleaned) if sort else cleaned


def in_years(df: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Rows dated from 1 January of the first to 31 December of the last year.

    A plain range on the date, so it reaches the file scan.
    """
    if start_year > end_year:
        raise ValueError("start_year must not be greater than end_year")
    first, last = F.make_date(F.lit(start_year), F.lit(1), F.lit(1)), F.make_date(F.lit(end_year), F.lit(12), F.lit(31))
    return df.where(F.col("date").between(first, last))


def order_by_date(df: DataFrame) -> DataFrame:
    """Global order by point and date; the other columns break ties.

    With the whole row as the key, range partitioning can also split the rows of
    one point or one day.
    """
    if "date" not in df.columns:
        return df
    lead = present(df, ("point_id", "date"))
    return df.orderBy(*lead, *[c for c in df.columns if c not in lead])


def complete_flag(df: DataFrame, columns: Sequence[str] = MAIN_VARIABLES, out: str = "is_complete") -> DataFrame:
    """True where every listed variable is there."""
    return df.withColumn(out, reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def range_flag(df: DataFrame, ranges: Ranges = PLAUSIBLE_RANGES) -> DataFrame:
    """Flag instead of nulling: ``<variable>_ok`` (NULL if no value) and ``plausible``."""
    used = {c: r for c, r in ranges.items() if c in df.columns}
    flags = {f"{c}_ok": F.col(c).between(lo, hi) for c, (lo, hi) in used.items()}
    whole = reduce(lambda a, b: a & b, [F.coalesce(f, F.lit(True)) for f in flags.values()], F.lit(True))
    return df.withColumns({**flags, "plausible": whole})
