"""Grids of points: per-country lattices, even samples, first points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Latitude and longitude bounds per country, in grid order.
COUNTRY_BOUNDS = (
    ("Guatemala", 13.7, 17.8, -92.2, -88.2),
    ("El Salvador", 12.9, 14.5, -90.1, -87.7),
    ("Honduras", 12.9, 17.0, -89.4, -83.0),
    ("Nicaragua", 10.7, 15.5, -87.6, -83.0),
    ("Costa Rica", 8.0, 11.3, -85.9, -82.6),
    ("Panama", 7.2, 10.8, -82.9, -77.0),
    ("Belize", 15.5, 18.5, -89.2, -87.5),
)
BOUNDS_SCHEMA = "country_ix INT, country STRING, lat_lo DOUBLE, lat_hi DOUBLE, lon_lo DOUBLE, lon_hi DOUBLE"


def default_bounds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *row) for i, row in enumerate(COUNTRY_BOUNDS)], BOUNDS_SCHEMA)


def bounds_of_points(points: DataFrame) -> DataFrame:
    """Bounding box per country of a point table, countries in name order."""
    boxes = points.groupBy("country").agg(
        F.min("latitude").alias("lat_lo"),
        F.max("latitude").alias("lat_hi"),
        F.min("longitude").alias("lon_lo"),
        F.max("longitude").alias("lon_hi"),
    )
    # One row per country, so one task can number them.
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("country")) - 1
    return boxes.select(position.alias("country_ix"), "*")


def steps_for_size(size: int) -> int:
    """Steps per axis for a grid size (fixed rule: seven sizes make one more step)."""
    return size // 7 + 1


def grid_points(bounds: DataFrame, size: int = 80) -> DataFrame:
    """Evenly spaced lattice in every country box, latitude before longitude.

    ``point_id`` is the 0-based position: country, then latitude, then longitude.
    The positions are a distributed range and everything else is arithmetic on it,
    so the grid is built in parallel whatever the number of countries.
    """
    n = steps_for_size(size)
    countries = bounds.count()
    spark = bounds.sparkSession
    cells = spark.range(countries * n * n).select(
        F.col("id").alias("point_id"),
        F.expr(f"CAST(id DIV {n * n} AS INT)").alias("country_ix"),
        F.expr(f"id DIV {n} % {n}").alias("lat_ix"),
        F.expr(f"id % {n}").alias("lon_ix"),
    )

    def along(axis: str):
        lo, hi, step = F.col(f"{axis}_lo"), F.col(f"{axis}_hi"), F.col(f"{axis}_ix")
        if n == 1:
            return lo
        return F.when(step == n - 1, hi).otherwise(step * ((hi - lo) / (n - 1)) + lo)

    return cells.join(bounds, "country_ix").select(
        "point_id", along("lat").alias("latitude"), along("lon").alias("longitude"), "country"
    )


def grid_sample(points: DataFrame, n: int, total: int | None = None) -> DataFrame:
    """``n`` evenly spaced points by position, renumbered; all of them if there are no more."""
    total = points.count() if total is None else total
    if total <= n:
        return points
    if n < 1:
        return points.limit(0)
    stride = (total - 1) / (n - 1) if n > 1 else 0.0
    chosen = points.sparkSession.range(n).select(
        F.col("id").alias("_new"),
        (
            F.when(F.col("id") == n - 1, F.lit(total - 1 if n > 1 else 0))
            .otherwise(F.floor(F.col("id") * F.lit(stride)))
            .cast("bigint")
            .alias("point_id")
        ),
    )
    kept = points.join(chosen, "point_id")
    return kept.select(F.col("_new").alias("point_id"), *[c for c in points.columns if c != "point_id"])


def first_points(points: DataFrame, m: int) -> DataFrame:
    """The first m points in grid order."""
    return points.where(F.col("point_id") < m)


def generate_points(
    spark: SparkSession,
    size: int = 80,
    sample_size: int | None = 80,
    max_points: int | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Grid, even sample of it (unless ``sample_size`` is None), then the first points."""
    points = grid_points(default_bounds(spark) if bounds is None else bounds, size)
    if sample_size is not None:
        points = grid_sample(points, sample_size)
    return points if max_points is None else first_points(points, max_points)
