"""Point tables: validity, attaching points to observations, input checksum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.schema import IDENTITY_COLUMNS, MAIN_VARIABLES, present


def point_is_valid() -> Column:
    """Latitude and longitude in range, country of two characters or more."""
    checks = (
        F.col("latitude").between(-90.0, 90.0)
        & F.col("longitude").between(-180.0, 180.0)
        & (F.length("country") >= 2)
    )
    return F.coalesce(checks, F.lit(False))


def split_points(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) points."""
    return points.where(point_is_valid()), points.where(~point_is_valid())


def require_valid_points(points: DataFrame) -> DataFrame:
    """The same points; the job that reads them fails on the first invalid one."""
    message = F.concat_ws(
        " ", F.lit("invalid point:"), *[F.col(c).cast("string") for c in present(points, IDENTITY_COLUMNS)]
    )
    return points.where(F.when(point_is_valid(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def raw_observations(observations: DataFrame, points: DataFrame) -> DataFrame:
    """Observation rows with the point attributes repeated on them.

    No hint: Spark broadcasts the points when their measured size is under its
    threshold; a larger point table is sort-merged, and adaptive execution cuts the
    partition of a point that holds many rows into pieces.
    """
    columns = [c for c in IDENTITY_COLUMNS] + ["date"] + present(observations, MAIN_VARIABLES)
    return observations.join(points, "point_id").select(*columns)


def observation_counts(points: DataFrame, observations: DataFrame) -> DataFrame:
    """Every point with its number of observations; points without any keep a 0 row."""
    counts = observations.groupBy("point_id").agg(F.count(F.lit(1)).alias("n_observations"))
    return points.join(counts, "point_id", "left").withColumn(
        "n_observations", F.coalesce("n_observations", F.lit(0).cast("bigint"))
    )


def points_without_data(points: DataFrame, observations: DataFrame) -> DataFrame:
    return observation_counts(points, observations).where("n_observations = 0").drop("n_observations")


def points_checksum(points: DataFrame, chunk: int = 65536) -> DataFrame:
    """One row ``(n_points, checksum)`` fingerprinting the points in point order.

    Points are hashed in runs of ``chunk`` consecutive ids: sha-256 over the
    ``lat,lon,country`` lines (8 decimals); the checksum is the sha-256 of the run
    digests in order, also when there is one run or none, so no task ever holds more
    than ``chunk`` lines.  ``point_id`` must be a unique position, from any start.
    """
    line = F.format_string("%.8f,%.8f,%s", "latitude", "longitude", "country")
    digests = (
        points.select(F.expr(f"point_id DIV {int(chunk)}").alias("run"), "point_id", line.alias("line"))
        .groupBy("run")
        .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("point_id", "line"))).alias("rows"))
        .select("run", "n", F.sha2(F.array_join("rows.line", "\n"), 256).alias("digest"))
    )
    return digests.agg(
        F.sum("n").alias("n_points"),
        F.sort_array(F.collect_list(F.struct("run", "digest"))).alias("runs"),
    ).select(
        "n_points",
        F.sha2(F.array_join("runs.digest", "").cast("binary"), 256).alias("checksum"),
    )
