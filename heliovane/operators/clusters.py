"""Tables about clusters: sizes, country breakdown, summaries, profiles, sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliovane.schema import MEAN_COLUMNS, SCORE_COLUMNS, present


def labelled_indicators(indicators: DataFrame, labels: DataFrame) -> DataFrame:
    """Indicators with their cluster id, joined by point and never by position."""
    return indicators.join(labels.select("point_id", "cluster_id"), "point_id", "left")


def cluster_sizes(labelled: DataFrame, clusters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Points per cluster; a cluster without points is listed with 0."""
    keys = [*by, "cluster_id"]
    counts = labelled.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return (
        clusters.select(*keys)
        .join(counts, keys, "left")
        .withColumn("size", F.coalesce("size", F.lit(0).cast("bigint")))
    )


def country_breakdown(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, share and mean scores per cluster and country, largest count first.

    ``country_rank`` gives the order (ties by country name).  Rows without country
    count in the cluster's total and are not listed.
    """
    if "country" not in labelled.columns:
        raise ValueError("the labelled table has no country column")
    cluster = [*by, "cluster_id"]
    scores = present(labelled, SCORE_COLUMNS)
    grouped = labelled.groupBy(*cluster, "country").agg(
        F.count(F.lit(1)).alias("count"), *[F.avg(c).alias(f"avg_{c}") for c in scores]
    )
    # From here on one row per cluster and country.
    total = F.sum("count").over(Window.partitionBy(*cluster))
    order = Window.partitionBy(*cluster).orderBy(F.desc("count"), "country")
    return (
        grouped.withColumn("percentage", F.col("count") / total)
        .where("country IS NOT NULL")
        .withColumn("country_rank", F.row_number().over(order))
        .select(*cluster, "country", "count", "percentage", *[f"avg_{c}" for c in scores], "country_rank")
    )


def cluster_summary(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster_id").agg(
        F.count("point_id").alias("points"),
        F.avg("solar_score").alias("solar_mean"),
        F.avg("wind_score").alias("wind_mean"),
        F.avg("hybrid_score").alias("hybrid_mean"),
    )


def score_series(labelled: DataFrame) -> DataFrame:
    """The two plotted series: mean solar and wind score per cluster."""
    return cluster_summary(labelled).select("cluster_id", "solar_mean", "wind_mean")


def cluster_profiles(
    labelled: DataFrame,
    centroids: DataFrame,
    by: Sequence[str] = (),
    features: Sequence[str] = MEAN_COLUMNS,
) -> DataFrame:
    """One row per centroid: size, default texts, centroid struct, country breakdown."""
    keys = [*by, "cluster_id"]
    names = present(centroids, features)
    sized = cluster_sizes(labelled, centroids, by)
    shaped = centroids.select(*keys, F.struct(*names).alias("centroid"))
    profiles = shaped.join(sized, keys)
    if "country" in labelled.columns:
        entries = country_breakdown(labelled, by)
        fields = [c for c in entries.columns if c not in (*keys, "country_rank")]
        ordered = F.sort_array(F.collect_list(F.struct("country_rank", F.struct(*fields).alias("entry"))))
        listed = entries.groupBy(*keys).agg(ordered.alias("_listed"))
        entry_type = listed.schema["_listed"].dataType.elementType["entry"].dataType.simpleString()
        profiles = profiles.join(listed, keys, "left").withColumn(
            "country_breakdown", F.coalesce(F.col("_listed.entry"), F.array().cast(f"array<{entry_type}>"))
        )
    else:
        no_entries = F.array().cast("array<struct<country:string,count:bigint,percentage:double>>")
        profiles = profiles.withColumn("country_breakdown", no_entries)
    name = F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string"))
    return profiles.select(
        *keys,
        name.alias("label"),
        F.concat(name, F.lit(" with "), F.col("size").cast("string"), F.lit(" points")).alias("description"),
        "size",
        "centroid",
        F.lit(0.0).alias("confidence"),
        F.lit(0.5).alias("solar_percentile"),
        F.lit(0.5).alias("wind_percentile"),
        "country_breakdown",
    )
