"""Reading clusters relative to each other: indices, percentiles, labels, text.

Windows here run over cluster tables (one row per cluster); ``by`` keeps several
clusterings (runs, regions) apart in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.operators.cleaning import nan_to_null
from heliovane.schema import MEAN_COLUMNS, SOLAR_MEANS, WIND_MEANS, present

MEDIAN = 0.5
_NO_SPREAD = 1e-9


def _group(by: Sequence[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def cluster_zscores(
    clusters: DataFrame, variables: Sequence[str] = MEAN_COLUMNS, by: Sequence[str] = ()
) -> DataFrame:
    """``<variable>_z`` over the clusters of a group, population deviation.

    No spread, or no value for a cluster, gives 0; a variable without any value in
    the group gives NULL and is left out later.
    """
    group = _group(by)

    def z(variable: str) -> Column:
        value = nan_to_null(F.col(variable).cast("double"))
        mean, deviation = F.avg(value).over(group), F.stddev_pop(value).over(group)
        return (
            F.when(F.count(value).over(group) == 0, F.lit(None).cast("double"))
            .when((deviation > _NO_SPREAD) & value.isNotNull(), (value - mean) / deviation)
            .otherwise(F.lit(0.0))
        )

    return clusters.withColumns({f"{v}_z": z(v) for v in present(clusters, variables)})


def composite_index(clusters: DataFrame, variables: Sequence[str], out: str) -> DataFrame:
    """Mean of the z-scores that are there; 0 if none is."""
    scores = [F.col(c) for c in present(clusters, [f"{v}_z" for v in variables])]
    if not scores:
        return clusters.withColumn(out, F.lit(0.0))
    total = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0.0)) for s in scores])
    known = reduce(lambda a, b: a + b, [F.when(s.isNotNull(), 1).otherwise(0) for s in scores])
    return clusters.withColumn(out, F.coalesce(F.try_divide(total, known), F.lit(0.0)))


def percentile_rank(clusters: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Position 0..1 among the clusters; ties get different ranks, by cluster id."""
    group = _group(by)
    n = F.count(F.lit(1)).over(group)
    place = F.row_number().over(group.orderBy(value, "cluster_id")) - 1
    return clusters.withColumn(out, F.when(n <= 1, F.lit(MEDIAN)).otherwise(F.try_divide(place, n - 1)))


def quadrant_label(solar: Column, wind: Column) -> Column:
    # The four labels.
    return (
        F.when((solar >= MEDIAN) & (wind >= MEDIAN), "Hybrid-high")
        .when(solar >= MEDIAN, "Solar-dominant")
        .when(wind >= MEDIAN, "Wind-dominant")
        .otherwise("Lower-resource")
    )


def label_confidence(solar: Column, wind: Column) -> Column:
    """How far from the median both percentiles are, 0..1."""
    return F.least(F.lit(1.0), (F.abs(solar - MEDIAN) * 2 + F.abs(wind - MEDIAN) * 2) / 2)


def dominant_country(breakdown: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The country with most points per cluster and its share; ties by name."""
    return breakdown.where("country_rank = 1").select(
        *by, "cluster_id", F.col("country").alias("dominant_country"), F.col("percentage").alias("dominant_share")
    )


def percent_text(share: Column) -> Column:
    """Whole percent, halves to the even number."""
    return F.format_string("%d%%", F.bround(share * 100, 0).cast("bigint"))


def cluster_description(
    label: Column, size: Column, solar: Column, wind: Column, country: Column, share: Column
) -> Column:
    # Wording of the description.
    lead = (
        F.when(label == "Hybrid-high", "Potencial hibrido: solar y eolico ambos por encima de la mediana")
        .when(label == "Solar-dominant", "Potencial predominantemente solar")
        .when(label == "Wind-dominant", "Potencial predominantemente eolico")
        .otherwise("Potencial bajo relativo a los demas clusters")
    )
    body = F.concat(
        lead, F.lit(" ("), size.cast("string"), F.lit(" puntos). Percentil solar: "), percent_text(solar),
        F.lit(", percentil eolico: "), percent_text(wind),
        F.lit(" respecto a los demas clusters de esta corrida."),
    )
    place = F.concat(
        F.lit(" Pais dominante: "), country, F.lit(" ("), percent_text(share), F.lit(" de los puntos de este cluster).")
    )
    return F.concat(body, F.coalesce(place, F.lit("")))


def interpret(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles with label, description, percentiles and confidence filled in.

    Reads the ``centroid`` struct and the first entry of ``country_breakdown``.
    """
    fields = profiles.schema["centroid"].dataType.names
    wide = profiles.withColumns({f"_{f}": F.col(f"centroid.{f}") for f in fields})
    solar, wind = [[f"_{v}" for v in names if v in fields] for names in (SOLAR_MEANS, WIND_MEANS)]
    scored = cluster_zscores(wide, [*solar, *wind], by)
    scored = composite_index(composite_index(scored, solar, "_solar"), wind, "_wind")
    ranked = percentile_rank(scored, "_solar", "solar_percentile", by)
    ranked = percentile_rank(ranked, "_wind", "wind_percentile", by)
    sun, air = F.col("solar_percentile"), F.col("wind_percentile")
    top = F.try_element_at("country_breakdown", F.lit(1))
    labelled = ranked.withColumns({"label": quadrant_label(sun, air), "confidence": label_confidence(sun, air)})
    told = labelled.withColumn(
        "description",
        cluster_description(F.col("label"), F.col("size"), sun, air, top["country"], top["percentage"]),
    )
    return told.select(*profiles.columns)
