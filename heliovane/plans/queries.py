"""One query per operator, over the library's tables derived from a data folder."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliovane.functions.series import combine_per_point, fold_per_point, merge_per_point
from heliovane.operators import checks, cleaning, clusters, features, interpret, kmeans, quality, runs, silhouette, sweep
from heliovane.operators import indicators as ind
from heliovane.operators import points as pts
from heliovane.operators.models import load_model, save_model
from heliovane.operators import scoring
from heliovane.plans import derived, flows
from heliovane.schema import MAIN_VARIABLES, MEAN_COLUMNS, SOLAR_MEANS, WIND_MEANS
from heliovane.session import scratch_path, settle
from heliovane.sources import grid, payloads, tables
from heliovane.sources.layout import save_by_day

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LABELLINGS = ("l2", "l3", "l4", "l5", "l6")
SWEPT = (2, 3, 5)


def query(fn: Query) -> Query:
    # A trailing underscore keeps a query apart from the module of that name.
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, so that the order of summation does not show.

    Means of decimals often end in an exact half of the sixth decimal, where the last
    bit of the sum would decide; the shift, far above that noise and far below the
    sixth decimal, moves such halves off the edge.  The SQL rounds the same way.
    """
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c) + 3.3e-9, 6) for c in doubles}) if doubles else df


def store(spark: SparkSession) -> tables.TableStore:
    return tables.TableStore(spark, scratch_path(spark, "store"))


# Shared inputs ---------------------------------------------------------------


def indicator_table(spark: SparkSession, sf: str) -> DataFrame:
    return ind.indicators(derived.points(spark, sf), derived.observations(spark, sf))


def fixed_label(modulus: int = 4) -> Column:
    return (F.col("point_id") % modulus).alias("cluster_id")


def fixed_labels(spark: SparkSession, sf: str) -> DataFrame:
    return derived.points(spark, sf).select("point_id", fixed_label())


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The written indicator table with the fixed labels, as after clustering."""
    return clusters.labelled_indicators(indicator_table(spark, sf), fixed_labels(spark, sf))


def gappy_features(spark: SparkSession, sf: str) -> DataFrame:
    """Means of all points; those without observations have NULL means."""
    return ind.indicator_means(
        derived.points_with_unobserved(spark, sf), derived.observations(spark, sf), on_missing="null"
    ).select("point_id", *MEAN_COLUMNS)


def scaled_features(spark: SparkSession, sf: str) -> tuple[DataFrame, features.Scaling]:
    plain = settle(gappy_features(spark, sf))
    scaling = features.fit_scaling(plain, MEAN_COLUMNS)
    return scaling.standardize(plain), scaling


def many_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled features with the fixed labellings point_id modulo 2 .. 6."""
    scaled, _ = scaled_features(spark, sf)
    return settle(scaled.withColumns({name: F.col("point_id") % int(name[1:]) for name in LABELLINGS}))


def nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled features with the nearest of the fixed labels' means."""
    scaled, _ = scaled_features(spark, sf)
    centroids = scaled.groupBy(fixed_label()).agg(*[F.avg(m).alias(m) for m in MEAN_COLUMNS])
    return kmeans.assign_nearest(scaled, centroids, MEAN_COLUMNS)


def region_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of fixed clusters within each region: (region, cluster_id, ...)."""
    nations = derived.read(spark, sf, "nation").select(
        F.col("n_name").alias("country"), F.col("n_regionkey").alias("region")
    )
    table = settle(labelled(spark, sf).join(nations, "country"))
    centroids = table.groupBy("region", "cluster_id").agg(*[F.avg(m).alias(m) for m in MEAN_COLUMNS])
    return clusters.cluster_profiles(table, centroids, by=["region"])


def region_indices(spark: SparkSession, sf: str) -> DataFrame:
    wide = region_profiles(spark, sf).select("region", "cluster_id", "centroid.*")
    scores = interpret.cluster_zscores(wide, MEAN_COLUMNS, ["region"])
    solar = interpret.composite_index(scores, SOLAR_MEANS, "solar_index")
    return interpret.composite_index(solar, WIND_MEANS, "wind_index")


def region_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    indexed = region_indices(spark, sf)
    solar = interpret.percentile_rank(indexed, "solar_index", "solar_percentile", ["region"])
    return interpret.percentile_rank(solar, "wind_index", "wind_percentile", ["region"])


def measured_labellings(spark: SparkSession, sf: str) -> DataFrame:
    table = many_labels(spark, sf)
    k = F.substring("labelling", 2, 2).cast("int")
    scores = silhouette.silhouette(table, MEAN_COLUMNS, LABELLINGS).join(
        quality.davies_bouldin(table, MEAN_COLUMNS, LABELLINGS), "labelling"
    )
    return scores.select(k.alias("k"), k.alias("position"), "silhouette", "davies_bouldin")


def rand_table(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("point_id")
    return derived.points_with_unobserved(spark, sf).select(
        "point_id",
        (p % 4).alias("run_0"),
        ((p + (p % 10 == 0).cast("int")) % 4).alias("run_1"),
        (F.floor(p / 3) % 4).alias("run_2"),
    )


def gate_table(spark: SparkSession, sf: str) -> DataFrame:
    best = quality.recommended_k(measured_labellings(spark, sf))
    steady = settle(quality.stability(quality.adjusted_rand(rand_table(spark, sf), ["run_0", "run_1", "run_2"])))
    values = {
        "ari_mean": steady.select("ari_mean").scalar(),
        "ari_std": steady.select("ari_std").scalar(),
        "stability_runs": F.lit(3),
        "notes": F.array(quality.single_cluster_note(F.lit(2))),
    }
    return quality.quality_gates(best.withColumns(values))


# Sources and sinks -----------------------------------------------------------


@query
def ingest_payloads(spark: SparkSession, sf: str) -> DataFrame:
    landed = scratch_path(spark, "payloads")
    derived.payloads(spark, sf).write.parquet(landed)
    wanted = payloads.mapping_of(MAIN_VARIABLES)
    return rounded(payloads.ingest(spark, landed, "parquet", columns=wanted).select("point_id", "date", *MAIN_VARIABLES))


@query
def ingest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One document per line of text files, the point taken from the folder."""
    landed = scratch_path(spark, "lines")
    # By point first: a folder then holds one file, not one from every task that has a year of its point.
    documents = derived.payloads(spark, sf).select("payload", "point_id").repartition("point_id")
    documents.write.partitionBy("point_id").text(landed)
    wanted = payloads.mapping_of(MAIN_VARIABLES)
    return rounded(payloads.ingest(spark, landed, "lines", columns=wanted).select("point_id", "date", *MAIN_VARIABLES))


@query
def parse_payload(spark: SparkSession, sf: str) -> DataFrame:
    # Written first: otherwise the optimizer cancels the JSON round trip.
    wanted = payloads.mapping_of(MAIN_VARIABLES)
    parsed = payloads.parse_payloads(settle(derived.payloads(spark, sf)), columns=wanted, date_source="any")
    return rounded(parsed.select("point_id", "date", *MAIN_VARIABLES))


@query
def payload_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Why payloads gave fewer rows than they should."""
    told = payloads.payload_status(settle(derived.damaged_payloads(spark, sf)), keys=("point_id", "year"))
    return told.where("reason IS NOT NULL")


@query
def readable_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """The observations of stored payloads some of which are damaged or have no point in their file's name."""
    landed = scratch_path(spark, "damaged")
    named = derived.damaged_payloads(spark, sf).withColumn("point_id", F.when(F.col("point_id") % 5 != 0, F.col("point_id")))
    named.write.parquet(landed)
    read, problems = payloads.ingest_with_problems(spark, landed, "parquet", columns=payloads.mapping_of(MAIN_VARIABLES))
    days = read.groupBy("point_id").agg(F.count(F.lit(1)).alias("n"))
    lost = problems.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return days.select("point_id", F.lit("").alias("reason"), "n").unionByName(lost.select(F.lit(-1).cast("bigint").alias("point_id"), "reason", "n"))


@query
def fill_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.fill_to_null(derived.observations(spark, sf)))


@query
def parse_date_key(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("l_shipdate", "yyyyMMdd")
    key = (
        F.when(F.col("l_linenumber") == 4, F.substring(day, 1, 7))
        .when(F.col("l_linenumber") == 5, F.concat(day, F.lit("10")))
        .when(F.col("l_linenumber") == 6, F.concat(F.substring(day, 1, 4), F.lit("13"), F.substring(day, 7, 2)))
        .otherwise(day)
    )
    keyed = derived.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.alias("date_key"))
    return keyed.withColumn("date", payloads.parse_date_key(F.col("date_key"))).where("date IS NOT NULL")


@query
def points_without_data(spark: SparkSession, sf: str) -> DataFrame:
    counted = pts.observation_counts(derived.points_with_unobserved(spark, sf), derived.observations(spark, sf))
    return rounded(counted)


@query
def raw_observations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(pts.raw_observations(derived.observations(spark, sf), derived.points(spark, sf)))


@query
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    kept = store(spark)
    kept.save(derived.points(spark, sf), "observations")
    kept.save(derived.observations(spark, sf), "observations")
    return rounded(kept.load("observations"))


@query
def appended_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table saved in part and then appended to twice."""
    kept, rows = store(spark), derived.observations(spark, sf)
    kept.save(rows.where("point_id % 3 = 0"), "observations")
    kept.append(rows.where("point_id % 3 = 1"), "observations")
    kept.append(rows.where("point_id % 3 = 2"), "observations")
    return rounded(kept.load("observations"))


@query
def indicators_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The indicator table from observations stored by point and day, duplicates removed inside their buckets."""
    stored = save_by_day(derived.repeated_observations(spark, sf), scratch_path(spark, "by-day"))
    return rounded(ind.indicators(derived.points_with_unobserved(spark, sf), stored))


@query
def clean_stored_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table is read, cleaned and saved under its own key."""
    kept = store(spark)
    kept.save(derived.observations(spark, sf), "observations")
    kept.save(cleaning.clean(kept.load("observations")), "observations")
    return rounded(kept.load("observations").select("point_id", "date", *MAIN_VARIABLES))


@query
def dataset_metadata(spark: SparkSession, sf: str) -> DataFrame:
    kept = store(spark)
    kept.save(derived.observations(spark, sf), "observations")
    return kept.describe("observations").select(
        F.array_join("columns", ",").alias("columns"), "num_rows", (F.col("file_size_mb") > 0).alias("has_size")
    )


@query
def labelled_csv(spark: SparkSession, sf: str) -> DataFrame:
    table, path = labelled(spark, sf), scratch_path(spark, "csv")
    tables.write_csv(table, path)
    return rounded(tables.read_csv(spark, path, table.schema))


@query
def labelled_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    tables.write_parquet(labelled(spark, sf), path)
    return rounded(spark.read.parquet(path))


@query
def cluster_profiles(spark: SparkSession, sf: str) -> DataFrame:
    table = labelled(spark, sf)
    centroids = table.groupBy("cluster_id").agg(*[F.avg(m).alias(m) for m in MEAN_COLUMNS])
    path = scratch_path(spark, "profiles")
    tables.write_profile_csv(clusters.cluster_profiles(table, centroids), path)
    schema = "cluster_id BIGINT, label STRING, description STRING, size BIGINT, " + ", ".join(
        f"{m} DOUBLE" for m in MEAN_COLUMNS
    )
    return rounded(tables.read_csv(spark, path, schema))


@query
def profile_json(spark: SparkSession, sf: str) -> DataFrame:
    profiles, path = region_profiles(spark, sf), scratch_path(spark, "json")
    tables.write_json(profiles, path)
    back = spark.read.schema(profiles.schema).json(path)
    entries = back.select("region", "cluster_id", "size", "confidence", F.posexplode("country_breakdown"))
    return rounded(entries.select("region", "cluster_id", "size", "confidence", "pos", "col.*"))


def grid_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, int, int]:
    """Country boxes, number of suppliers, and a size giving about that many points a box."""
    n = derived.read(spark, sf, "supplier").count()
    return grid.bounds_of_points(derived.customer_points(spark, sf)), n, 7 * isqrt(n)


@query
def grid_points(spark: SparkSession, sf: str) -> DataFrame:
    bounds, _, size = grid_inputs(spark, sf)
    return rounded(grid.grid_points(bounds, size))


@query
def grid_sample(spark: SparkSession, sf: str) -> DataFrame:
    bounds, n, size = grid_inputs(spark, sf)
    return rounded(grid.generate_points(spark, size, n, None, bounds))


@query
def grid_max_points(spark: SparkSession, sf: str) -> DataFrame:
    bounds, n, size = grid_inputs(spark, sf)
    return rounded(grid.generate_points(spark, size, n, n // 2, bounds))


@query
def invalid_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(pts.split_points(derived.questionable_points(spark, sf))[1])


@query
def points_checksum(spark: SparkSession, sf: str) -> DataFrame:
    return pts.points_checksum(derived.points(spark, sf))


# Cleaning and checks ---------------------------------------------------------


@query
def range_null(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.null_out_of_range(derived.observations(spark, sf)))


@query
def in_years(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.in_years(derived.observations(spark, sf), 1996, 1998))


@query
def drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.drop_all_null(cleaning.null_out_of_range(derived.observations(spark, sf))))


@query
def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.drop_duplicate_rows(derived.repeated_observations(spark, sf)))


@query
def clean_missing_cols(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.clean(derived.repeated_observations(spark, sf).drop("ws_50m", "ws_100m")))


@query
def ordered_observations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.clean(derived.observations(spark, sf), sort=True))


@query
def clean_observations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.clean(derived.repeated_observations(spark, sf)))


@query
def complete_flag(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.complete_flag(cleaning.null_out_of_range(derived.observations(spark, sf))))


@query
def range_flag(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.range_flag(cleaning.fill_to_null(derived.observations(spark, sf))))


@query
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(checks.completeness(cleaning.null_out_of_range(derived.observations(spark, sf))))


@query
def completeness_missing(spark: SparkSession, sf: str) -> DataFrame:
    """One of the judged variables is no column of the table: no row is complete."""
    return rounded(checks.completeness(derived.observations(spark, sf).drop("ws_50m")))


@query
def completeness_by_point(spark: SparkSession, sf: str) -> DataFrame:
    nulled = cleaning.null_out_of_range(derived.observations(spark, sf))
    return rounded(checks.completeness(nulled, "all", 0.7, by=["point_id"]))


@query
def result_validation(spark: SparkSession, sf: str) -> DataFrame:
    table = clusters.labelled_indicators(
        ind.indicators(derived.points_with_unobserved(spark, sf), derived.observations(spark, sf)),
        fixed_labels(spark, sf),
    )
    return checks.result_validation(table, derived.read(spark, sf, "supplier").count())


@query
def invalid_runs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(runs.invalid_runs(derived.runs(spark, sf)).select("experiment", "run_seq", "memory_mb"))


# Indicators and scores -------------------------------------------------------


@query
def point_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ind.point_means(cleaning.clean(derived.repeated_observations(spark, sf)).drop("dni")))


@query
def point_position_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ind.point_position_scores(cleaning.clean(derived.observations(spark, sf))))


@query
def minmax_scores(spark: SparkSession, sf: str) -> DataFrame:
    means = ind.indicator_means(derived.points_with_unobserved(spark, sf), derived.observations(spark, sf))
    return rounded(scoring.minmax_scores(means).select("point_id", "solar_score", "wind_score"))


@query
def hybrid_score(spark: SparkSession, sf: str) -> DataFrame:
    means = ind.indicator_means(derived.points(spark, sf), derived.observations(spark, sf))
    return rounded(scoring.score(means, 0.4, 0.4, 0.2).select("point_id", "hybrid_score"))


@query
def indicators(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(indicator_table(spark, sf))


@query
def per_point_udf(spark: SparkSession, sf: str) -> DataFrame:
    def sums(rows):
        return {"total": float(rows["sw_dwn"].sum()), "n": int(rows["sw_dwn"].count())}

    merged = [F.try_divide(F.sum("total"), F.sum("n")).alias("sw_dwn_mean"), F.sum("n").alias("n_values")]
    cleaned = cleaning.clean(derived.observations(spark, sf)).select("point_id", "sw_dwn")
    return rounded(combine_per_point(cleaned, sums, "total double, n bigint", merged))


@query
def longest_bright_run(spark: SparkSession, sf: str) -> DataFrame:
    """A user's order-dependent function: the longest run of observations above a value."""
    cleaned = cleaning.clean(derived.observations(spark, sf)).select("point_id", "date", "sw_dwn")
    return merge_per_point(cleaned, BrightRuns, BrightRuns.step, BrightRuns.merge, lambda s: {"longest": s.longest}, "longest bigint", ["date", "sw_dwn"])


@query
def bright_run_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The same as one fold over each point's whole series."""
    cleaned = cleaning.clean(derived.observations(spark, sf)).select("point_id", "date", "sw_dwn")
    return fold_per_point(cleaned, BrightRuns, BrightRuns.step, lambda s: {"longest": s.longest}, "longest bigint", ["date", "sw_dwn"])


class BrightRuns(NamedTuple):
    """Of a stretch of a series: its length, its longest run, the runs at its beginning and its end."""

    size: int = 0
    longest: int = 0
    head: int = 0
    tail: int = 0

    def step(self, rows) -> "BrightRuns":
        size, longest, head, tail = self
        for bright in (rows["sw_dwn"] > 200).tolist():
            tail = tail + 1 if bright else 0
            head += bright and head == size
            size, longest = size + 1, max(longest, tail)
        return BrightRuns(size, longest, head, tail)

    def merge(self, later: "BrightRuns") -> "BrightRuns":
        return BrightRuns(
            self.size + later.size,
            max(self.longest, later.longest, self.tail + later.head),
            self.head + later.head if self.head == self.size else self.head,
            later.tail + self.tail if later.tail == later.size else later.tail,
        )


# Clusters --------------------------------------------------------------------


@query
def labelled_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(labelled(spark, sf))


@query
def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    listed = derived.points(spark, sf).select(fixed_label(5)).distinct()
    return clusters.cluster_sizes(fixed_labels(spark, sf), listed)


@query
def country_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    no_home = F.when(F.col("point_id") % 11 != 0, F.col("country"))
    return rounded(clusters.country_breakdown(labelled(spark, sf).withColumn("country", no_home)))


@query
def cluster_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clusters.cluster_summary(labelled(spark, sf)))


@query
def score_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clusters.score_series(labelled(spark, sf)))


@query
def feature_columns(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.feature_table(indicator_table(spark, sf).drop("dni_mean")))


@query
def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.impute_median(settle(gappy_features(spark, sf))))


@query
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scaled_features(spark, sf)[0])


@query
def kmeans_labels(spark: SparkSession, sf: str) -> DataFrame:
    table = settle(three_groups(spark, sf))
    labels = kmeans.KMeansClustering(3, 7, n_init=5).fit(table).labels(table)
    return labels.select("point_id", F.col("cluster_id").cast("bigint"))


def three_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Points in three well separated groups: any good fit finds point_id modulo 3."""
    group, noise = F.col("point_id") % 3, F.col("point_id") * 7 % 11 / 10.0
    apart = {"sw_dwn_mean": 100.0, "dni_mean": 50.0, "ws_50m_mean": 20.0, "ws_100m_mean": 40.0}
    return derived.points_with_unobserved(spark, sf).select(
        "point_id", *[(group * gap + noise).alias(name) for name, gap in apart.items()]
    )


@query
def kmeans_groups(spark: SparkSession, sf: str) -> DataFrame:
    table = three_groups(spark, sf)
    labels = kmeans.KMeansClustering(3, 42, n_init=3).fit(table).labels(table)
    return labels.select("point_id", F.col("cluster_id").cast("bigint"))


@query
def sweep_groups(spark: SparkSession, sf: str) -> DataFrame:
    _, report = quality.evaluate_k_range(three_groups(spark, sf), MEAN_COLUMNS, (2, 3, 4), stability_runs=3, n_init=3)
    flags = ["passes_silhouette", "passes_davies_bouldin", "passes_all"]
    return rounded(report.select("recommended_k", "silhouette", "davies_bouldin", "stability_runs", *flags))


@query
def sweep_fixed_starts(spark: SparkSession, sf: str) -> DataFrame:
    """Three rounds over the indicator features for several k at once, from the first points as centers."""
    scaled, scaling = scaled_features(spark, sf)
    table, names = settle(scaled), list(scaling.features)
    first = [tuple(r) for r in table.orderBy("point_id").select(*names).limit(max(SWEPT)).collect()]
    fits, _ = sweep.fit_together(table, scaling, [first[:k] for k in SWEPT], max_iter=3, tol=0.0)
    rows = [(k, i, *center, fit.inertia) for k, fit in zip(SWEPT, fits) for i, center in enumerate(fit.centers)]
    return rounded(spark.createDataFrame(rows, "k INT, cluster_id INT, " + "".join(f"{f} DOUBLE, " for f in names) + "inertia DOUBLE"))


class HalvesBySun:
    """A clustering without chance: split at the mean of one feature."""

    def fit(self, df: DataFrame, names) -> kmeans.ClusterModel:
        scaling = features.fit_scaling(df, names)
        side = [1.0 if f == "sw_dwn_mean" else 0.0 for f in names]
        return kmeans.ClusterModel(scaling, (tuple(-v for v in side), tuple(side)), 0.0)


@query
def custom_clustering(spark: SparkSession, sf: str) -> DataFrame:
    """A user's own clustering in place of K-Means."""
    result = flows.cluster(settle(indicator_table(spark, sf)), HalvesBySun())
    return result.labelled.select("point_id", F.col("cluster_id").cast("bigint"))


@query
def stored_model(spark: SparkSession, sf: str) -> DataFrame:
    """A clustering fitted on the points' means, stored, loaded, and applied to rows it has not seen."""
    path = scratch_path(spark, "model")
    save_model(HalvesBySun().fit(settle(gappy_features(spark, sf)), MEAN_COLUMNS), path)
    days = derived.daily_maxima(spark, sf).withColumnsRenamed(dict(zip(MAIN_VARIABLES, MEAN_COLUMNS)))
    labels = load_model(spark, path).labels(days)
    return labels.select("point_id", "date", F.col("cluster_id").cast("bigint"))


@query
def assign_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(nearest(spark, sf).select("point_id", "cluster_id", "distance2"))


@query
def nearest_part(spark: SparkSession, sf: str) -> DataFrame:
    """Of each point the part whose own means are nearest: a centroid for every part."""
    items = derived.read(spark, sf, "lineitem").withColumn("l_suppkey", F.col("l_partkey"))
    parts = derived.observed(items).groupBy(F.col("point_id").alias("cluster_id"))
    centroids = settle(parts.agg(*[F.avg(v).alias(m) for v, m in zip(MAIN_VARIABLES, MEAN_COLUMNS)]))
    table = indicator_table(spark, sf).select("point_id", *MEAN_COLUMNS)
    found = kmeans.assign_nearest(table, centroids, MEAN_COLUMNS)
    return rounded(found.select("point_id", "cluster_id", "distance2"))


@query
def inertia(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kmeans.inertia(nearest(spark, sf)))


@query
def cluster_centroids(spark: SparkSession, sf: str) -> DataFrame:
    scaled, scaling = scaled_features(spark, sf)
    return rounded(kmeans.label_centroids(scaled.withColumn("cluster_id", fixed_label()), scaling))


# Quality ---------------------------------------------------------------------


@query
def valid_k(spark: SparkSession, sf: str) -> DataFrame:
    candidates = derived.read(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("k"))
    return quality.valid_k(candidates, derived.read(spark, sf, "region").count() * 4)


@query
def silhouette_(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(silhouette.silhouette(many_labels(spark, sf), MEAN_COLUMNS, LABELLINGS))


@query
def silhouette_estimate(spark: SparkSession, sf: str) -> DataFrame:
    """Mean silhouette and its standard error from eight points of each label."""
    return rounded(silhouette.silhouette_estimate(many_labels(spark, sf), MEAN_COLUMNS, "l5", per_label=8))


@query
def silhouette_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    vectors = derived.read(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    parts = [F.get("embedding", F.lit(i)).cast("double").alias(name) for i, name in enumerate(names)]
    table = vectors.select(F.col("vec_id").alias("point_id"), "label", *parts)
    return rounded(silhouette.silhouette(table, names, ["label"]))


@query
def davies_bouldin(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.davies_bouldin(many_labels(spark, sf), MEAN_COLUMNS, LABELLINGS))


@query
def recommended_k(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.recommended_k(measured_labellings(spark, sf)))


@query
def adjusted_rand(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.adjusted_rand(rand_table(spark, sf), ["run_0", "run_1", "run_2"]))


@query
def rand_stability(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.stability(quality.adjusted_rand(rand_table(spark, sf), ["run_0", "run_1", "run_2"])))


@query
def quality_gates(spark: SparkSession, sf: str) -> DataFrame:
    flags = ["passes_silhouette", "passes_davies_bouldin", "passes_stability", "passes_all"]
    return gate_table(spark, sf).select("recommended_k", *flags)


@query
def quality_text(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_text(gate_table(spark, sf)).select("recommended_k", "report")


@query
def quality_by_k(spark: SparkSession, sf: str) -> DataFrame:
    """Over three clear groups: measures for k = 3, which are determined, and what must hold for any k."""
    measured = quality.quality_by_k(three_groups(spark, sf), MEAN_COLUMNS, (2, 3, 4), n_init=3)
    falls = F.coalesce(F.col("inertia") < F.lag("inertia").over(Window.orderBy("k")), F.lit(True))
    only = [F.when(F.col("k") == 3, F.col(c)).alias(c) for c in ("inertia", "silhouette", "davies_bouldin")]
    return rounded(measured.select("k", F.col("k").alias("n_labels"), *only, falls.alias("inertia_falls")))


@query
def kmeans_stability(spark: SparkSession, sf: str) -> DataFrame:
    steady = quality.evaluate_stability(three_groups(spark, sf), MEAN_COLUMNS, 3, 4)
    return rounded(steady.select("ari_mean", "ari_std"))


# Interpretation --------------------------------------------------------------


@query
def cluster_zscores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(region_indices(spark, sf).select("region", "cluster_id", *[f"{m}_z" for m in MEAN_COLUMNS]))


@query
def composite_index(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(region_indices(spark, sf).select("region", "cluster_id", "solar_index", "wind_index"))


@query
def percentile_rank(spark: SparkSession, sf: str) -> DataFrame:
    ranked = region_percentiles(spark, sf)
    return rounded(ranked.select("region", "cluster_id", "solar_percentile", "wind_percentile"))


@query
def quadrant_label(spark: SparkSession, sf: str) -> DataFrame:
    label = interpret.quadrant_label(F.col("solar_percentile"), F.col("wind_percentile"))
    return region_percentiles(spark, sf).select("region", "cluster_id", label.alias("label"))


@query
def label_confidence(spark: SparkSession, sf: str) -> DataFrame:
    confidence = interpret.label_confidence(F.col("solar_percentile"), F.col("wind_percentile"))
    return rounded(region_percentiles(spark, sf).select("region", "cluster_id", confidence.alias("confidence")))


@query
def dominant_country(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(interpret.dominant_country(clusters.country_breakdown(labelled(spark, sf))))


@query
def cluster_description(spark: SparkSession, sf: str) -> DataFrame:
    told = interpret.interpret(region_profiles(spark, sf), ["region"])
    return told.select("region", "cluster_id", "description")


@query
def interpret_clusters(spark: SparkSession, sf: str) -> DataFrame:
    told = interpret.interpret(region_profiles(spark, sf), ["region"])
    return rounded(
        told.select(
            "region", "cluster_id", "label", "size", "confidence", "solar_percentile", "wind_percentile", "centroid.*"
        )
    )


# Runs and whole flows --------------------------------------------------------


@query
def run_speedup(spark: SparkSession, sf: str) -> DataFrame:
    measured = runs.with_speedup(derived.runs(spark, sf), chunk=4096)
    return rounded(
        measured.select(
            "experiment", "run_seq", "mode", "worker_count", "seconds", "memory_mb", "baseline_seconds", "speedup",
            "efficiency",
        )
    )


@query
def runs_by_workers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(runs.runs_by_workers(runs.with_speedup(derived.runs(spark, sf))))


@query
def experiment_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary, path = runs.experiment_summary(derived.runs(spark, sf)), scratch_path(spark, "summary")
    tables.write_csv(summary, path)
    return rounded(tables.read_csv(spark, path, summary.schema))


@query
def experiment_stability(spark: SparkSession, sf: str) -> DataFrame:
    steady = derived.runs(spark, sf).withColumn("worker_count", F.col("run_seq") % 1000)
    return runs.experiment_stability(steady)


@query
def run_all(spark: SparkSession, sf: str) -> DataFrame:
    result = flows.run_all(derived.points(spark, sf), derived.observations(spark, sf), store(spark), clustering=HalvesBySun())
    ids = [F.col(c).cast("bigint").alias(c) for c in ("cluster_id", "size")]
    told = ["label", "description", "confidence", "solar_percentile", "wind_percentile", "centroid.*"]
    return rounded(result.profiles.select(*ids, *told))
