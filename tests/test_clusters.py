import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliovane.functions.medians import exact_medians
from heliovane.operators import clusters, features, interpret, kmeans, quality
from heliovane.operators import silhouette as silhouettes
from heliovane.operators.silhouette import silhouette, silhouette_values
from heliovane.schema import MEAN_COLUMNS

MEANS = ", ".join(f"{m} DOUBLE" for m in MEAN_COLUMNS)
LABELS = {"Hybrid-high", "Solar-dominant", "Wind-dominant", "Lower-resource"}


def indicator_frame(spark, rows, extra=""):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"point_id BIGINT, {MEANS}{extra}")


def blobs(spark, per_blob=20, seed=0):
    rng = np.random.default_rng(seed)
    points = np.vstack([rng.normal(c, 0.5, size=(per_blob, 4)) for c in (0.0, 20.0, -20.0)])
    return indicator_frame(spark, [tuple(map(float, p)) for p in points])


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_exact_medians(spark, n):
    rng = np.random.default_rng(n)
    values = np.column_stack([rng.normal(size=n), np.round(rng.exponential(3, size=n)), np.full(n, 2.5)])
    values[:, 0] *= 10.0 ** rng.integers(-5, 5, size=n)
    rows = [(*map(float, v), None) for v in values]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    for few in (1_000_000, 10):
        found = exact_medians(df, ["a", "b", "c", "d"], window_values=few)
        assert [found[c] for c in "abc"] == list(np.median(values, axis=0))
        assert found["d"] is None


def test_impute_and_standardize(spark):
    df = indicator_frame(spark, [(1.0, None, 3.0, 4.0), (2.0, math.nan, 4.0, 4.0), (None, None, 8.0, 4.0), (4.0, None, 9.0, 4.0)])
    imputed = [tuple(r)[1:] for r in features.impute_median(df).orderBy("point_id").collect()]
    assert imputed[2] == (2.0, 0.0, 8.0, 4.0) and imputed[0] == (1.0, 0.0, 3.0, 4.0)
    scaled = np.array([tuple(r)[1:] for r in features.standardize(df).orderBy("point_id").collect()])
    assert np.allclose(scaled.mean(axis=0), 0) and np.allclose(scaled.std(axis=0), [1, 0, 1, 0])
    with pytest.raises(ValueError):
        features.feature_columns(df.select("point_id"))


def test_kmeans_with_gaps(spark):
    df = indicator_frame(spark, [(1.0, 2.0, 3.0, 4.0), (1.5, None, 2.5, 3.5), (2.0, 3.0, 4.0, 5.0), (2.5, 3.5, 4.5, 5.5)])
    model = kmeans.KMeansClustering(2, 0).fit(df)
    labelled = model.labels(df)
    assert labelled.count() == 4
    assert {r["cluster_id"] for r in labelled.collect()} <= {0, 1}
    assert labelled.where("point_id = 1").first()["dni_mean"] is None


def test_empty_feature_and_profiles(spark):
    df = indicator_frame(spark, [(float(i), None, i + 0.5, i + 1.0) for i in range(1, 5)])
    model = kmeans.KMeansClustering(2, 0).fit(df)
    profiles = clusters.cluster_profiles(model.labels(df), model.centroids(df)).collect()
    assert len(profiles) == 2
    assert all("sw_dwn_mean" in p["centroid"].asDict() for p in profiles)
    assert all(p["country_breakdown"] == [] for p in profiles)


def test_ids_follow_centers_not_seeds(spark):
    df = blobs(spark)
    tables = []
    for seed in (0, 7, 42):
        model = kmeans.KMeansClustering(3, seed, n_init=2).fit(df)
        tables.append({r["point_id"]: r["cluster_id"] for r in model.labels(df).collect()})
        assert [r["sw_dwn_mean"] for r in model.centroids(df).collect()] == sorted(
            r["sw_dwn_mean"] for r in model.centroids(df).collect()
        )
    assert tables[0] == tables[1] == tables[2]
    assert tables[0][0] == 1 and tables[0][20] == 2 and tables[0][40] == 0


def test_equal_centers_take_the_lower_id(spark):
    df = blobs(spark)
    center = (0.5, 0.5, 0.5, 0.5)
    twins = kmeans.ClusterModel(features.fit_scaling(df, MEAN_COLUMNS), (center, center), 0.0)
    assert {r["cluster_id"] for r in twins.labels(df).collect()} == {0}


def test_one_cluster(spark):
    df = blobs(spark)
    model = kmeans.KMeansClustering(1).fit(df)
    assert model.inertia == pytest.approx(60 * 4)
    center = model.centroids(df).first()
    assert center["dni_mean"] == pytest.approx(df.agg(F.avg("dni_mean")).first()[0])


def test_own_feature_columns_survive_labelling(spark):
    df = blobs(spark)
    assert kmeans.KMeansClustering(3).fit(df).labels(df).drop("cluster_id").exceptAll(df).count() == 0


def test_country_breakdown(spark):
    # Two valleys of eight and twelve made-up points; the home repeats in a pattern of its own.
    rows = []
    for i in range(20):
        far = i >= 8
        base = (40.0 + i, 30.0 + i / 2, 1.0, 1.5) if not far else (240.0 + i, 210.0 - i, 11.0, 13.0)
        rows.append((*base, i / 20, 1 - i / 20, 0.25, ("Ebene", "Berg", "Ebene", "Ufer")[i % 4]))
    df = indicator_frame(spark, rows, ", solar_score DOUBLE, wind_score DOUBLE, hybrid_score DOUBLE, country STRING")
    model = kmeans.KMeansClustering(2, 5, n_init=3).fit(df)
    profiles = clusters.cluster_profiles(model.labels(df), model.centroids(df)).orderBy("cluster_id").collect()
    assert [(p["size"], p["label"], p["description"]) for p in profiles] == [
        (8, "Cluster 0", "Cluster 0 with 8 points"), (12, "Cluster 1", "Cluster 1 with 12 points"),
    ]
    for p, homes in zip(profiles, (rows[:8], rows[8:])):
        got = {c["country"]: (c["count"], c["percentage"], c["avg_solar_score"]) for c in p["country_breakdown"]}
        assert p["country_breakdown"][0]["country"] == "Ebene"
        for name in ("Ebene", "Berg", "Ufer"):
            mine = [r[4] for r in homes if r[7] == name]
            assert got[name] == (len(mine), pytest.approx(len(mine) / len(homes)), pytest.approx(sum(mine) / len(mine)))


def test_breakdown_order_ties_and_missing_country(spark):
    rows = [(1.0, 1.0, 1.0, 1.0, c) for c in ("PA", "CR", "CR", "BZ", None)]
    df = indicator_frame(spark, rows, ", country STRING").withColumn("cluster_id", F.lit(0))
    found = clusters.country_breakdown(df).orderBy("country_rank").collect()
    assert [(r["country"], r["count"], r["percentage"]) for r in found] == [("CR", 2, 0.4), ("BZ", 1, 0.2), ("PA", 1, 0.2)]


def profiles_of(spark, rows, breakdown=None):
    centers = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"cluster_id INT, {MEANS}")
    entry = "ARRAY<STRUCT<country: STRING, count: BIGINT, percentage: DOUBLE>>"
    lists = spark.createDataFrame([(i, (breakdown or {}).get(i, [])) for i in range(len(rows))], f"cluster_id INT, country_breakdown {entry}")
    return centers.join(lists, "cluster_id").select(
        "cluster_id", F.lit("").alias("label"), F.lit("").alias("description"), F.lit(10).alias("size"),
        F.struct(*MEAN_COLUMNS).alias("centroid"), F.lit(0.0).alias("confidence"),
        F.lit(0.5).alias("solar_percentile"), F.lit(0.5).alias("wind_percentile"), "country_breakdown",
    )


QUADRANTS = [(212.0, 151.0, 17.5, 21.0), (212.0, 151.0, 6.0, 7.25), (64.0, 33.0, 17.5, 21.0), (64.0, 33.0, 6.0, 7.25)]


def told(df):
    return interpret.interpret(df).orderBy("cluster_id").collect()


def test_four_quadrants_with_ties(spark):
    found = told(profiles_of(spark, QUADRANTS))
    assert [r["label"] for r in found] == ["Hybrid-high", "Solar-dominant", "Wind-dominant", "Lower-resource"]
    assert [r["solar_percentile"] for r in found] == pytest.approx([2 / 3, 1.0, 0.0, 1 / 3])
    assert all(0.0 <= r["confidence"] <= 1.0 for r in found)
    assert all("Pais dominante" not in r["description"] for r in found)


def test_three_clusters_use_known_labels(spark):
    rows = [(61.0, 18.0, 12.0, 3.0), (77.0, 44.0, 2.0, 9.0), (13.0, 71.0, 5.5, 8.0)]
    assert {r["label"] for r in told(profiles_of(spark, rows))} <= LABELS


def test_missing_variable(spark):
    rows = [(177.0, None, 0.5, 0.75), (21.0, None, 14.0, 19.0)]
    assert [r["label"] for r in told(profiles_of(spark, rows))] == ["Solar-dominant", "Wind-dominant"]
    dropped = profiles_of(spark, rows).withColumn("centroid", F.col("centroid").dropFields("dni_mean"))
    assert [r["label"] for r in told(dropped)] == ["Solar-dominant", "Wind-dominant"]


def test_single_and_no_cluster(spark):
    only = told(profiles_of(spark, [(88.0, 91.0, 7.0, 4.0)]))
    assert len(only) == 1 and only[0]["solar_percentile"] == only[0]["wind_percentile"] == 0.5
    assert only[0]["label"] == "Hybrid-high" and only[0]["confidence"] == 0.0
    assert told(profiles_of(spark, [(88.0, 91.0, 7.0, 4.0)]).limit(0)) == []


def test_description_names_the_dominant_country(spark):
    rows = [(143.0, 99.0, 0.5, 0.25), (17.0, 5.0, 23.0, 19.0)]
    found = told(profiles_of(spark, rows, {0: [("Berg", 16, 0.64), ("Ufer", 9, 0.36)]}))
    assert found[0]["description"] == (
        "Potencial predominantemente solar (10 puntos). Percentil solar: 100%, percentil eolico: 0% respecto a los "
        "demas clusters de esta corrida. Pais dominante: Berg (64% de los puntos de este cluster)."
    )
    assert "Pais" not in found[1]["description"]


def test_percent_text_rounds_halves_to_even(spark):
    shares = spark.createDataFrame([(v,) for v in (0.125, 0.135, 0.5, 1 / 3, 0.0, 1.0)], "v DOUBLE")
    texts = [r[0] for r in shares.select(interpret.percent_text(F.col("v"))).collect()]
    assert texts == [f"{v:.0%}" for v in (0.125, 0.135, 0.5, 1 / 3, 0.0, 1.0)]


def test_quality_formulas_on_known_values(spark):
    df = spark.createDataFrame([(0, 0.0, 0), (1, 2.0, 0), (2, 10.0, 1), (3, 12.0, 1)], "point_id BIGINT, x DOUBLE, l INT")
    assert silhouette(df, ["x"], ["l"]).first()["silhouette"] == pytest.approx(0.797980, abs=1e-6)
    assert quality.davies_bouldin(df, ["x"], ["l"]).first()["davies_bouldin"] == pytest.approx(0.2)
    pairs = spark.createDataFrame(list(zip(range(6), [0, 0, 0, 1, 1, 1], [0, 0, 1, 1, 1, 0])), "point_id BIGINT, a INT, b INT")
    assert quality.adjusted_rand(pairs, ["a", "b"]).first()["ari"] == pytest.approx(-0.111111, abs=1e-6)
    assert quality.adjusted_rand(pairs.withColumn("b", F.col("a") + 5), ["a", "b"]).first()["ari"] == 1.0
    alone = pairs.withColumns({"a": F.lit(0), "b": F.lit(0)})
    assert quality.adjusted_rand(alone, ["a", "b"]).first()["ari"] == 1.0
    with pytest.raises(ValueError):
        quality.adjusted_rand(pairs, ["a"])


@pytest.mark.parametrize("block_rows", [2048, 60, 9])
def test_silhouette_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    points, few, many = rng.normal(size=(120, 3)), rng.integers(0, 3, 120), rng.integers(0, 9, 120)
    points[30:60] = points[0]  # copies
    many[5] = 99  # alone in its label
    rows = [(i, *map(float, p), int(a), int(b), 1) for i, (p, a, b) in enumerate(zip(points, few, many))]
    df = spark.createDataFrame(rows, "point_id BIGINT, x DOUBLE, y DOUBLE, z DOUBLE, few INT, many INT, one INT")
    found = silhouette_values(df, ["x", "y", "z"], ["few", "many", "one"], block_rows=block_rows).collect()
    assert len(found) == 360
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    for name, labels in (("few", few), ("many", many)):
        got = {r["point_id"]: r["silhouette"] for r in found if r["labelling"] == name}
        for i in range(120):
            own = labels == labels[i]
            want = 0.0
            if own.sum() > 1:
                a = gaps[i][own].sum() / (own.sum() - 1)
                b = min(gaps[i][labels == c].mean() for c in set(labels) - {labels[i]})
                want = (b - a) / max(a, b)
            assert got[i] == pytest.approx(want, abs=1e-9)
    assert all(r["silhouette"] is None for r in found if r["labelling"] == "one")


@pytest.mark.parametrize("block_rows", [None, 50])
@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_silhouette_of_wide_points_equals_brute_force(spark, block_rows, offset):
    """Norms and products give the distances that differences give: copies, near copies and points far from the origin too."""
    rng = np.random.default_rng(4)
    points, labels = np.round(rng.normal(size=(240, 40)), 3), [*rng.integers(0, 3, 120).tolist(), *rng.integers(3, 60, 120).tolist()]
    points[20:60] = points[0]
    points[60:70] = points[0] + 1e-7
    points[70] *= 1e4
    points += offset
    table = spark.createDataFrame([(i, points[i].tolist(), labels[i]) for i in range(240)], "point_id INT, v ARRAY<DOUBLE>, l INT")
    axes = [f"e{i}" for i in range(40)]
    found = silhouette_values(table.select("point_id", "l", *[F.get("v", F.lit(i)).alias(a) for i, a in enumerate(axes)]), axes, ["l"], block_rows=block_rows)
    gaps, labels = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)), np.array(labels)
    got = {r["point_id"]: r["silhouette"] for r in found.collect()}
    for i in range(240):
        own = labels == labels[i]
        a = gaps[i][own].sum() / max(1, own.sum() - 1)
        b = min(gaps[i][labels == c].mean() for c in set(labels) - {labels[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b) if own.sum() > 1 else 0.0, abs=1e-8)


def test_points_of_a_silhouette_travel_one_by_one(spark, monkeypatch):
    """A row holds one point, so that a batch of rows is bounded, and not one or two blocks of points."""
    taken, real = [], silhouettes._distance_sums
    monkeypatch.setattr(silhouettes, "_distance_sums", lambda frame, *rest: taken.append(frame) or real(frame, *rest))
    rows = spark.range(5000).selectExpr("id AS point_id", "CAST(id % 97 AS DOUBLE) AS x", "CAST(id % 13 AS DOUBLE) AS y", "id % 3 AS l")
    assert silhouette_values(rows, ["x", "y"], ["l"]).count() == 5000
    lists = [c for c, kind in taken[0].dtypes if kind.startswith("array")]
    assert max(taken[0].agg(*[F.max(F.size(c)) for c in lists]).first()) == 2


def test_labels_and_features_that_are_missing(spark):
    rows = [(i, float(i), i % 2 if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "point_id INT, x DOUBLE, l INT").withColumn("none", F.lit(None).cast("int"))
    found = {(r["labelling"], r["point_id"]): r for r in silhouette_values(df, ["x"], ["l", "none"], block_rows=7).collect()}
    assert len(found) == 80 and all((r["silhouette"] is None) == (r["label"] is None) for r in found.values())
    gone = silhouette(df.withColumn("x", F.when(F.col("point_id") != 3, F.col("x"))), ["x"], ["l"]).first()["silhouette"]
    assert gone is None


def test_davies_bouldin_of_equal_centers(spark):
    df = spark.createDataFrame([(0, 0.0, 0), (1, 2.0, 0), (2, 0.0, 1), (3, 2.0, 1)], "point_id BIGINT, x DOUBLE, l INT")
    assert quality.davies_bouldin(df, ["x"], ["l"]).first()["davies_bouldin"] == 0.0


def test_sweep_recommends_three_for_three_blobs(spark):
    by_k, report = quality.evaluate_k_range(blobs(spark), MEAN_COLUMNS, [2, 3, 4, 5, 60], stability_runs=3)
    rows = by_k.orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4, 5]
    inertias = [r["inertia"] for r in rows]
    assert inertias == sorted(inertias, reverse=True)
    found = report.first()
    assert found["recommended_k"] == 3 and found["silhouette"] >= 0.5
    assert found["passes_silhouette"] and found["passes_davies_bouldin"] and found["passes_stability"] and found["passes_all"]
    assert found["stability_runs"] == 3 and found["ari_mean"] >= 0.95 and found["ari_std"] >= 0.0
    lines = found["report"].split("\n")
    assert lines[0] == "K recomendado: 3"
    assert lines[1].endswith("(PASA, umbral >= 0.5)") and lines[2].endswith("(PASA, umbral < 2.0)")
    assert lines[3].startswith("Estabilidad (ARI promedio de 3 corridas) = 1.000 +/- 0.000 (PASA, umbral >= 0.95)")
    assert lines[4:] == ["Nota: Se omitieron K=[60] por ser >= al numero de puntos (60)."]


def test_sweep_without_valid_k(spark):
    with pytest.raises(ValueError):
        quality.evaluate_k_range(blobs(spark, 1), MEAN_COLUMNS, [5, 6, 7])


def test_report_without_stability_and_notes(spark):
    table = spark.createDataFrame(
        [(4, 0.25, 2.5, None, None, 0, [])],
        "recommended_k INT, silhouette DOUBLE, davies_bouldin DOUBLE, ari_mean DOUBLE, ari_std DOUBLE, "
        "stability_runs INT, notes ARRAY<STRING>",
    )
    found = quality.quality_text(quality.quality_gates(table)).first()
    assert (found["passes_stability"], found["passes_all"]) == (None, False)
    assert found["report"] == (
        "K recomendado: 4\nSilhouette(4) = 0.250 (NO PASA, umbral >= 0.5)\n"
        "Davies-Bouldin(4) = 2.500 (NO PASA, umbral < 2.0)"
    )


def test_report_numbers(spark):
    values = [0.0625, 0.1875, -0.0002, -0.0007, -0.25, 0.9996, 0.0, 0.0005, 0.1235, 0.0015, 2.0005, 1e-9, 17.9995, -1.0005, 123.4565]
    values += np.random.default_rng(8).normal(size=200).round(4).tolist()
    table = spark.createDataFrame(
        [(i, v, 2.5, None, None, 0, []) for i, v in enumerate(values)],
        "recommended_k INT, silhouette DOUBLE, davies_bouldin DOUBLE, ari_mean DOUBLE, ari_std DOUBLE, "
        "stability_runs INT, notes ARRAY<STRING>",
    )
    rows = quality.quality_text(quality.quality_gates(table)).orderBy("recommended_k").collect()
    got = [r["report"].split("\n")[1].split(" = ")[1].split(" ")[0] for r in rows]
    assert got == [f"{v:.3f}" for v in values]


def test_recommended_k_takes_the_first_of_equals(spark):
    rows = [(0, 5, 0.7, 1.0), (1, 3, 0.7, 1.0), (2, 4, math.nan, 1.0), (3, 2, None, 1.0)]
    df = spark.createDataFrame(rows, "position INT, k INT, silhouette DOUBLE, davies_bouldin DOUBLE")
    assert quality.recommended_k(df).first()["recommended_k"] == 5


def test_points_without_a_label_are_left_out(spark):
    rows = [(0, 0.0, 0), (1, 2.0, 0), (2, 10.0, 1), (3, 12.0, 1), (4, 500.0, None)]
    df = spark.createDataFrame(rows, "point_id BIGINT, x DOUBLE, l INT")
    known = df.where("l IS NOT NULL")
    for measure, name in ((silhouette, "silhouette"), (quality.davies_bouldin, "davies_bouldin")):
        assert measure(df, ["x"], ["l"]).first()[name] == pytest.approx(measure(known, ["x"], ["l"]).first()[name])


def test_davies_bouldin_in_blocks_of_labels(spark):
    df = spark.range(300).selectExpr("CAST(hash(id) % 97 AS DOUBLE) AS x", "id % 23 AS l", "id % 2 AS m")
    whole = {r[0]: r[1] for r in quality.davies_bouldin(df, ["x"], ["l", "m"]).collect()}
    blocks = {r[0]: r[1] for r in quality.davies_bouldin(df, ["x"], ["l", "m"], at_once=4).collect()}
    assert blocks == pytest.approx(whole) and set(whole) == {"l", "m"}


def test_nearest_in_several_passes(spark):
    points = spark.range(200).selectExpr("id", "CAST(id % 40 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    centers = spark.range(30).selectExpr("CAST(id AS INT) AS cluster_id", "CAST(id % 20 AS DOUBLE) * 2 AS a", "CAST(id % 3 AS DOUBLE) AS b")
    centers = centers.unionByName(centers.where("cluster_id < 5"))
    once = kmeans.assign_nearest(points, centers, ["a", "b"])
    passes = kmeans.assign_nearest(points, centers, ["a", "b"], at_once=7)
    assert passes.columns == once.columns
    assert sorted(map(tuple, passes.collect())) == sorted(map(tuple, once.collect()))
    none = kmeans.assign_nearest(points, centers.limit(0), ["a", "b"]).first()
    assert none["cluster_id"] is None and none["distance2"] is None


def test_the_sweep_leaves_one_table(spark):
    from heliovane import session

    folder = session.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    by_k, report = quality.evaluate_k_range(blobs(spark), MEAN_COLUMNS, [2, 3], stability_runs=2)
    assert {f"{folder}/{name}" for name in set(os.listdir(folder)) - before} == {by_k.settled_at.removeprefix("file:")}
    assert by_k.count() == 2 and report.count() == 1
    with pytest.raises(ValueError):
        quality.evaluate_k_range(blobs(spark, 1), MEAN_COLUMNS, [5])
    kmeans.KMeansClustering(2).fit(blobs(spark), MEAN_COLUMNS)
    assert len(set(os.listdir(folder)) - before) == 1
