import itertools
import os
import random
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel

from heliovane.operators import kmeans
from heliovane.operators.features import fit_scaling
from heliovane.operators.models import ClusterLabels, load_model, save_model

FEATURES = ["a", "b"]
HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table(spark, rows):
    return spark.createDataFrame(rows, "id INT, a DOUBLE, b DOUBLE")


def scattered(n, seed=5):
    draw = random.Random(seed)
    return [(i, draw.gauss(0, 3), draw.choice([draw.random(), draw.gauss(40, 1)])) for i in range(n)]


def brute_force(points, centers):
    def key(p, c):
        return ((p[1] - c[1]) ** 2 + (p[2] - c[2]) ** 2, c[0])

    return {p[0]: min(key(p, c) for c in centers) for p in points}


def nearest(spark, points, centers, **options):
    centroids = table(spark, centers).withColumnRenamed("id", "cluster_id")
    found = kmeans.assign_nearest(table(spark, points), centroids, FEATURES, compared="compared", **options)
    return {r["id"]: r for r in found.collect()}


@pytest.mark.parametrize("at_once", [1 << 16, 150])
def test_grouped_search_finds_what_a_full_search_finds(spark, at_once):
    points, centers = scattered(300), scattered(400, seed=6)
    found = nearest(spark, points, centers, at_once=at_once)
    expected = brute_force(points, centers)
    assert {i: (r["distance2"], r["cluster_id"]) for i, r in found.items()} == expected
    full = nearest(spark, points, centers, grouped_from=1 << 20)
    assert {r["compared"] for r in full.values()} == {400}
    if at_once > 400:
        assert sum(r["compared"] for r in found.values()) < 400 * len(points) / 3


def test_grouped_search_keeps_ties_and_repeated_centers(spark):
    corners = [(i, float(x), float(y)) for i, (x, y) in enumerate(itertools.product(range(12), range(12)))]
    twins = [(i + 1000, a, b) for i, a, b in corners]
    points = [(i, x + 0.5, y + 0.5) for i, (x, y) in enumerate(itertools.product(range(11), range(11)))]
    found = nearest(spark, points, twins + corners)
    assert {i: (r["distance2"], r["cluster_id"]) for i, r in found.items()} == brute_force(points, twins + corners)
    same = [(i, 1.0, 1.0) for i in range(100, 0, -1)]
    assert {(r["distance2"], r["cluster_id"]) for r in nearest(spark, same[:3], same).values()} == {(0.0, 1)}


def test_missing_features_have_no_nearest(spark):
    centers = [*scattered(80), (900, None, 1.0)]
    found = nearest(spark, [(1, None, 2.0), (2, 0.0, 0.0)], centers)
    assert found[1]["cluster_id"] is None and found[1]["distance2"] is None
    assert found[2]["cluster_id"] == brute_force([(2, 0.0, 0.0)], centers[:-1])[2][1]


def fitted(spark):
    rows = table(spark, [*scattered(60), (60, None, 1.0)])
    scaling = fit_scaling(rows, FEATURES)
    return rows, kmeans.ClusterModel(scaling, ((-1.0, 0.1), (0.1, 1 / 3), (2.5e-17, -0.7)), 0.1 + 0.2)


def test_a_stored_model_is_the_same_model(spark, tmp_path):
    rows, model = fitted(spark)
    path = str(tmp_path / "model")
    save_model(model, path)
    again = load_model(spark, path)
    assert again == model
    assert again.labels(rows).collect() == model.labels(rows).collect()
    with pytest.raises(Exception, match="exists"):
        save_model(model, path)
    save_model(kmeans.ClusterModel(model.scaling, model.centers[:2], 0.0), path, overwrite=True)
    assert load_model(spark, path).centers == model.centers[:2]


def test_a_model_is_a_stage_of_a_stored_pipeline(spark, tmp_path):
    rows, model = fitted(spark)
    PipelineModel([ClusterLabels.of(model, "zone")]).save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(str(tmp_path / "pipeline"))
    expected = [r["cluster_id"] for r in model.labels(rows).orderBy("id").collect()]
    assert [r["zone"] for r in loaded.transform(rows).orderBy("id").collect()] == expected


class Striped(ClusterLabels):
    """A user's own stage: every odd id is cluster 1."""

    def _transform(self, dataset):
        return dataset.withColumn("cluster_id", dataset["id"] % 2)


def test_a_users_stage_is_stored_too(spark, tmp_path):
    rows, model = fitted(spark)
    save_model(Striped.of(model), str(tmp_path / "own"))
    loaded = load_model(spark, str(tmp_path / "own"))
    assert {(r["id"] % 2, r["cluster_id"]) for r in loaded.transform(rows).collect()} == {(0, 0), (1, 1)}
    with pytest.raises(TypeError):
        save_model(object(), str(tmp_path / "none"))


def test_a_new_session_labels_alike(spark, tmp_path):
    rows, model = fitted(spark)
    save_model(model, str(tmp_path / "model"))
    code = (
        "import sys; from pyspark.sql import SparkSession; from heliovane.operators.models import load_model;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate();"
        "print('model', repr(load_model(s, sys.argv[1])))"
    )
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "model")], cwd=HERE, capture_output=True, text=True, timeout=180)
    assert f"model {model!r}" in done.stdout


def test_a_search_keeps_comparisons_few_as_centroids_grow(spark):
    """Some leaves of a tree, where groups around leads had more than their square root, and the numbers of a full search."""
    points, centers = scattered(300), scattered(20_000, seed=6)
    few, full = nearest(spark, points, centers), nearest(spark, points, centers, grouped_from=1 << 20)
    assert {i: (r["distance2"], r["cluster_id"]) for i, r in few.items()} == {i: (r["distance2"], r["cluster_id"]) for i, r in full.items()}
    assert sum(r["compared"] for r in few.values()) < 200 * len(points)


@pytest.mark.parametrize("at_once", [1 << 16, 40])
def test_a_search_of_numbers_that_are_not_finite(spark, at_once):
    inf, nan = float("inf"), float("nan")
    centers = [*scattered(90), (-3, nan, 0.0), (-2, inf, 1.0), (-1, -inf, nan), (95, 1e200, 0.0), (96, inf, 1.0)]
    points = [(1, 0.5, 0.5), (2, inf, 1.0), (3, nan, 1.0), (4, -1e200, 0.0), (5, 3.0, -inf), (6, 9e199, 0.0)]
    found = nearest(spark, points, centers, at_once=at_once)
    full = nearest(spark, points, centers, grouped_from=1 << 20)
    assert {i: repr((r["distance2"], r["cluster_id"])) for i, r in found.items()} == {i: repr((r["distance2"], r["cluster_id"])) for i, r in full.items()}


def test_features_that_are_no_doubles_keep_their_kind(spark):
    whole = spark.createDataFrame([(i, i % 9, i % 7) for i in range(100)], "cluster_id INT, a INT, b INT")
    found = kmeans.assign_nearest(whole.withColumnRenamed("cluster_id", "id"), whole, FEATURES)
    assert dict(found.dtypes)["distance2"] != "double" and {r["distance2"] for r in found.collect()} == {0}
