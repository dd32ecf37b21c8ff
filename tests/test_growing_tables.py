"""Folds cut into ranges, sweeps over shared scans, sampled silhouettes, commits of several writers."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import functions as F
import pytest

from heliovane.functions.series import fold_per_point, fold_ranges, merge_per_point, merge_ranges
from heliovane.operators import kmeans, quality, silhouette, sweep
from heliovane.operators.features import fit_scaling
from heliovane.plans.queries import BrightRuns
from heliovane.session import settle
from heliovane.sources import tables
from heliovane.sources.tables import TableStore


def series(spark, n=3000):
    """A third of all rows belong to point 1, some to no point."""
    point = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 17 == 0, None).otherwise(F.col("id") % 40 + 2)
    return spark.range(n).select(
        point.cast("long").alias("point_id"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % n).cast("int")).alias("date"),
        F.when(F.col("id") % 29 != 0, (F.col("id") * F.col("id") * 31 % 997) % 500.0).alias("sw_dwn"),
    )


def longest(rows):
    best = {}
    for point, _, value in sorted(((r[0], r[1], r[2]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        now, most = best.get(point, (0, 0))
        now = now + 1 if value is not None and value > 200 else 0
        best[point] = now, max(most, now)
    return {p: most for p, (_, most) in best.items()}


def test_a_fold_cut_into_ranges_is_the_whole_fold(spark):
    rows = series(spark)
    wanted = longest(rows.collect())
    finish = lambda s: {"longest": s.longest}
    whole = fold_per_point(rows, BrightRuns, BrightRuns.step, finish, "longest bigint", ["date", "sw_dwn"])
    assert {r["point_id"]: r["longest"] for r in whole.collect()} == wanted
    for ranges in (1, 2, 7, 64):
        partial = fold_ranges(rows, BrightRuns, BrightRuns.step, ["date", "sw_dwn"], ranges=ranges)
        got = merge_ranges(partial, BrightRuns.merge, finish, "longest bigint")
        assert {r["point_id"]: r["longest"] for r in got.collect()} == wanted
    empty = merge_per_point(rows.limit(0), BrightRuns, BrightRuns.step, BrightRuns.merge, finish, "longest bigint")
    assert empty.collect() == []


def test_a_hot_point_is_spread_over_tasks(spark):
    partial = fold_ranges(series(spark, 30_000), BrightRuns, BrightRuns.step, ["date", "sw_dwn"], ranges=12).collect()
    tasks = {}
    for r in partial:
        tasks[r["range_no"]] = tasks.get(r["range_no"], 0) + r["n_rows"]
    assert sum(tasks.values()) == 30_000 and max(tasks.values()) <= 2 * np.median(list(tasks.values()))
    assert sum(r["point_id"] == 1 for r in partial) >= 4


def groups(spark, n=600):
    side = F.col("id") % 3
    return spark.range(n).select(F.col("id").alias("point_id"), (side * 10 + F.col("id") * 37 % 101 / 50.0).alias("a"), (side * side * 5 + F.col("id") * 53 % 89 / 40.0).alias("b"))


def lloyd(points, centers, rounds, tol):
    """One model alone; its centers, and how many rounds it took."""
    for done in range(1, rounds + 1):
        label = ((points[:, None] - centers) ** 2).sum(2).argmin(1)
        moved = np.array([points[label == i].mean(0) if (label == i).any() else c for i, c in enumerate(centers)])
        change, centers = ((moved - centers) ** 2).sum(), moved
        if change <= tol:
            break
    cost = ((points[:, None] - centers) ** 2).sum(2).min(1).sum()
    return sorted(map(tuple, centers)), cost, done


def test_models_that_share_scans_are_those_fitted_alone(spark):
    plain = settle(groups(spark))
    scaling = fit_scaling(plain, ["a", "b"])
    scaled = settle(scaling.standardize(plain))
    points = np.array([tuple(r) for r in scaled.select("a", "b").collect()])
    starts = [points[:2], points[5:8], points[:6], np.vstack([points[:2], [[90.0, 90.0]]])]
    models, scans = sweep.fit_together(scaled, scaling, starts, max_iter=40, tol=1e-9)
    alone = [lloyd(points, s, 40, 1e-9) for s in starts]
    for model, (centers, cost, _) in zip(models, alone):
        assert np.allclose(model.centers, centers) and np.isclose(model.inertia, cost)
    rounds = [done for *_, done in alone]
    assert scans == max(rounds) + 1 < sum(rounds)
    assert (90.0, 90.0) in models[3].centers  # nothing was near it


def test_each_round_is_one_job_for_all_models(spark, monkeypatch):
    calls = []
    plain = settle(groups(spark))
    real = sweep.center_sums
    monkeypatch.setattr(sweep, "center_sums", lambda *a: calls.append(len(a[2])) or real(*a))
    _, names, models = quality.fit_label_columns(plain, ["a", "b"], [(2, 1), (3, 1), (4, 1)], n_init=2)
    assert calls[0] == 6 and calls[-1] == 6 and sorted(calls[:-1], reverse=True) == calls[:-1]
    assert [len(m.centers) for m in models] == [2, 3, 4] and names == ["k2_seed1", "k3_seed1", "k4_seed1"]
    labels = {tuple(r) for r in models[1].labels(plain).select(F.col("point_id") % 3, "cluster_id").distinct().collect()}
    assert len(labels) == 3


def test_starting_centers_and_few_points(spark):
    plain = settle(spark.createDataFrame([(i, float(i % 2), 1.0) for i in range(10)], "point_id long, a double, b double"))
    scaling = fit_scaling(plain, ["a", "b"])
    (model,) = sweep.fit_settings(scaling.standardize(plain), scaling, [(4, 0)])
    assert len(model.centers) == 2 and model.inertia == 0
    with pytest.raises(ValueError):
        sweep.fit_settings(scaling.standardize(plain), scaling, [(11, 0)])
    again = [sweep.starting_centers(plain.repartition(n), ["a", "b"], [(2, 5)])[0].tolist() for n in (1, 3)]
    assert again[0] == again[1]


def test_sampled_silhouette_against_the_exact_one(spark):
    rows = groups(spark, 900).select("point_id", (F.col("a") * 0.3 + F.col("point_id") * 41 % 71 / 20.0).alias("a"), "b", (F.col("point_id") * F.col("point_id") % 3).alias("label"))
    rows = settle(rows.withColumn("label", F.when(F.col("point_id") == 7, 9).when(F.col("point_id") != 8, F.col("label"))))
    exact = silhouette.silhouette(rows.where("label is not null"), ["a", "b"], ["label"]).first()["silhouette"]
    whole = silhouette.silhouette_estimate(rows, ["a", "b"], "label", per_label=1000).first()
    assert np.isclose(whole["silhouette"], exact) and whole["standard_error"] == 0 and whole["n_sampled"] == whole["n_points"] == 899 and whole["n_labels"] == 3
    for per_label in (20, 60, 150):
        part = silhouette.silhouette_estimate(rows.repartition(5), ["a", "b"], "label", per_label=per_label).first()
        assert 0 < part["standard_error"] and abs(part["silhouette"] - exact) < 4 * part["standard_error"]
        assert part["n_sampled"] == sum(min(r["count"], per_label) for r in rows.where("label is not null").groupBy("label").count().collect())
    one = silhouette.silhouette_estimate(rows.withColumn("label", F.lit(1)), ["a", "b"], "label").first()
    assert one["silhouette"] is None and one["standard_error"] is None and one["n_labels"] == 1
    none = silhouette.silhouette_estimate(rows.where("label = 77"), ["a", "b"], "label").first()
    assert none["silhouette"] is None and none["n_points"] == 0
    with pytest.raises(ValueError):
        silhouette.silhouette_estimate(rows, ["a", "b"], "label", at_most=100)


def test_two_writers_lose_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: store.append(spark.range(i * 10, i * 10 + 10), "log"), range(6)))
    assert sorted(r["id"] for r in store.load("log").collect()) == list(range(60))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.save(spark.range(i + 1), "whole"), range(4)))
    assert store.load("whole").count() in (1, 2, 3, 4)


def test_a_commit_cut_short_counts_for_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.save(spark.range(5), "t")
    for number, content in ((2, ""), (3, "append\nfolder.parquet\ncomp")):
        (tmp_path / "t" / tables.COMMITS / f"{number:012d}-x").write_text(content)
    assert store.load("t").count() == 5
    store.append(spark.range(2), "t")
    assert store.load("t").count() == 7 and store.metadata("t")["num_rows"] == 7
    store.save(spark.range(3), "t")
    assert store.load("t").count() == 3


def test_cleaning_leaves_what_others_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    half = store._write(spark.range(4), "t", None)  # written, not yet committed
    for n in (1, 2, 3):
        store.save(spark.range(n), "t")
    held = {p.name for p in (tmp_path / "t").iterdir()}
    assert half in held and len(held - {half, tables.COMMITS}) == 2  # the current one and the one before
    store._commit("t", half, "append")
    assert store.load("t").count() == 7


def test_appended_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(10).withColumn("year", F.col("id") % 2)
    store.save(rows.where("id < 6"), "t", "year")
    store.append(rows.where("id >= 6"), "t", "year")
    assert sorted(tuple(r) for r in store.load("t").select("id", "year").collect()) == [(i, i % 2) for i in range(10)]
    assert not store.exists("other") and store.paths("other") == []
