import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heliovane.functions.series import combine_per_point, fold_per_point
from heliovane.operators import runs as run_ops
from heliovane.operators.cleaning import clean, drop_duplicate_rows
from heliovane.operators.indicators import indicators, point_means
from heliovane.operators.kmeans import KMeansClustering, assign_nearest
from heliovane.operators.points import raw_observations
from heliovane.plans import derived, flows
from heliovane.schema import MEAN_COLUMNS
from heliovane.sources import grid
from heliovane.sources.tables import TableStore
from tests.conftest import final_plan

SF = "/root/testdata/sf0.001"


def lattice(size):
    found = []
    for country, lat_lo, lat_hi, lon_lo, lon_hi in grid.COUNTRY_BOUNDS:
        for lat in np.linspace(lat_lo, lat_hi, size // 7 + 1):
            for lon in np.linspace(lon_lo, lon_hi, size // 7 + 1):
                found.append((float(lat), float(lon), country))
    return found


@pytest.mark.parametrize("size", [4, 20, 80])
def test_grid_equals_even_steps(spark, size):
    rows = grid.grid_points(grid.default_bounds(spark), size).orderBy("point_id").collect()
    assert [r["point_id"] for r in rows] == list(range(len(rows)))
    assert [tuple(r)[1:] for r in rows] == lattice(size)


@pytest.mark.parametrize("n", [1, 2, 5, 80, 333])
def test_sample_equals_even_positions(spark, n):
    rows = grid.generate_points(spark, 80, n).orderBy("point_id").collect()
    every = lattice(80)
    want = [every[i] for i in np.linspace(0, len(every) - 1, n, dtype=int)]
    assert [tuple(r)[1:] for r in rows] == want


def test_sample_and_cut(spark):
    assert grid.generate_points(spark, 4, 4).count() == 4
    assert [r["point_id"] for r in grid.generate_points(spark, 20, 20, 5).orderBy("point_id").collect()] == [0, 1, 2, 3, 4]
    assert grid.generate_points(spark, 4, 100).count() == 7
    assert grid.generate_points(spark, 80, None).count() == 1008


def test_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("t") and store.metadata("t") == {}
    store.save(spark.range(5), "t")
    store.save(spark.range(3).withColumn("v", F.lit(1.0)), "t")
    assert store.exists("t") and store.load("t").count() == 3
    described = store.metadata("t")
    assert described["columns"] == ["id", "v"] and described["num_rows"] == 3 and described["file_size_mb"] > 0


def test_a_table_can_replace_itself_and_survives_a_failing_save(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.save(spark.range(10), "t")
    store.save(store.load("t").where("id > 3"), "t")
    assert store.load("t").count() == 6
    with pytest.raises(Exception, match="no good"):
        store.save(store.load("t").withColumn("v", F.raise_error(F.lit("no good"))), "t")
    assert store.exists("t") and store.load("t").count() == 6


def test_fold_sees_rows_in_order_and_in_pieces(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    table = spark.range(400).selectExpr("id % 3 AS point_id", "(id * 37) % 400 AS date", "cast(id AS double) AS v")
    got = fold_per_point(table, list, lambda seen, rows: seen + rows["date"].tolist(), lambda seen: {"n": len(seen), "sorted": seen == sorted(seen)}, "n INT, sorted BOOLEAN")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 134, True), (1, 133, True), (2, 133, True)]


RUN = "experiment STRING, run_seq BIGINT, worker_count INT, seconds DOUBLE, memory_mb DOUBLE, status STRING, checksum STRING"


def run_table(spark):
    rows = [(1, 10.0, 5.0), (1, 8.0, -3.0), (2, 4.0, 1.0), (4, 0.0, 1.0), (1, 6.0, 1.0), (8, 2.0, 1.0), (0, 2.0, 1.0)]
    return spark.createDataFrame([("e", i, w, s, m, "success", "x") for i, (w, s, m) in enumerate(rows)], RUN)


@pytest.mark.parametrize("chunk", [65536, 2, 1])
def test_speedup_follows_the_latest_single_worker_run(spark, chunk):
    rows = run_ops.with_speedup(run_table(spark), chunk).orderBy("run_seq").collect()
    assert [r["speedup"] for r in rows] == [None, 1.25, 2.0, 0.0, 8.0 / 6.0, 3.0, 3.0]
    assert [r["efficiency"] for r in rows] == [None, 125.0, 100.0, 0.0, pytest.approx(8 / 6 * 100), 37.5, 0.0]
    assert rows[1]["memory_mb"] == 0.0
    assert [r["mode"] for r in rows][:3] == ["sequential", "sequential", "parallel"]


def test_run_checks_and_summaries(spark):
    runs = run_table(spark)
    assert sorted(r["run_seq"] for r in run_ops.invalid_runs(runs).collect()) == [1, 6]
    by = {r["worker_count"]: r for r in run_ops.runs_by_workers(run_ops.with_speedup(runs)).collect()}
    assert by[1]["mean_seconds"] == 8.0 and by[1]["mean_speedup"] == pytest.approx((1.25 + 8 / 6) / 2)
    mixed = runs.withColumn("checksum", F.when(F.col("run_seq") == 1, "y").otherwise(F.col("checksum")))
    steady = {r["worker_count"]: r["is_stable"] for r in run_ops.experiment_stability(mixed).collect()}
    assert steady[1] is False and steady[2] is True
    failed = runs.withColumn("status", F.when(F.col("run_seq") == 2, "failed").otherwise("success"))
    assert not run_ops.experiment_stability(failed).where("worker_count = 2").first()["is_stable"]


def test_user_functions(spark):
    table = clean(derived.observations(spark, SF)).select("point_id", "sw_dwn")
    want = {r[0]: r[1] for r in table.groupBy("point_id").agg(F.avg("sw_dwn")).collect()}

    def partial(rows):
        return {"s": float(rows["sw_dwn"].sum()), "n": int(rows["sw_dwn"].count())}

    merged = combine_per_point(table, partial, "s DOUBLE, n BIGINT", [(F.sum("s") / F.sum("n")).alias("m")])
    assert {r[0]: r[1] for r in merged.collect()} == pytest.approx(want)


def test_run_all_writes_everything(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "data"))
    points, observations = derived.points(spark, SF), derived.observations(spark, SF)
    result = flows.run_all(points, observations, store, str(tmp_path / "results"), KMeansClustering(3))
    assert store.load("raw_observations").count() == observations.count()
    assert store.load("indicators").count() == points.count() == result.labelled.count()
    read = spark.read.option("header", True)
    assert read.csv(f"{tmp_path}/results/cluster_indicators.csv").count() == 10
    assert read.csv(f"{tmp_path}/results/cluster_profiles.csv").columns == [
        "cluster_id", "label", "description", "size", *MEAN_COLUMNS,
    ]
    assert read.csv(f"{tmp_path}/results/cluster_summary.csv").columns == [
        "cluster_id", "points", "solar_mean", "wind_mean", "hybrid_mean",
    ]
    profiles = spark.read.json(f"{tmp_path}/results/cluster_profiles.json")
    assert profiles.agg(F.sum("size")).first()[0] == 10
    assert spark.read.parquet(f"{tmp_path}/results/cluster_indicators.parquet").count() == 10


def small_input(spark):
    points = grid.generate_points(spark, 4, 4)
    return points, derived.observations(spark, SF).withColumn("point_id", F.col("point_id") % 4)


def test_repeated_runs_go_on_counting(spark, tmp_path):
    points, observations = small_input(spark)
    flows.repeat_runs(points, observations, str(tmp_path), "trial", 1, KMeansClustering(2))
    runs = flows.repeat_runs(points, observations, str(tmp_path), "trial", 2, KMeansClustering(2))
    rows = runs.orderBy("run_seq").collect()
    assert [r["run_seq"] for r in rows] == [0, 1, 2] and {r["memory_mb"] for r in rows} == {None}
    assert {(r["status"], r["worker_count"], r["point_count"]) for r in rows} == {("success", spark.sparkContext.defaultParallelism, 4)}
    assert run_ops.experiment_stability(runs).first()["is_stable"] and run_ops.invalid_runs(runs).count() == 0
    place = f"{tmp_path}/trial/results/000002"
    assert spark.read.json(f"{place}/record.json").first()["checksum"] == rows[2]["checksum"]
    assert spark.read.parquet(f"{place}/labelled.parquet").count() == 4
    with pytest.raises(ValueError):
        flows.repeat_runs(points, observations, str(tmp_path), "trial", 0)


def test_a_failed_run_is_recorded(spark, tmp_path):
    points, observations = small_input(spark)
    nameless = points.withColumn("country", F.lit(None).cast("string"))
    with pytest.raises(RuntimeError, match="run 0 of bad failed"):
        flows.repeat_runs(nameless, observations, str(tmp_path), "bad", 1, KMeansClustering(2))
    rows = TableStore(spark, f"{tmp_path}/bad").load("runs").collect()
    assert [r["status"] for r in rows] == ["failed"] and "identity" in rows[0]["error"]


def test_years_bound_the_flow_and_prune_files(spark, tmp_path):
    points, observations = small_input(spark)
    store = TableStore(spark, str(tmp_path))
    flows.run_all(points, observations, store, clustering=KMeansClustering(2), years=(1995, 1996))
    raw = store.load("raw_observations")
    assert sorted(r[0] for r in raw.select("year").distinct().collect()) == [1995, 1996]
    one = raw.where("year = 1996")
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString() and len(one.inputFiles()) > 0


# Plans that must hold at scale -----------------------------------------------


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_indicators_read_the_observations_once(spark, conf, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    plan = final_plan(indicators(derived.points(spark, SF), derived.observations(spark, SF)))
    assert len([line for line in plan.splitlines() if "FileScan" in line and "l_suppkey" in line]) == 1
    assert "ReusedExchange" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Window" not in plan


def test_duplicates_combine_before_the_shuffle_and_spread_by_row(spark):
    plan = final_plan(point_means(drop_duplicate_rows(derived.observations(spark, SF))))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert exchanges[1].count("#") > 4  # the whole row, not the point alone
    assert "HashAggregate" in plan.split("Exchange hashpartitioning")[-1]


def test_hot_point_is_split_when_points_are_too_many_to_broadcast(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    hot = derived.observations(spark, SF).repartition(16).withColumn(
        "point_id", F.when(F.rand(1) < 0.7, 3).otherwise(F.col("point_id"))
    )
    joined = raw_observations(hot, derived.points(spark, SF))
    assert "skew=true" in final_plan(joined)
    assert joined.count() == hot.count()


def test_assignment_moves_no_points(spark):
    points = spark.range(100).select(F.col("id").alias("point_id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    centers = spark.createDataFrame([(0, 0.1, 0.1), (1, 0.9, 0.9)], "cluster_id INT, a DOUBLE, b DOUBLE")
    plan = final_plan(assign_nearest(points, centers, ["a", "b"]))
    assert "Join" not in plan and "Exchange hashpartitioning" not in plan
    tied = assign_nearest(points.withColumns({"a": F.lit(0.5), "b": F.lit(0.5)}), centers, ["a", "b"])
    assert {r["cluster_id"] for r in tied.collect()} == {0}
