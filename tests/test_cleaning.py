import datetime
import math

import pytest
from pyspark.sql import functions as F

from heliovane.operators import checks, cleaning
from heliovane.operators.indicators import indicator_means, indicators, point_means, point_position_scores
from heliovane.operators.points import (
    observation_counts, points_checksum, points_without_data, raw_observations, require_valid_points, split_points,
)
from heliovane.operators.scoring import score
from tests.conftest import final_plan

SERIES = "point_id BIGINT, date STRING, sw_dwn DOUBLE, dni DOUBLE, ws_50m DOUBLE, ws_100m DOUBLE"
POINTS = "point_id BIGINT, latitude DOUBLE, longitude DOUBLE, country STRING"


def test_clean_keeps_present_columns(spark):
    df = spark.createDataFrame(
        [("2011-07-09", 12.5, 3.0), ("2011-07-08", -4.0, 777.0), ("2011-07-07", 399.0, 0.0)], "date STRING, ws_50m DOUBLE, dni DOUBLE"
    )
    cleaned = cleaning.clean(df, sort=True)
    assert cleaned.columns == ["date", "ws_50m", "dni"]
    assert [(r["ws_50m"], r["dni"]) for r in cleaned.collect()] == [(None, 0.0), (None, 777.0), (12.5, 3.0)]


def test_clean_in_order(spark):
    rows = [
        (1, "2020-01-02", 400.0, 900.0, 30.0, 0.0),
        (1, "2020-01-01", 401.0, 5.0, 1.0, 1.0),
        (1, "2020-01-01", -1.0, 5.0, 1.0, 1.0),  # equal to the row above once nulled
        (1, "2020-01-01", 7.0, 5.0, 1.0, 1.0),  # same day, other value: stays
        (1, "2020-01-03", -5.0, 901.0, 31.0, math.nan),  # nothing left
        (2, "2020-01-01", 7.0, 5.0, 1.0, 1.0),  # same values, other point: stays
    ]
    cleaned = cleaning.clean(spark.createDataFrame(rows, SERIES), sort=True).collect()
    assert [tuple(r) for r in cleaned] == [
        (1, "2020-01-01", None, 5.0, 1.0, 1.0),
        (1, "2020-01-01", 7.0, 5.0, 1.0, 1.0),
        (1, "2020-01-02", 400.0, 900.0, 30.0, 0.0),
        (2, "2020-01-01", 7.0, 5.0, 1.0, 1.0),
    ]


def test_flags(spark):
    df = spark.createDataFrame([(1, "d", 1.0, 1.0, 28.0, None), (1, "d", 1.0, 1.0, 2.0, 3.0)], SERIES)
    assert [r["is_complete"] for r in cleaning.complete_flag(df).collect()] == [False, True]
    flagged = cleaning.range_flag(df).collect()
    assert [(r["ws_50m_ok"], r["ws_100m_ok"], r["plausible"]) for r in flagged] == [
        (False, None, False), (True, True, True),
    ]


def test_years(spark):
    days = [(datetime.date(y, m, d),) for y, m, d in [(2019, 12, 31), (2020, 1, 1), (2021, 12, 31), (2022, 1, 1)]]
    df = spark.createDataFrame(days, "date DATE")
    assert cleaning.in_years(df, 2020, 2021).count() == 2
    with pytest.raises(ValueError):
        cleaning.in_years(df, 2023, 2020)


def test_years_reach_the_file_scan(spark, tmp_path):
    days = [(datetime.date(2000 + i, 5, 1), float(i)) for i in range(20)]
    spark.createDataFrame(days, "date DATE, sw_dwn DOUBLE").write.parquet(str(tmp_path / "t"))
    stored = cleaning.in_years(spark.read.parquet(str(tmp_path / "t")), 2003, 2005).select("sw_dwn")
    plan = final_plan(stored)
    assert "GreaterThanOrEqual(date,2003-01-01)" in plan and "LessThanOrEqual(date,2005-12-31)" in plan
    assert stored.count() == 3


def test_completeness(spark):
    df = spark.createDataFrame([(1, "d", 1.0, 1.0, 1.0, 1.0), (1, "d", None, 1.0, 1.0, 1.0)], SERIES)
    report = checks.completeness(df).first()
    assert tuple(report) == (2, 1, 0.5, True)
    assert not checks.completeness(df, threshold=0.85).first()["is_valid"]
    assert tuple(checks.completeness(df.limit(0)).first()) == (0, 0, 0.0, False)
    assert tuple(checks.completeness(df.drop("ws_50m")).first()) == (2, 0, 0.0, False)


def test_means_and_positions(spark):
    df = spark.createDataFrame(
        [(1, "a", 100.0, 50.0, 4.0, 6.0), (1, "b", 200.0, 80.0, 8.0, 12.0), (2, "a", None, 1.0, 1.0, 5.0)], SERIES
    )
    one, two = point_position_scores(df).orderBy("point_id").collect()
    assert (one["sw_dwn_mean"], one["dni_mean"], one["ws_100m_mean"]) == (150.0, 65.0, 9.0)
    assert (one["solar_position"], one["wind_position"]) == (0.5, 0.5)
    assert one["hybrid_position"] == pytest.approx(0.45)
    assert (two["sw_dwn_mean"], two["solar_position"], two["wind_position"]) == (None, 0.0, 0.5)
    absent = point_means(df.drop("dni")).where("point_id = 1").first()
    assert absent["dni_mean"] == 0.0


def test_points_with_and_without_values(spark):
    points = spark.createDataFrame([(i, 10.0, -84.0, "Costa Rica") for i in range(4)], POINTS)
    df = spark.createDataFrame(
        [(0, "a", 100.0, 1.0, 1.0, 2.0), (1, "a", 300.0, 1.0, 1.0, 4.0), (2, "a", 999.0, 999.0, 99.0, 99.0)], SERIES
    )
    scored = {r["point_id"]: r for r in indicators(points, df).collect()}
    assert scored[2]["sw_dwn_mean"] is None and scored[2]["solar_score"] is None
    assert scored[3]["sw_dwn_mean"] == 0.0 and scored[3]["solar_score"] == 0.0
    assert scored[1]["solar_score"] == 1.0 and scored[1]["hybrid_score"] == 1.0
    assert scored[0]["solar_score"] == pytest.approx(1 / 3)
    assert indicator_means(points, df, on_missing="null").where("sw_dwn_mean IS NULL").count() == 2
    assert indicator_means(points, df, on_missing="drop").count() == 3
    with pytest.raises(ValueError):
        indicator_means(points, df, on_missing="guess")


def test_degenerate_range_scores_half(spark):
    schema = "point_id BIGINT, sw_dwn_mean DOUBLE, ws_100m_mean DOUBLE"
    same = score(spark.createDataFrame([(1, 5.0, None), (2, 5.0, None), (3, None, None)], schema)).collect()
    assert [(r["solar_score"], r["wind_score"]) for r in same] == [(0.5, 0.5)] * 3
    grouped = score(
        spark.createDataFrame([(1, 5.0, 1.0), (2, 7.0, 1.0), (11, 1.0, 2.0)], schema).selectExpr("*", "point_id > 9 AS g"),
        by="g",
    )
    assert {r["point_id"]: r["solar_score"] for r in grouped.collect()} == {1: 0.0, 2: 1.0, 11: 0.5}
    assert "wind_score" not in score(spark.createDataFrame([(1, 5.0)], "point_id BIGINT, sw_dwn_mean DOUBLE")).columns


def test_point_checks(spark):
    good = [(0, 14.5, -92.0, "Guatemala")]
    bad = [(1, 91.0, -92.0, "Guatemala"), (2, 14.5, 181.0, "Guatemala"), (3, 1.0, 1.0, "G"), (4, 1.0, 1.0, None),
           (5, math.nan, 1.0, "Guatemala"), (6, None, 1.0, "Guatemala")]
    valid, invalid = split_points(spark.createDataFrame(good + bad, POINTS))
    assert [r["point_id"] for r in valid.collect()] == [0]
    assert sorted(r["point_id"] for r in invalid.collect()) == [1, 2, 3, 4, 5, 6]
    assert require_valid_points(spark.createDataFrame(good, POINTS)).count() == 1
    with pytest.raises(Exception, match="invalid point"):
        require_valid_points(spark.createDataFrame(bad, POINTS)).collect()


def test_failed_points_stay_and_raw_rows_carry_attributes(spark):
    points = spark.createDataFrame([(0, 1.0, 2.0, "Guatemala"), (1, -1.0, -2.0, "Belize")], POINTS)
    df = spark.createDataFrame([(1, "2020-01-01", 1.0, 2.0, 3.0, 4.0)], SERIES)
    raw = raw_observations(df, points)
    assert raw.columns == ["point_id", "latitude", "longitude", "country", "date", "sw_dwn", "dni", "ws_50m", "ws_100m"]
    assert raw.count() == 1 and raw.first()["country"] == "Belize"
    assert observation_counts(points, df).count() == 2
    assert [r["point_id"] for r in points_without_data(points, df).collect()] == [0]


def test_checksum(spark):
    import hashlib

    rows = [(i, 10 + i / 7, -84 - i / 3, f"C{i % 3}") for i in range(10)]
    points = spark.createDataFrame(rows, POINTS)
    lines = [f"{a:.8f},{b:.8f},{c}" for _, a, b, c in rows]

    def digest(runs):
        return hashlib.sha256("".join(hashlib.sha256("\n".join(r).encode()).hexdigest() for r in runs).encode()).hexdigest()

    assert points_checksum(points.repartition(5)).first()["checksum"] == digest([lines])
    from_one = points.withColumn("point_id", F.col("point_id") + 1)
    assert points_checksum(from_one, chunk=16).first()["checksum"] == digest([lines])
    assert points_checksum(from_one, chunk=4).first()["checksum"] == digest([lines[:3], lines[3:7], lines[7:]])
    chunked = points_checksum(points, chunk=4).first()
    assert chunked["checksum"] == digest([lines[:4], lines[4:8], lines[8:]])
    assert chunked["n_points"] == 10


def test_result_validation(spark):
    schema = POINTS + ", cluster_id INT"
    whole = spark.createDataFrame([(0, 1.0, 1.0, "CR", 0), (1, 1.0, 1.0, "CR", 1)], schema)
    checks.require_valid_result(whole, 2)
    with pytest.raises(RuntimeError, match="incomplete"):
        checks.require_valid_result(whole, 3)
    with pytest.raises(RuntimeError, match="identity"):
        checks.require_valid_result(spark.createDataFrame([(0, None, 1.0, "CR", 0)], schema), 1)
