"""Observations stored by point and day: nothing but partial averages moves afterwards."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from heliovane.operators.cleaning import clean
from heliovane.operators.indicators import indicators, point_means
from heliovane.plans import derived
from heliovane.session import scratch_path
from heliovane.sources.layout import forget, load_by_day, save_by_day
from tests.conftest import final_plan

SF = "/root/testdata/sf0.001"


def test_only_partial_averages_move(spark, conf):
    conf(spark__sql__adaptive__enabled="true")
    rows = derived.repeated_observations(spark, SF)
    stored = save_by_day(rows, scratch_path(spark, "by-day"), buckets=6)
    plan = final_plan(point_means(clean(stored)))
    exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|\w+)", plan)
    assert len(exchanges) == 1 and exchanges[0].startswith("hashpartitioning(point_id")
    assert "date" not in exchanges[0] and "Bucketed: true" in plan
    unplaced = re.findall(r"Exchange hashpartitioning", final_plan(point_means(clean(rows))))
    assert len(unplaced) == 2


def test_same_indicators_as_from_the_rows(spark):
    points, rows = derived.points_with_unobserved(spark, SF), derived.repeated_observations(spark, SF)
    for drop in (False, True):
        stored = save_by_day(rows, scratch_path(spark, "by-day"), drop_copies=drop)
        assert stored.count() == (rows.distinct().count() if drop else rows.count())
        want, got = (sorted(indicators(points, source).drop("latitude", "longitude").collect(), key=lambda r: r["point_id"]) for source in (rows, stored))
        assert [r["point_id"] for r in want] == [r["point_id"] for r in got]
        for a, b in zip(want, got, strict=True):
            assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a[2:], b[2:], strict=True))


def test_a_point_with_most_rows_is_spread(spark):
    days = spark.range(6000).selectExpr("if(id % 10 < 9, 1, id) AS point_id", "date_add(DATE '2001-01-01', cast(id AS int)) AS date", "1.0D AS sw_dwn")
    stored = save_by_day(days, scratch_path(spark, "by-day"), buckets=8)
    sizes = [r["n"] for r in clean(stored).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_loaded_again_without_the_catalog(spark):
    folder = scratch_path(spark, "by-day")
    rows = spark.createDataFrame([(1, datetime.date(2001, 1, 1), 2.0), (None, None, None), (1, None, 3.0)], "point_id long, date date, sw_dwn double")
    save_by_day(rows, folder, buckets=3)
    forget(spark, folder)
    again = load_by_day(spark, folder + "/")
    assert again.dtypes == rows.dtypes and sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    with pytest.raises(ValueError, match="already"):
        save_by_day(rows, folder)


def test_empty_and_missing_tables(spark):
    folder = scratch_path(spark, "by-day")
    rows = spark.createDataFrame([], "point_id long, date date, `sw dwn` double")
    assert save_by_day(rows, folder).count() == 0
    assert load_by_day(spark, folder).dtypes == rows.dtypes
    with pytest.raises(ValueError, match="no table"):
        load_by_day(spark, folder + "-other")
