"""Observations stored in the layout that cleaning and averaging need, so they don't move again.

Rows lie in buckets by point and day.  Equal rows share both, so duplicates are removed inside a
bucket, and a point that owns a third of the table is spread over all buckets; after that
only the partial averages move, one row per point and task.

A stored table is a folder with `buckets-<number>` (the files) and `schema` (an empty table, written
last: a save that was cut short can't be loaded).  Spark knows buckets by its catalog only, so
loading names the folder there; the number of buckets comes from the folder, never from the caller.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from heliovane.operators.cleaning import drop_duplicate_rows

#: What rows are dealt by and sorted by within a file.
LAYOUT = ("point_id", "date")


def _buckets(spark: SparkSession, folder: str) -> list[int]:
    """The bucket numbers of the folders that lie there; none where there is no such folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []
    return [int(n.removeprefix("buckets-")) for n in names if n.startswith("buckets-")]


def _name(folder: str) -> str:
    return f"observations_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def save_by_day(observations: DataFrame, folder: str, buckets: int | None = None, drop_copies: bool = False) -> DataFrame:
    """Write to a new folder, dealt by point and day, and return the stored table.

    `buckets` is the session's number of shuffle partitions unless given.  Copies of one point's day meet in one
    bucket; `drop_copies` removes equal rows before they move (one more shuffle), for sources in which
    such copies may be a large share of all rows.
    """
    spark, folder = observations.sparkSession, folder.rstrip("/")
    if _buckets(spark, folder):
        raise ValueError(f"{folder} already holds a stored table")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = drop_duplicate_rows(observations) if drop_copies else observations
    placed = rows.repartition(n, *LAYOUT).write.format("parquet").bucketBy(n, *LAYOUT).sortBy(*LAYOUT)
    placed.option("path", f"{folder}/buckets-{n}").saveAsTable(_name(folder))
    spark.createDataFrame([], rows.schema).write.parquet(f"{folder}/schema")
    return load_by_day(spark, folder)


def load_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The stored table, in this session or any later one."""
    folder = folder.rstrip("/")
    found = _buckets(spark, folder)
    if len(found) != 1:
        raise ValueError(f"{folder} holds no table stored by point and day")
    schema = spark.read.parquet(f"{folder}/schema").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    layout = ", ".join(LAYOUT)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(folder)} ({columns}) USING parquet "
        f"CLUSTERED BY ({layout}) SORTED BY ({layout}) INTO {found[0]} BUCKETS LOCATION '{folder}/buckets-{found[0]}'"
    )
    return spark.table(_name(folder))


def forget(spark: SparkSession, folder: str) -> None:
    """Take the folder's name out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(folder.rstrip('/'))}")
