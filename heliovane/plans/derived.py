"""The library's input tables as they come out of the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovane.schema import PAYLOAD_COLUMNS


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(key: str):
    latitude = F.lit(7.2) + (F.col(key) * 37 % 1130) / 100.0
    longitude = F.lit(-92.2) + (F.col(key) * 53 % 1520) / 100.0
    return latitude.alias("latitude"), longitude.alias("longitude")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per supplier, the nation as its country."""
    nations = read(spark, sf_dir, "nation")
    suppliers = read(spark, sf_dir, "supplier")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("point_id"), *_place("s_suppkey"), F.col("n_name").alias("country")
    )


def points_with_unobserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points plus one per nation that no line item belongs to."""
    extra = read(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1000000).cast("bigint").alias("point_id"),
        *_place("n_nationkey"),
        F.col("n_name").alias("country"),
    )
    return points(spark, sf_dir).unionByName(extra)


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer, the nation as its country."""
    nations = read(spark, sf_dir, "nation")
    customers = read(spark, sf_dir, "customer")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("point_id"), *_place("c_custkey"), F.col("n_name").alias("country")
    )


def questionable_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers placed by their account balance: many fall outside the allowed ranges."""
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("point_id"),
        (F.col("c_acctbal") / 100.0).alias("latitude"),
        (F.col("c_acctbal") / 50.0 - 10.0).alias("longitude"),
        F.expr("substring(c_mktsegment, 1, c_nationkey % 4)").alias("country"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per line item; line number 7 carries the fill value."""
    return observed(read(spark, sf_dir, "lineitem"))


def observed(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("l_suppkey").alias("point_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_extendedprice") / 250.0).alias("sw_dwn"),
        (F.col("l_extendedprice") / 110.0).alias("dni"),
        (F.col("l_quantity") * 0.65).alias("ws_50m"),
        F.when(F.col("l_linenumber") == 7, F.lit(-999.0))
        .otherwise(F.col("l_quantity") * 0.55 + F.col("l_tax") * 100)
        .alias("ws_100m"),
    )


def repeated_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation twice."""
    once = observations(spark, sf_dir)
    return once.unionByName(once)


def daily_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per point and date: the largest value of each variable."""
    return (
        observations(spark, sf_dir)
        .groupBy("point_id", "date")
        .agg(*[F.max(v).alias(v) for v in ("sw_dwn", "dni", "ws_50m", "ws_100m")])
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily maxima as JSON documents, one per point and year (at most 366 dates each).

    Points divisible by three miss one parameter on some of their dates, so both
    ways of unfolding a payload are exercised.
    """
    parameter = {column: name for name, column in PAYLOAD_COLUMNS.items()}
    daily = daily_maxima(spark, sf_dir).withColumn("_key", F.date_format("date", "yyyyMMdd"))

    def by_date(variable: str):
        entries = F.collect_list(F.struct("_key", variable))
        return F.map_from_entries(F.sort_array(entries)).alias(parameter[variable])

    partial = F.collect_list(
        F.when(
            (F.col("point_id") % 3 != 0) | (F.dayofmonth("date") % 2 == 0),
            F.struct("_key", "ws_50m"),
        )
    )
    grouped = daily.groupBy("point_id", F.year("date").alias("year")).agg(
        by_date("sw_dwn"),
        by_date("dni"),
        F.map_from_entries(F.sort_array(partial)).alias(parameter["ws_50m"]),
        by_date("ws_100m"),
    )
    names = [parameter[v] for v in ("sw_dwn", "dni", "ws_50m", "ws_100m")]
    document = F.struct(F.struct(F.struct(*names).alias("parameter")).alias("properties"))
    return grouped.select("point_id", "year", F.to_json(document).alias("payload"))


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads, five of eight damaged in one way each, by point and year."""
    kind, text = (F.col("point_id") + F.col("year")) % 8, F.col("payload")
    damaged = (
        F.when(kind == 1, F.expr("substring(payload, 1, length(payload) div 2)"))
        .when(kind == 2, "")
        .when(kind == 3, '{"properties": null}')
        .when(kind == 4, F.replace(text, F.lit("ALLSKY_SFC_SW_DWN"), F.lit("OTHER")))
        .when(kind == 5, F.regexp_replace(text, '"(\\d{4})02(\\d{2})"', '"$1xx$2"'))
        .otherwise(text)
    )
    return payloads(spark, sf_dir).select("point_id", "year", damaged.alias("payload"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order; the priority is the experiment."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("experiment"),
        k.alias("run_seq"),
        F.element_at(F.array(*[F.lit(w) for w in (1, 2, 4, 8)]), (c % 4 + 1).cast("int")).alias("worker_count"),
        (k % 3 + 1).cast("int").alias("repeat"),
        F.when(k % 97 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice") / 1000.0).alias("seconds"),
        ((c % 500) * 0.5 - 10.0).alias("memory_mb"),
        (c % 300).alias("point_count"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("order "), k.cast("string"))).alias("error"),
        F.sha2((c % 3).cast("string"), 256).alias("checksum"),
    )
