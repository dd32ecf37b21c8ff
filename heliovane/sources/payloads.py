"""Landed JSON payloads: scan the files and turn them into observation rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovane.operators.cleaning import nan_to_null
from heliovane.schema import DATE_PARAMETER, FILL_VALUE, PAYLOAD_COLUMNS, VARIABLES


def scan_payloads(spark: SparkSession, path: str, layout: str = "document", name_pattern: str | None = None) -> DataFrame:
    """Stored responses as ``(point_id, payload)`` rows.

    ``document`` reads one response per file, ``lines`` one per line, ``parquet`` a
    table that already has both columns.  For text the point comes from a
    ``point_id=`` folder, or else from the first group of ``name_pattern`` in the
    file name; a file that does not match stops the read.
    """
    found = scan_files(spark, path, layout, name_pattern)
    if layout != "parquet":
        message = F.concat(F.lit("no point number in file name "), F.col("file"))
        found = found.withColumn("point_id", F.coalesce("point_id", F.raise_error(message).cast("bigint")))
    return found.select("point_id", "payload")


def scan_files(spark: SparkSession, path: str, layout: str = "document", name_pattern: str | None = None) -> DataFrame:
    """The same with the file's name as ``file``; a name that does not match leaves ``point_id`` NULL."""
    if layout == "parquet":
        stored = spark.read.parquet(path)
        return stored.select(F.col("point_id").cast("bigint"), F.col("_metadata.file_name").alias("file"), "payload")
    if layout not in ("document", "lines"):
        raise ValueError(f"layout must be document, lines or parquet, got {layout!r}")
    texts = spark.read.text(path, wholetext=layout == "document")
    if "point_id" in texts.columns:
        point = F.col("point_id").try_cast("bigint")
    elif name_pattern is None:
        raise ValueError("give a name_pattern, or put the files into point_id= folders")
    else:
        point = F.regexp_extract("_metadata.file_name", name_pattern, 1).try_cast("bigint")
    return texts.select(point.alias("point_id"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("payload"))


def parse_date_key(key: Column) -> Column:
    """Date from characters 1-4, 5-6 and 7-8; NULL if they are no date.

    Trailing characters are ignored and a one-digit last part is accepted.
    """
    parts = F.concat_ws("-", F.substring(key, 1, 4), F.substring(key, 5, 2), F.substring(key, 7, 2))
    return parts.try_cast("date")


def clean_number(text: Column, fill: float = FILL_VALUE) -> Column:
    """Number from text; fill value, NaN and anything that is no number give NULL."""
    return F.nullif(nan_to_null(text.try_cast("double")), F.lit(fill))


def _payload_type(parameters: Sequence[str]) -> T.StructType:
    # Inner values are read as text: one quoted number must not void a whole map.
    by_date = T.MapType(T.StringType(), T.StringType())
    inner = T.StructType([T.StructField(p, by_date) for p in parameters])
    return T.StructType(
        [T.StructField("properties", T.StructType([T.StructField("parameter", inner)]))]
    )


def parse_payloads(
    payloads: DataFrame,
    payload: str = "payload",
    keys: Sequence[str] = ("point_id",),
    columns: Mapping[str, str] = PAYLOAD_COLUMNS,
    date_source: str = "first",
) -> DataFrame:
    """One row per date of each payload, one column per mapped parameter.

    Dates are those of the irradiance parameter (``date_source='first'``) or of any
    parameter (``'any'``).  Payloads that are no JSON, or have no dates, give no
    rows, and a key that is no date gives no row.  No shuffle: each payload is
    unfolded in place.  A parameter whose keys equal the date list is unfolded by
    position; only one with other keys is sorted and searched by halving.
    """
    if date_source not in ("first", "any"):
        raise ValueError(f"date_source must be first or any, got {date_source!r}")
    if date_source == "first" and DATE_PARAMETER not in columns:
        raise ValueError(f"the mapping needs {DATE_PARAMETER} to take the dates from")
    read = payloads.select(
        *keys, F.from_json(F.col(payload), _payload_type(list(columns))).alias("_doc")
    ).select(*keys, F.col("_doc.properties.parameter").alias("_p"))

    if date_source == "first":
        dates = F.map_keys(f"_p.{DATE_PARAMETER}")
    else:
        empty = F.array().cast("array<string>")
        dates = F.flatten(F.array(*[F.coalesce(F.map_keys(f"_p.{p}"), empty) for p in columns]))
    dated = read.select(*keys, "_p", F.array_distinct(dates).alias("_dates"))

    # Halving steps for a search among as many keys as the longest parameter has.
    longest = F.greatest(F.lit(1), *[F.coalesce(F.size(F.map_keys(f"_p.{p}")), F.lit(0)) for p in columns])
    halvings = F.sequence(F.ceil(F.log2(longest)).cast("int"), F.lit(0), F.lit(-1))
    steps = F.transform(halvings, lambda b: F.pow(2, b).cast("int"))

    def same_keys(parameter: str) -> Column:
        return F.map_keys(f"_p.{parameter}") == F.col("_dates")

    def by_position(parameter: str) -> Column:
        return F.when(same_keys(parameter), F.map_values(f"_p.{parameter}"))

    def to_search(parameter: str) -> Column:
        # Sorted by key, then by place: a date written twice keeps its last value.
        entries = F.map_entries(f"_p.{parameter}")
        placed = F.transform(
            entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value"))
        )
        return F.when(~same_keys(parameter), F.array_sort(placed))

    prepared = dated.select(
        *keys,
        "_dates",
        steps.alias("_steps"),
        *[by_position(p).alias(f"_same_{c}") for p, c in columns.items()],
        *[to_search(p).alias(f"_other_{c}") for p, c in columns.items()],
    )

    def in_date_order(column: str) -> Column:
        entries = F.col(f"_other_{column}")

        def find(date: Column) -> Column:
            def further(place: Column, step: Column) -> Column:
                return F.when(F.get(entries, place + step)["key"] <= date, place + step).otherwise(place)

            at = F.aggregate("_steps", F.lit(-1), further)
            entry = F.get(entries, at)
            return F.when(entry["key"] == date, entry["value"])

        none = F.array_repeat(F.lit(None).cast("string"), F.size("_dates"))
        return F.coalesce(F.col(f"_same_{column}"), F.when(entries.isNotNull(), F.transform("_dates", find)), none)

    lists = prepared.select(*keys, "_dates", *[in_date_order(c).alias(c) for c in columns.values()])
    ordered = [v for v in VARIABLES if v in columns.values()]
    ordered += [c for c in columns.values() if c not in ordered]
    rows = lists.select(*keys, F.inline(F.arrays_zip("_dates", *ordered)))
    return rows.select(
        *keys, parse_date_key(F.col("_dates")).alias("date"), *[clean_number(F.col(c)).alias(c) for c in ordered]
    ).where("date IS NOT NULL")


def payload_status(
    payloads: DataFrame,
    payload: str = "payload",
    keys: Sequence[str] = ("point_id",),
    columns: Mapping[str, str] = PAYLOAD_COLUMNS,
    date_source: str = "first",
) -> DataFrame:
    """Per payload: keys, ``n_dates`` and ``n_bad_dates`` (distinct date keys, those that are no date), ``reason``.

    The reason says why a payload gives fewer rows than it has dates, or none, and is NULL if
    all is well: ``no point``, ``empty``, ``unreadable`` (no JSON object, or none of the dates in the
    form that is expected), ``no parameters``, ``no dates``, ``no valid date``, ``some invalid dates``.
    Read in place without a shuffle; of the parameters only those that can give dates.
    """
    if date_source not in ("first", "any"):
        raise ValueError(f"date_source must be first or any, got {date_source!r}")
    dating = [DATE_PARAMETER] if date_source == "first" else list(columns)
    shape = T.StructType([*_payload_type(dating).fields, T.StructField("_unreadable", T.StringType())])
    doc = F.from_json(F.col(payload), shape, {"columnNameOfCorruptRecord": "_unreadable"})
    no_keys = F.array().cast("array<string>")
    listed = [F.coalesce(F.map_keys(F.col(f"_doc.properties.parameter.{p}")), no_keys) for p in dating]
    blank = F.col(payload).isNull() | ~F.col(payload).rlike(r"\S")
    read = payloads.select(*keys, blank.alias("_blank"), doc.alias("_doc")).select(
        *keys,
        "_blank",
        (F.col("_doc").isNull() | F.col("_doc._unreadable").isNotNull()).alias("_unreadable"),
        F.col("_doc.properties.parameter").isNull().alias("_bare"),
        F.array_distinct(F.flatten(F.array(*listed))).alias("_dates"),
    )
    bad = F.filter("_dates", lambda key: parse_date_key(key).isNull())
    counted = read.withColumn("n_dates", F.size("_dates")).withColumn("n_bad_dates", F.size(bad))
    lost = F.lit(False)
    for key in keys:
        lost = lost | F.col(key).isNull()
    reason = (
        F.when(lost, "no point")
        .when(F.col("_blank"), "empty")
        .when(F.col("_unreadable") & (F.col("n_dates") == 0), "unreadable")
        .when(F.col("_bare"), "no parameters")
        .when(F.col("n_dates") == 0, "no dates")
        .when(F.col("n_dates") == F.col("n_bad_dates"), "no valid date")
        .when(F.col("n_bad_dates") > 0, "some invalid dates")
    )
    return counted.select(*keys, "n_dates", "n_bad_dates", reason.alias("reason"))


def mapping_of(variables: Sequence[str]) -> dict[str, str]:
    """The part of the parameter mapping that yields these variables: nothing else is read from the JSON."""
    return {parameter: column for parameter, column in PAYLOAD_COLUMNS.items() if column in variables}


def ingest(spark: SparkSession, path: str, layout: str = "document", name_pattern: str | None = None, **parse_options) -> DataFrame:
    """Scan stored payloads and parse them."""
    return parse_payloads(scan_payloads(spark, path, layout, name_pattern), **parse_options)


def ingest_with_problems(
    spark: SparkSession, path: str, layout: str = "document", name_pattern: str | None = None, **parse_options
) -> tuple[DataFrame, DataFrame]:
    """Observations of the payloads that can be read, and (point_id, file, n_dates, n_bad_dates, reason) of the others.

    Nothing stops the read: a file without a point number is a problem like any other.  A payload
    some of whose dates are invalid is in both tables.  Both read the stored payloads, the second
    only the dates in them.
    """
    found = scan_files(spark, path, layout, name_pattern)
    read = parse_payloads(found.where("point_id IS NOT NULL").select("point_id", "payload"), **parse_options)
    wanted = {name: value for name, value in parse_options.items() if name in ("columns", "date_source")}
    # The file's name is no key that a payload could lack.
    told = payload_status(found.withColumn("file", F.coalesce("file", F.lit(""))), keys=("point_id", "file"), **wanted)
    return read, told.where("reason IS NOT NULL")
