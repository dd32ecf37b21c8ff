"""Column names, fixed ranges and table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Observation variables, in table order.
MAIN_VARIABLES = ("sw_dwn", "dni", "ws_50m", "ws_100m")
OTHER_VARIABLES = (
    "sw_diff",
    "clr_sky_sw_dwn",
    "allsky_kt",
    "wd_100m",
    "wd_50m",
    "t2m",
    "t2m_max",
    "t2m_min",
    "t2mdew",
    "ps",
    "rh2m",
    "qv2m",
    "prectotcorr",
    "cloud_amt",
)
VARIABLES = MAIN_VARIABLES + OTHER_VARIABLES

# Payload parameter name -> observation column.  The columns called
# *_100m carry the 10 m measurement; callers may pass another mapping.
PAYLOAD_COLUMNS = {
    "ALLSKY_SFC_SW_DWN": "sw_dwn",
    "ALLSKY_SFC_SW_DNI": "dni",
    "ALLSKY_SFC_SW_DIFF": "sw_diff",
    "CLRSKY_SFC_SW_DWN": "clr_sky_sw_dwn",
    "ALLSKY_KT": "allsky_kt",
    "WS10M": "ws_100m",
    "WS50M": "ws_50m",
    "WD10M": "wd_100m",
    "WD50M": "wd_50m",
    "T2M": "t2m",
    "T2M_MAX": "t2m_max",
    "T2M_MIN": "t2m_min",
    "T2MDEW": "t2mdew",
    "PS": "ps",
    "RH2M": "rh2m",
    "QV2M": "qv2m",
    "PRECTOTCORR": "prectotcorr",
    "CLOUD_AMT": "cloud_amt",
}
DATE_PARAMETER = "ALLSKY_SFC_SW_DWN"
FILL_VALUE = -999.0

# Closed ranges; cleaning nulls values outside the first table, the
# second one only flags rows.
CLEANING_RANGES = {
    "sw_dwn": (0.0, 400.0),
    "dni": (0.0, 900.0),
    "ws_50m": (0.0, 30.0),
    "ws_100m": (0.0, 30.0),
}
PLAUSIBLE_RANGES = {
    "sw_dwn": (0.0, 400.0),
    "dni": (0.0, 900.0),
    "ws_50m": (0.0, 25.0),
    "ws_100m": (0.0, 30.0),
}

# Default scoring weights, clustering and quality thresholds.
WEIGHT_SOLAR, WEIGHT_WIND, WEIGHT_HYBRID = 0.5, 0.3, 0.2
DEFAULT_CLUSTERS, DEFAULT_SEED = 5, 42
SILHOUETTE_THRESHOLD = 0.5
DAVIES_BOULDIN_THRESHOLD = 2.0
STABILITY_THRESHOLD = 0.95

MEAN_COLUMNS = tuple(f"{v}_mean" for v in MAIN_VARIABLES)
SOLAR_MEANS = ("sw_dwn_mean", "dni_mean")
WIND_MEANS = ("ws_50m_mean", "ws_100m_mean")
SCORE_COLUMNS = ("solar_score", "wind_score", "hybrid_score")
IDENTITY_COLUMNS = ("point_id", "latitude", "longitude", "country")

POINT_SCHEMA = T.StructType(
    [
        T.StructField("point_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)
OBSERVATION_SCHEMA = T.StructType(
    [T.StructField("point_id", T.LongType()), T.StructField("date", T.DateType())]
    + [T.StructField(v, T.DoubleType()) for v in VARIABLES]
)
RUN_SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_seq", T.LongType()),
        T.StructField("worker_count", T.IntegerType()),
        T.StructField("repeat", T.IntegerType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("memory_mb", T.DoubleType()),
        T.StructField("point_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("checksum", T.StringType()),
    ]
)


def present(df: DataFrame, wanted) -> list[str]:
    """The wanted columns the frame really has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]
