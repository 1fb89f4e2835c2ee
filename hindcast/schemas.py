"""Table layouts and the fixed values that define their meaning."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and numbers that stored archives and their readers agree on.
LOCAL_ZONE = "Europe/Berlin"
CHANNELS = ("wassertemp", "airtemp_96", "pressure_96")
QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
BANDS = ((0.01, 0.99), (0.05, 0.95), (0.25, 0.75))
KIND_RANKS = {"oracle": 0, "replay": 1, "live": 2}
HONEST_KINDS = ("live", "replay")
SOURCE_LIVE = "dwd_forecast"
SOURCE_REPLAY = "dwd_forecast_archived"
SOURCE_ORACLE = "dwd_observed"
LEGACY_VERSION = "legacy"
PLAUSIBLE_RANGES = {
    "wassertemp": (-10.0, 35.0),
    "airtemp_96": (-30.0, 50.0),
    "pressure_96": (900.0, 1100.0),
}
MIN_COVERAGE = 0.80
COVARIATE_LEAD = 96
CONTEXT_ROWS = 384
HORIZON = 96
BACKTEST_OFFSETS = (96, 192, 288)
ARCHIVE_TOLERANCE_HOURS = 2
SNAPSHOT_MAX_AGE_HOURS = 12
PEAK_DISTANCE = 18
PEAK_PROMINENCE = 0.2
RAW_WEATHER = {"temperature": "lufttemperatur_c", "pressure_msl": "pressure"}
PROVENANCE = ("kind", "covariate_source", "issued_at", "model_id", "code_version")
METADATA = ("reference_time", "target_time", *PROVENANCE)


def quantile_column(channel: str, q: float) -> str:
    return f"{channel}_q{q}"


WIDE_QUANTILES = tuple(quantile_column(c, q) for c in CHANNELS for q in QUANTILES)

OBSERVATION = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

WEATHER_HOUR = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("pressure_msl", T.DoubleType()),
])

WEATHER_PAYLOAD = T.StructType([T.StructField("weather", T.ArrayType(WEATHER_HOUR))])

_PROVENANCE_FIELDS = [
    T.StructField("kind", T.StringType()),
    T.StructField("covariate_source", T.StringType()),
    T.StructField("issued_at", T.TimestampType()),
    T.StructField("model_id", T.StringType()),
    T.StructField("code_version", T.StringType()),
]

FORECAST_LONG = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("reference_time", T.TimestampType()),
    T.StructField("target_time", T.TimestampType()),
    *_PROVENANCE_FIELDS,
    T.StructField("channel", T.StringType()),
    T.StructField("q", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

FORECAST_WIDE = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("reference_time", T.TimestampType()),
    T.StructField("target_time", T.TimestampType()),
    *_PROVENANCE_FIELDS,
    *[T.StructField(name, T.DoubleType()) for name in WIDE_QUANTILES],
])

# Snapshots keep both layouts they are found in: the raw service names and the processed ones.
SNAPSHOT = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("pressure_msl", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("lufttemperatur_c", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("niederschlag_mm", T.DoubleType()),
    T.StructField("archive_timestamp", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("reference_time", T.TimestampType()),
])

FORECASTER_OUTPUT = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("target_time", T.TimestampType()),
    T.StructField("channel", T.StringType()),
    T.StructField("q", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])
