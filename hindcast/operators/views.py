"""Chart-ready tables: everything a front end needs to draw forecasts, in local time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.functions.scalars import is_honest, peak_label
from hindcast.functions.zones import to_local
from hindcast.operators.metrics import span, widen
from hindcast.operators.reshape import quantile_bands
from hindcast.operators.selection import find_peaks
from hindcast.schemas import CHANNELS, LOCAL_ZONE

WATER = CHANNELS[0]
MARGIN = 0.5


def issued_label(issued_at: Column, zone: str = LOCAL_ZONE) -> Column:
    """Issue time for chart titles, in local time."""
    return F.concat(F.lit("Issued "), F.date_format(to_local(issued_at, zone), "yyyy-MM-dd HH:mm"))


def fan_lines(backtests: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Median line of each forecast with its label; dashed when it saw weather nobody could have known."""
    middle = backtests.where((F.col("channel") == WATER) & (F.col("q") == 0.5))
    return middle.select(
        "series_id", "label", to_local(F.col("target_time"), zone).alias("local_time"), F.col("value").alias("median"),
        (~is_honest(F.col("kind"))).alias("dashed"),
    )


def fan_bands(backtests: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    bands = quantile_bands(
        backtests.where(F.col("channel") == WATER), keys=["series_id", "label", "target_time"]
    )
    return bands.withColumn("local_time", to_local(F.col("target_time"), zone)).drop("target_time")


def peak_notes(backtests: DataFrame, zone: str = LOCAL_ZONE, **kwargs) -> DataFrame:
    """Significant maxima of each median line with the text to show at them."""
    middle = backtests.where((F.col("channel") == WATER) & (F.col("q") == 0.5))
    peaks = find_peaks(middle, "value", keys=("series_id", "label"), **kwargs)
    local = to_local(F.col("target_time"), zone)
    return peaks.select(
        "series_id", "label", local.alias("local_time"), "value", peak_label(F.col("value"), local).alias("note")
    )


def _band_span(quantiles: DataFrame) -> DataFrame:
    outer = quantiles.where((F.col("channel") == WATER) & F.col("q").isin(0.01, 0.99))
    return span(outer, "value")


def _clip(df: DataFrame, limits: DataFrame, value: str, zone: str) -> DataFrame:
    """Values inside the visible local range, both ends included."""
    local = to_local(F.col("ts"), zone)
    return (
        df.withColumn("_at", local)
        .join(limits, "series_id")
        .where(F.col("_at").between(F.col("x_from"), F.col("x_to")) & F.col(value).isNotNull())
    )


def forecast_axes(forecast: DataFrame, history: DataFrame, weather: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Axis limits of the forecast-only chart: one day of history before it, half a unit around everything seen."""
    limits = forecast.groupBy("series_id").agg(
        (F.min(to_local(F.col("target_time"), zone)) - F.expr("interval 1 day")).alias("x_from"),
        F.max(to_local(F.col("target_time"), zone)).alias("x_to"),
    )
    spans = [
        _band_span(forecast),
        span(_clip(weather, limits, "airtemp", zone), "airtemp"),
        span(_clip(history, limits, "value", zone), "value"),
    ]
    return limits.join(widen(spans), "series_id").select(
        "series_id", "x_from", "x_to", (F.col("low") - MARGIN).alias("y_from"), (F.col("high") + MARGIN).alias("y_to")
    )


def backtest_axes(forecast: DataFrame, backtests: DataFrame, weather: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Axis limits of the chart with backtests, and whether it needs the note about perfect weather."""
    local = to_local(F.col("target_time"), zone)
    main = forecast.groupBy("series_id").agg(F.min(local).alias("_first"), F.max(local).alias("x_to"))
    earlier = backtests.groupBy("series_id").agg(
        F.min(local).alias("_earliest"), F.bool_or(~is_honest(F.col("kind"))).alias("_oracle")
    )
    limits = main.join(earlier, "series_id", "left").select(
        "series_id", F.coalesce("_earliest", "_first").alias("x_from"), "x_to",
        F.coalesce("_oracle", F.lit(False)).alias("oracle_note"),
    )
    spans = [
        _band_span(forecast), _band_span(backtests),
        span(_clip(weather, limits.drop("oracle_note"), "airtemp", zone), "airtemp"),
    ]
    return limits.join(widen(spans), "series_id").select(
        "series_id", "x_from", "x_to", (F.col("low") - MARGIN).alias("y_from"),
        (F.col("high") + MARGIN).alias("y_to"), "oracle_note",
    )
