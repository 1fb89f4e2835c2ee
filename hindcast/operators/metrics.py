"""Profiles, descriptive statistics and forecast scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.zones import to_local
from hindcast.operators.quantiles import exact_quantiles
from hindcast.schemas import LOCAL_ZONE

STEP = ("series_id", "reference_time", "target_time")


def side_by_side(df: DataFrame, reference: str, value: str, left: str, right: str, *, ts: str = "ts") -> DataFrame:
    """``ts``, ``series_id`` and the values of the reference series and of each other one at the times both have."""
    first = df.where(F.col("series_id") == reference).select(ts, F.col(value).alias(left))
    second = df.where(F.col("series_id") != reference).select(
        ts, F.concat_ws("-", F.lit(reference), "series_id").alias("series_id"), F.col(value).alias(right))
    return first.join(second, ts).select(ts, "series_id", left, right)


def difference(pair: DataFrame, left: str, right: str, out: str = "diff") -> DataFrame:
    return pair.withColumn(out, F.col(left) - F.col(right))


def local_profile(df: DataFrame, value: str, part: str, *, zone: str = LOCAL_ZONE, ts: str = "ts",
                  keys: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation and the band around the mean by local ``hour`` or ``month``."""
    parts = {"hour": F.hour, "month": F.month}
    at = parts[part](to_local(F.col(ts), zone)).alias(part)
    profile = df.groupBy(*keys, at).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return profile.withColumn("low", F.col("mean") - F.col("std")).withColumn("high", F.col("mean") + F.col("std"))


def describe(df: DataFrame, value: str, *, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per key, in two passes. Rows with a null key are left out."""
    keys = list(keys)
    return exact_quantiles(
        df, keys, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        also={
            "count": F.count(value), "mean": F.avg(value), "std": F.stddev_samp(value), "min": F.min(value),
            "max": F.max(value),
        },
    ).select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def span(df: DataFrame, value: str, *, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def widen(frames: Sequence[DataFrame], *, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """The span that contains all given spans; a missing one changes nothing."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole.groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def absolute_error(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def pinball(actual: Column, predicted: Column, q: Column) -> Column:
    """Twice the pinball loss, so that its integral is comparable with an absolute error."""
    return 2 * F.when(actual >= predicted, (actual - predicted) * q).otherwise((predicted - actual) * (1 - q))


def _known(df: DataFrame) -> DataFrame:
    return df.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _curve_window(keys: Sequence[str]):
    # One forecast step holds one row per quantile level, so these partitions stay at the number of levels.
    return Window.partitionBy(*keys).orderBy("q")


def crps_steps(df: DataFrame, *, keys: Sequence[str] = STEP, actual: str = "actual") -> DataFrame:
    """Per step: trapezoid integral of the doubled pinball loss over the known quantile levels."""
    w = _curve_window(keys)
    loss = _known(df).withColumn("_loss", pinball(F.col(actual), F.col("value"), F.col("q")))
    area = (F.col("_loss") + F.lag("_loss").over(w)) / 2 * (F.col("q") - F.lag("q").over(w))
    return loss.withColumn("_area", area).groupBy(*keys).agg(F.coalesce(F.sum("_area"), F.lit(0.0)).alias("crps"))


def crps_midpoint_steps(df: DataFrame, *, keys: Sequence[str] = STEP, actual: str = "actual") -> DataFrame:
    """Per step: the midpoint variant, integrating over the value axis between neighbouring quantiles.

    A step with an unknown quantile or actual has no score: leaving its area out would make it look better.
    """
    w = _curve_window(keys)
    v, q = F.col("value"), F.col("q")
    middle, level = (v + F.lag("value").over(w)) / 2, (q + F.lag("q").over(w)) / 2
    weight = F.when(F.col(actual) < middle, level * level).otherwise((1 - level) * (1 - level))
    part = weight * (v - F.lag("value").over(w))
    unknown = F.count_if(v.isNull() | F.isnan(v) | F.col(actual).isNull())
    total = F.coalesce(F.sum("_part"), F.lit(0.0))
    return df.withColumn("_part", part).groupBy(*keys).agg(F.when(unknown == 0, total).alias("crps"))


def interval_score(actual: Column, low: Column, high: Column, alpha: float) -> Column:
    """Winkler score of one step; null when a bound is missing."""
    below, above = F.greatest(low - actual, F.lit(0.0)), F.greatest(actual - high, F.lit(0.0))
    score = (high - low) + (below + above) * F.lit(2.0 / alpha)
    return F.when(low.isNotNull() & high.isNotNull(), score)


def coverage(bands: DataFrame, *, keys: Sequence[str], actual: str = "actual", low: str = "low",
             high: str = "high") -> DataFrame:
    """Share of measured values inside the band, ends included."""
    inside = F.coalesce(F.col(actual).between(F.col(low), F.col(high)), F.lit(False)).cast("double")
    return bands.groupBy(*keys).agg(F.avg(inside).alias("coverage"), F.count(F.lit(1)).alias("steps"))


def mean_scores(df: DataFrame, keys: Sequence[str], scores: Sequence[str]) -> DataFrame:
    """Averages that skip missing scores, whether stored as null or as NaN."""
    return df.groupBy(*keys).agg(*[F.avg(F.when(~F.isnan(s), F.col(s))).alias(s) for s in scores])
