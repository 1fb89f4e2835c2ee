"""Plausibility gates over finished runs. Each returns verdict rows; ``enforce`` turns failures into an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators.asof import align, already_measured
from hindcast.operators.metrics import coverage
from hindcast.schemas import HORIZON, MIN_COVERAGE, PLAUSIBLE_RANGES


class GateFailed(RuntimeError):
    """A finished run that must not be published."""


def range_gate(df: DataFrame, *, keys: Sequence[str] = ("series_id",), ranges=PLAUSIBLE_RANGES) -> DataFrame:
    """Per channel and level: missing values, extremes, and whether they are plausible. Long quantiles in."""
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for channel, (lo, hi) in ranges.items():
        low = F.when(F.col("channel") == channel, F.lit(lo)).otherwise(low)
        high = F.when(F.col("channel") == channel, F.lit(hi)).otherwise(high)
    missing = F.col("value").isNull() | F.isnan("value")
    checked = df.where(F.col("channel").isin(*ranges)).groupBy(*keys, "channel", "q").agg(
        F.count_if(missing).alias("missing"),
        F.min(F.when(~missing, F.col("value"))).alias("lowest"),
        F.max(F.when(~missing, F.col("value"))).alias("highest"),
    )
    within = (F.col("lowest") >= low) & (F.col("highest") <= high)
    return checked.withColumn("passed", (F.col("missing") == 0) & F.coalesce(within, F.lit(False)))


def emptiness_gate(requests: DataFrame, forecast: DataFrame, *, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Every request must have forecast rows."""
    held = forecast.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    rows = F.coalesce("rows", F.lit(0))
    return requests.select(*keys).distinct().join(held, list(keys), "left").select(
        *keys, rows.alias("rows"), (rows > 0).alias("passed")
    )


def leak_gate(forecast: DataFrame, actuals: DataFrame, *, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Count forecast times that had a measurement already."""
    steps = forecast.select(*keys, *[c for c in ("series_id", "target_time") if c not in keys]).distinct()
    leaks = already_measured(steps, actuals).groupBy(*keys).agg(F.count(F.lit(1)).alias("leaked"))
    leaked = F.coalesce("leaked", F.lit(0))
    return steps.select(*keys).distinct().join(leaks, list(keys), "left").select(
        *keys, leaked.alias("leaked"), (leaked == 0).alias("passed")
    )


def coverage_gate(bands: DataFrame, actuals: DataFrame, *, keys: Sequence[str], minimum: float = MIN_COVERAGE
                  ) -> DataFrame:
    """Share of actuals inside each backtest's outer band. No overlap gives a null share and passes."""
    share = coverage(align(bands, actuals), keys=keys)
    known = F.coalesce(F.col("coverage") >= minimum, F.lit(True))
    return bands.select(*keys).distinct().join(share, list(keys), "left").select(
        *keys, "coverage", F.coalesce("steps", F.lit(0)).alias("steps"), known.alias("passed")
    )


def shape_gate(df: DataFrame, *, keys: Sequence[str], last_input: str | None = None, horizon: int = HORIZON,
               step: str = "interval 1 hour", slack: float = 1e-6) -> DataFrame:
    """Quantiles must not cross, values be finite, the horizon be whole and start one step after the input."""
    curve = Window.partitionBy(*keys, "target_time", "channel").orderBy("q")
    bad = F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf"))
    crossed = F.coalesce(F.col("value") < F.lag("value").over(curve) - slack, F.lit(False))
    # Collapse to one row per step first, so that counting steps needs no distinct over the quantile rows.
    steps = df.withColumn("_crossed", crossed).groupBy(*keys, "target_time").agg(
        F.count_if("_crossed").alias("_crossed"), F.count_if(bad).alias("_bad"),
        *([F.max(last_input).alias("_last")] if last_input else []),
    )
    starts = [(F.min("target_time") == F.max("_last") + F.expr(step)).alias("_starts")] if last_input else []
    gate = steps.groupBy(*keys).agg(
        F.sum("_crossed").alias("crossings"), F.sum("_bad").alias("not_finite"),
        F.count(F.lit(1)).alias("steps"), *starts,
    )
    passed = (F.col("crossings") == 0) & (F.col("not_finite") == 0) & (F.col("steps") == horizon)
    if last_input:
        passed = passed & F.col("_starts")
    return gate.withColumn("passed", passed).drop("_starts")


def enforce(verdicts: DataFrame, what: str) -> None:
    """Raise when any verdict failed. Reads back one count and one example row."""
    failed = verdicts.where(~F.col("passed")).select(F.to_json(F.struct("*")).alias("row"))
    summary = failed.agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("example")).first()
    if summary.n:
        raise GateFailed(f"{what}: {summary.n} failed, for example {summary.example}")
