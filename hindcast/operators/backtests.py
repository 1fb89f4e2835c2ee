"""Backtests resolved to the most honest source, covariate experiments and model comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.scalars import backtest_label, is_honest
from hindcast.operators.asof import current_snapshot, forecast_rows, nearest_forecast, snapshot_rows
from hindcast.operators.forecasting import (
    HOUR, assemble_known, context_rows, forecast_batch, known_hours, level_structs, local_hour, profile_forecast,
    replay_rows,
)
from hindcast.operators.metrics import crps_steps, interval_score, mean_scores
from hindcast.operators.timeseries import hours_back
from hindcast.schemas import (
    ARCHIVE_TOLERANCE_HOURS, CONTEXT_ROWS, HONEST_KINDS, HORIZON, QUANTILES, SNAPSHOT_MAX_AGE_HOURS, SOURCE_ORACLE,
    SOURCE_REPLAY,
)

BACKTEST_COLUMNS = (
    "request_id", "series_id", "offset_hours", "reference_time", "kind", "covariate_source", "is_honest", "label",
    "target_time", "channel", "q", "value", "from_archive",
)


def resolve_backtests(
    requests: DataFrame,
    archive: DataFrame,
    snapshots: DataFrame,
    gauge: DataFrame,
    weather: DataFrame,
    *,
    forecaster: Callable | None = None,
    tolerance_hours: float = ARCHIVE_TOLERANCE_HOURS,
    max_age_hours: float = SNAPSHOT_MAX_AGE_HOURS,
    rows: int = CONTEXT_ROWS,
    horizon: int = HORIZON,
    short: str = "error",
) -> DataFrame:
    """Answer each request from the archive, else by replay, else with the weather that really occurred.

    ``requests`` has ``request_id, series_id, offset_hours, ref``; ``archive`` long quantile rows; ``snapshots``
    ``series_id, reference_time, fetched_at, ts, airtemp, pressure``. Replays and oracles share one forecast pass.
    A request whose context is too short fails the job (``short="error"``), is left out (``"skip"``) or comes back as one
    row without kind and forecast (``"keep"``).
    """
    keep, short = short == "keep", "skip" if short == "keep" else short
    # Requests that share series and time have one answer, worked out once.
    wanted = requests.select("request_id", "series_id", "offset_hours", "ref")
    origins = wanted.select("series_id", "ref").distinct().withColumn("request_id", origin_id("series_id", "ref"))
    stored = nearest_forecast(origins, archive, tolerance_hours=tolerance_hours, kinds=HONEST_KINDS)
    answer = ["series_id", "ref", "reference_time", "kind", "covariate_source", "target_time", "channel", "q", "value"]
    looked_up = forecast_rows(stored, archive).select(*answer, F.lit(True).alias("from_archive"))

    unanswered = origins.join(stored.select("request_id"), "request_id", "left_anti")
    current = current_snapshot(unanswered, snapshots, max_age_hours=max_age_hours)
    replayable = current.select("request_id", "series_id", "ref")
    remaining = unanswered.join(replayable.select("request_id"), "request_id", "left_anti")

    ahead = snapshot_rows(current, snapshots).select("request_id", "ref", "ts", "airtemp", "pressure")
    known = known_hours(gauge, weather)
    replay = replay_rows(replayable, ahead, known, rows, short=short)
    oracle = context_rows(assemble_known(known), remaining, rows, short=short)
    computed = forecast_batch(replay.unionByName(oracle), forecaster, horizon=horizon)

    tagged = replayable.withColumns({"kind": F.lit("replay"), "covariate_source": F.lit(SOURCE_REPLAY)}).unionByName(
        remaining.withColumns({"kind": F.lit("oracle"), "covariate_source": F.lit(SOURCE_ORACLE)})
    )
    recomputed = computed.join(tagged, "request_id").withColumn("reference_time", F.col("ref")).select(
        *answer, F.lit(False).alias("from_archive")
    )
    answers = looked_up.unionByName(recomputed)
    return wanted.join(answers, ["series_id", "ref"], "left" if keep else "inner").withColumns({
        "is_honest": F.when(F.col("kind").isNotNull(), is_honest(F.col("kind"))),
        "label": backtest_label(F.col("offset_hours"), F.col("kind")),
    }).select(*BACKTEST_COLUMNS)


def origin_id(series: str, ref: str) -> Column:
    return F.concat_ws("|", series, F.unix_micros(ref).cast("string"))


def to_archive(backtests: DataFrame, issued_at: Column, *, model_id: str = "", code_version: str = "") -> DataFrame:
    """Recomputed backtests as archive rows; looked-up ones are stored already."""
    return backtests.where(~F.col("from_archive")).select(
        "series_id", "reference_time", "target_time", "kind", "covariate_source", issued_at.alias("issued_at"),
        F.lit(model_id).alias("model_id"), F.lit(code_version).alias("code_version"), "channel", "q", "value",
    ).distinct()


@dataclass(frozen=True)
class Configuration:
    """Which covariates an experiment may use, and whether it knows the air temperature ahead."""

    name: str
    air: bool = False
    other: bool = False
    air_ahead: bool = False


# Names of the covariate experiments and the settings they ran with.
CONFIGURATIONS = (
    Configuration("Univariate"),
    Configuration("+ Luft (Past)", air=True),
    Configuration("+ Luft (Past+Future)", air=True, air_ahead=True),
    Configuration("+ Fluss (Past)", other=True),
    Configuration("+ Fluss+Luft (Past)", air=True, other=True),
    Configuration("+ Fluss+Luft (Past+Future)", air=True, other=True, air_ahead=True),
)
EXPERIMENT_LEVELS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
EXPERIMENT_HORIZONS = (24, 96)
EXPERIMENT_BACK = (0, 240, 480)
EXPERIMENT_CONTEXT = 512


def covariate_fit(context: DataFrame) -> DataFrame:
    """Per origin: seasonal profile of the target and how its remainder follows each covariate."""
    # An origin holds at most the context length of rows, a season of it fewer still.
    season = Window.partitionBy("origin_id", "season")
    rest = context.withColumn("season", local_hour(F.col("ts"))).withColumn(
        "loc", F.avg("target").over(season)
    ).withColumn("rest", F.col("target") - F.col("loc"))
    return rest.groupBy("origin_id").agg(
        F.map_from_entries(F.collect_set(F.struct("season", "loc"))).alias("profile"),
        F.sqrt(F.avg(F.col("rest") * F.col("rest"))).alias("scale"),
        *[
            column
            for c in ("air", "other")
            for column in (
                F.coalesce(F.regr_slope("rest", c), F.lit(0.0)).alias(f"{c}_slope"),
                F.avg(c).alias(f"{c}_mean"),
                F.max_by(c, "ts").alias(f"{c}_last"),
            )
        ],
    )


def experiment_grid(
    frame: DataFrame,
    *,
    configurations: Sequence[Configuration] = CONFIGURATIONS,
    horizons: Sequence[int] = EXPERIMENT_HORIZONS,
    back: Sequence[int] = EXPERIMENT_BACK,
    context: int = EXPERIMENT_CONTEXT,
    levels: Sequence[float] = EXPERIMENT_LEVELS,
) -> DataFrame:
    """Mean scores per series, horizon and covariate configuration over rolling windows.

    ``frame`` is hourly and gap-free: ``series_id, ts, target, air, other``. Windows end ``max(horizons)`` rows before
    the last row, less each entry of ``back``. The forecaster is a seasonal profile shifted by the mean covariate
    effect; a covariate not known ahead keeps its last value.
    """
    longest = max(horizons)
    ends = frame.groupBy("series_id").agg(F.max("ts").alias("_end"), F.min("ts").alias("_start"))
    shift = F.explode(F.array(*[F.lit(b) for b in back])).alias("back")
    origins = ends.select("series_id", "_end", "_start", shift).select(
        "series_id", "_start", "back", F.concat_ws("|", "series_id", F.col("back").cast("string")).alias("origin_id"),
        (F.col("_end") - F.expr(HOUR) * (F.col("back") + longest)).alias("ref"),
    ).where(F.col("ref") >= F.col("_start")).drop("_start")
    past = hours_back(origins, context).join(frame, ["series_id", "ts"])
    fit = covariate_fit(past)

    ahead = origins.select("*", F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("step")).withColumn(
        "ts", F.col("ref") + F.expr(HOUR) * F.col("step")
    )
    truth = ahead.join(frame.select("series_id", "ts", "target", "air"), ["series_id", "ts"]).join(fit, "origin_id")
    setups = F.explode(F.array(*[
        F.struct(
            F.lit(c.name).alias("name"), F.lit(float(c.air)).alias("air"), F.lit(float(c.other)).alias("other"),
            F.lit(float(max(c.air + c.other, 1))).alias("used"), F.lit(c.air_ahead).alias("ahead"),
        )
        for c in configurations
    ])).alias("c")
    air_seen = F.when(F.col("c.ahead"), F.col("air")).otherwise(F.col("air_last"))
    effect = (
        F.col("c.air") * F.col("air_slope") * (air_seen - F.col("air_mean"))
        + F.col("c.other") * F.col("other_slope") * (F.col("other_last") - F.col("other_mean"))
    ) / F.col("c.used")
    located = truth.select("*", setups).withColumn(
        "loc", F.try_element_at("profile", local_hour(F.col("ts"))) + effect
    )
    # A 24-hour forecast is the first part of the 96-hour one, so steps are scored once and averaged per horizon.
    quantiles = located.select(
        "origin_id", "series_id", F.col("c.name").alias("configuration"), "step", F.col("target").alias("actual"),
        "loc", "scale", F.explode(level_structs(levels)).alias("l"),
    ).select(
        "origin_id", "series_id", "configuration", "step", "actual", F.col("l.q").alias("q"),
        (F.col("loc") + F.col("scale") * F.col("l.t")).alias("value"),
    )
    step_keys = ["origin_id", "series_id", "configuration", "step"]
    scored = score_steps(quantiles, step_keys)
    wide = F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon")
    windows = scored.select("*", wide).where(F.col("step") <= F.col("horizon")).groupBy(
        "origin_id", "series_id", "horizon", "configuration"
    ).agg(F.avg("error").alias("mae"), F.avg("crps").alias("crps"))
    return mean_scores(windows, ["series_id", "horizon", "configuration"], ["mae", "crps"])


def score_steps(quantiles: DataFrame, keys: Sequence[str], *, low: float | None = None, high: float | None = None,
                alpha: float | None = None) -> DataFrame:
    """Absolute error of the median and CRPS of every forecast step, optionally with an interval score."""
    middle = quantiles.groupBy(*keys).agg(
        F.max("actual").alias("_actual"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("_median"),
        *([
            F.max(F.when(F.col("q") == low, F.col("value"))).alias("_low"),
            F.max(F.when(F.col("q") == high, F.col("value"))).alias("_high"),
        ] if alpha else []),
    )
    out = middle.join(crps_steps(quantiles, keys=keys), list(keys))
    columns = [*keys, F.abs(F.col("_actual") - F.col("_median")).alias("error"), "crps"]
    if alpha:
        columns.append(interval_score(F.col("_actual"), F.col("_low"), F.col("_high"), alpha).alias("interval"))
    return out.select(*columns)


@dataclass(frozen=True)
class Contender:
    """A model in a comparison: its levels, the band it is judged by, and its forecaster."""

    name: str
    levels: Sequence[float]
    low: float
    high: float
    alpha: float
    season: Callable[[Column], Column]


CONTENDERS = (
    Contender("profile", QUANTILES, 0.25, 0.75, 0.5, local_hour),
    Contender("level", EXPERIMENT_LEVELS, 0.1, 0.9, 0.2, lambda ts: F.lit(0)),
)


def compare_models(frame: DataFrame, windows: DataFrame, horizon: int, *, value: str = "value",
                   context: int = CONTEXT_ROWS, contenders: Sequence[Contender] = CONTENDERS) -> DataFrame:
    """MAE, CRPS and interval score of each model on each chosen window.

    ``windows`` names the first hour of each window (``series_id, place, ts``); forecasts know the rows before it.
    """
    requests = windows.select(
        "series_id", "place", F.concat_ws("|", "series_id", F.col("place").cast("string")).alias("request_id"),
        (F.col("ts") - F.expr(HOUR)).alias("ref"),
    )
    past = hours_back(requests, context).join(frame.select("series_id", "ts", value), ["series_id", "ts"]).select(
        "request_id", F.lit("target").alias("channel"), "ts", F.col(value).alias("value")
    )
    truth = frame.select("series_id", F.col("ts").alias("target_time"), F.col(value).alias("actual"))
    scores = None
    for model in contenders:
        drawn = profile_forecast(past, levels=model.levels, horizon=horizon, season=model.season)
        judged = drawn.join(requests.drop("ref"), "request_id").join(truth, ["series_id", "target_time"])
        steps = score_steps(
            judged, ["request_id", "series_id", "place", "target_time"],
            low=model.low, high=model.high, alpha=model.alpha,
        )
        part = steps.groupBy("series_id", "place").agg(
            F.avg("error").alias("mae"), F.avg("crps").alias("crps"), F.avg("interval").alias("interval_score")
        ).withColumn("model", F.lit(model.name))
        scores = part if scores is None else scores.unionByName(part)
    return scores.select("series_id", "place", "model", "mae", "crps", "interval_score")
