"""Model input assembly and batch forecasts for many series and origins at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.student_t import t_quantile
from hindcast.functions.zones import to_local
from hindcast.operators.blocks import BLOCK_SECONDS, running, with_neighbours
from hindcast.operators.reshape import to_long
from hindcast.operators.timeseries import filled, hours_back, lead_rows, linear_between
from hindcast.schemas import (
    CHANNELS, CONTEXT_ROWS, COVARIATE_LEAD, FORECASTER_OUTPUT, HORIZON, LOCAL_ZONE, QUANTILES,
)

WATER, AIR_AHEAD, PRESSURE_AHEAD = CHANNELS
PROFILE_FREEDOM = 5.0
HOUR = "interval 1 hour"


def merged_hours(gauge: DataFrame, weather: DataFrame) -> DataFrame:
    """Gauge and weather on one time axis: every time that either side knows."""
    left = gauge.where(F.col("ts").isNotNull()).select("series_id", "ts", "value", F.lit(1).alias("gauged"))
    right = weather.where(F.col("ts").isNotNull()).select("series_id", "ts", "airtemp", "pressure")
    return left.join(right, ["series_id", "ts"], "full_outer")


def known_hours(gauge: DataFrame, weather: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    return with_neighbours(
        merged_hours(gauge, weather), ("value", "airtemp", "pressure", "gauged"), block_seconds=block_seconds
    )


def assemble(gauge: DataFrame, weather: DataFrame, *, lead: int = COVARIATE_LEAD,
             block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """The wide model input ``(series_id, date, channels...)``.

    Water is filled up to the last gauge row and stays null after it. Weather is filled throughout and then brought
    forward by ``lead`` rows, so that each row sees the weather expected that far ahead.
    """
    return assemble_known(known_hours(gauge, weather, block_seconds), lead)


def assemble_known(known: DataFrame, lead: int = COVARIATE_LEAD) -> DataFrame:
    """The same from readings whose neighbours are known already."""
    rows = known.select(
        "series_id", "ts", "_rn",
        F.when(F.col("_next_gauged").isNotNull(), filled("value")).alias(WATER),
        filled("airtemp").alias("airtemp"),
        filled("pressure").alias("pressure"),
    )
    led = lead_rows(rows, {"airtemp": AIR_AHEAD, "pressure": PRESSURE_AHEAD}, lead)
    return led.select("series_id", F.col("ts").alias("date"), *CHANNELS)


def assemble_long(gauge: DataFrame, weather: DataFrame, **kwargs) -> DataFrame:
    return to_long(assemble(gauge, weather, **kwargs))


def _whole(rows: DataFrame, expected: int, short: str) -> DataFrame:
    """Require ``expected`` context rows per request: fail the job, or skip the request."""
    if short not in ("error", "skip"):
        raise ValueError("short must be 'error' or 'skip'")
    # A request holds at most ``expected`` rows here, so the window stays that small.
    counted = rows.withColumn("_have", F.count(F.lit(1)).over(Window.partitionBy("request_id")))
    enough = F.col("_have") == expected
    if short == "error":
        text = F.format_string(f"not enough data: {expected} regular rows are required, %d given", "_have")
        enough = F.when(enough, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return counted.where(enough).drop("_have")


def _no_gaps(rows: DataFrame) -> DataFrame:
    """Fill what is still null inside a context, forward and then backward."""
    ahead, back = running(["request_id"], "ts"), running(["request_id"], F.desc("ts"))
    return rows.select(
        "request_id", "ts",
        *[F.coalesce(F.last(c, True).over(ahead), F.last(c, True).over(back)).alias(c) for c in CHANNELS],
    )


def context_rows(wide: DataFrame, requests: DataFrame, rows: int = CONTEXT_ROWS, *, short: str = "error"
                 ) -> DataFrame:
    """The last ``rows`` hourly rows up to each request's reference time, truncated there and free of nulls.

    The work is ``rows`` per request, less than the forecast it leads to, and is spread by ``(series, hour)``.
    """
    asked = hours_back(requests.select("request_id", "series_id", "ref"), rows)
    found = asked.join(wide.withColumnRenamed("date", "ts"), ["series_id", "ts"])
    return _no_gaps(_whole(found.select("request_id", "ts", *CHANNELS), rows, short))


def context_status(wide: DataFrame, requests: DataFrame, rows: int = CONTEXT_ROWS) -> DataFrame:
    """Every request with the context rows it has and whether they suffice; what ``short="skip"`` leaves out shows here."""
    asked = requests.select("request_id", "series_id", "ref")
    found = hours_back(asked, rows).join(wide.select("series_id", F.col("date").alias("ts")), ["series_id", "ts"])
    held = found.groupBy("request_id").agg(F.count(F.lit(1)).alias("have"))
    have = F.coalesce("have", F.lit(0))
    return asked.join(held, "request_id", "left").select("request_id", "series_id", have.alias("have"), (have >= rows).alias("complete"))


def replay_rows(hits: DataFrame, snapshot_hours: DataFrame, known: DataFrame, rows: int = CONTEXT_ROWS, *,
                lead: int = COVARIATE_LEAD, short: str = "error") -> DataFrame:
    """Contexts as a run at each reference time would have seen them.

    Readings up to the reference time come from ``known`` (see :func:`known_hours`), weather after it from the
    snapshot each request was matched with: ``snapshot_hours`` has ``request_id, ref, ts, airtemp, pressure``.
    Only the ``rows`` wanted and the snapshot are touched; a fill that starts before them uses the last known
    reading that ``known`` carries along.
    """
    asked = hours_back(hits.select("request_id", "series_id", "ref"), rows)
    past = _whole(
        asked.join(known.drop("_rn", "_rows"), ["series_id", "ts"]), rows, short
    ).select(
        "request_id", "ts", "ref", "value", "airtemp", "pressure", "_prev_value", "_prev_airtemp", "_prev_pressure",
    )
    ahead = snapshot_hours.where(F.col("ts") > F.col("ref")).groupBy("request_id", "ref", "ts").agg(
        F.max("airtemp").alias("airtemp"), F.max("pressure").alias("pressure")
    )
    whole = past.unionByName(ahead, allowMissingColumns=True)

    # One request: its context and one weather snapshot.
    forward, backward = running(["request_id"], "ts"), running(["request_id"], F.desc("ts"))

    def read(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct("ts", F.col(c).alias("v")))

    names = ("value", "airtemp", "pressure")
    near = whole.select(
        "*",
        *[F.last(F.coalesce(read(c), F.col(f"_prev_{c}")), True).over(forward).alias(f"_before_{c}") for c in names],
        *[F.last(read(c), True).over(backward).alias(f"_after_{c}") for c in names],
    )

    def fill(c: str) -> Column:
        before, after = F.col(f"_before_{c}"), F.col(f"_after_{c}")
        return F.coalesce(linear_between(F.col("ts"), F.col(c), before, after), after.v)

    order = Window.partitionBy("request_id").orderBy("ts")
    complete = near.select("request_id", "ts", "ref", *[fill(c).alias(c) for c in names])
    led = complete.select(
        "request_id", "ts", "ref", F.col("value").alias(WATER),
        F.lead("airtemp", lead).over(order).alias(AIR_AHEAD),
        F.lead("pressure", lead).over(order).alias(PRESSURE_AHEAD),
    )
    return _no_gaps(led.where(F.col("ts") <= F.col("ref")).select("request_id", "ts", *CHANNELS))


@lru_cache(maxsize=None)
def t_steps(levels: tuple[float, ...], freedom: float = PROFILE_FREEDOM) -> tuple[tuple[float, float], ...]:
    """(level, standard Student-t quantile) pairs."""
    return tuple((q, float(t)) for q, t in zip(levels, t_quantile(list(levels), freedom, 0.0)))


def local_hour(ts: Column) -> Column:
    return F.hour(to_local(ts, LOCAL_ZONE))


def level_structs(levels: Sequence[float]) -> Column:
    return F.array(*[
        F.struct(F.lit(q).alias("q"), F.lit(t).alias("t")) for q, t in t_steps(tuple(float(q) for q in levels))
    ])


def profile_forecast(context: DataFrame, *, levels: Sequence[float] = QUANTILES, horizon: int = HORIZON,
                     season: Callable[[Column], Column] = local_hour, step: str = HOUR,
                     keys: Sequence[str] = ("request_id", "channel")) -> DataFrame:
    """Default forecaster over long contexts ``(request_id, channel, ts, value)``.

    Location is the mean of the context at the same season (local hour), scale the root mean square of what that
    leaves, and the quantiles are Student-t with five degrees of freedom.
    """
    keys = list(keys)
    seasons = context.groupBy(*keys, season(F.col("ts")).alias("_season")).agg(
        F.avg("value").alias("_loc"), F.var_pop("value").alias("_var"), F.count("value").alias("_n"),
        F.max("ts").alias("_last"),
    )
    fitted = seasons.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_season", "_loc"))).alias("_profile"),
        F.sqrt(F.sum(F.col("_var") * F.col("_n")) / F.sum("_n")).alias("_scale"),
        F.max("_last").alias("_last"),
    )
    steps = fitted.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_step"))
    timed = steps.withColumn("target_time", F.col("_last") + F.expr(step) * F.col("_step"))
    located = timed.withColumn("_loc", F.try_element_at("_profile", season(F.col("target_time"))))
    return located.select(*keys, "target_time", "_loc", "_scale", F.explode(level_structs(levels)).alias("_l")).select(
        *keys, "target_time", F.col("_l.q").alias("q"), (F.col("_loc") + F.col("_scale") * F.col("_l.t")).alias("value")
    )


def long_context(context: DataFrame) -> DataFrame:
    return context.unpivot(["request_id", "ts"], list(CHANNELS), "channel", "value")


@dataclass(frozen=True)
class Plugged:
    """A model that answers many contexts in one call.

    ``load`` runs once per worker process and returns the model: a function from a pandas frame of up to ``contexts``
    whole contexts (``request_id, ts`` and the channels, each request's rows together and in time order) to rows of the
    forecaster layout. ``name`` tells loaded models of one worker apart, so a new version needs a new name.
    """

    name: str
    load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]
    contexts: int = 256


_LOADED: dict[str, Callable[[pd.DataFrame], pd.DataFrame]] = {}


def loaded(plug: Plugged) -> Callable[[pd.DataFrame], pd.DataFrame]:
    if plug.name not in _LOADED:
        _LOADED[plug.name] = plug.load()
    return _LOADED[plug.name]


def packs(batches: Iterator[pd.DataFrame], contexts: int) -> Iterator[pd.DataFrame]:
    """Whole requests in packs of ``contexts`` (the last one smaller), from batches in which a request's rows follow each other.

    At most one pack and one batch are held at a time.
    """
    rest = None
    for batch in batches:
        if batch.empty:
            continue
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        pack = ((rest["request_id"] != rest["request_id"].shift()).cumsum() - 1) // contexts
        # The last pack may go on in the next batch.
        for _, whole in rest[pack < pack.iloc[-1]].groupby(pack, sort=True):
            yield whole.reset_index(drop=True)
        rest = rest[pack == pack.iloc[-1]]
    if rest is not None:
        yield rest.reset_index(drop=True)


def plugged_forecast(context: DataFrame, plug: Plugged) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pack in packs(batches, plug.contexts):
            yield loaded(plug)(pack)[FORECASTER_OUTPUT.names]

    together = context.select("request_id", "ts", *CHANNELS).repartition("request_id").sortWithinPartitions("request_id", "ts")
    return together.mapInPandas(run, FORECASTER_OUTPUT)


def answer_requests(wide: DataFrame, requests: DataFrame, forecaster: Callable | Plugged | None = None, *,
                    rows: int = CONTEXT_ROWS, horizon: int = HORIZON) -> DataFrame:
    """Every request: its forecast with status ``ok``, or a single row that says why it has none.

    A request needs ``rows`` hourly rows up to its reference time (else ``short``) and a reading of every channel in them
    (else ``no <channel>``), so one bad series does not stop the others.
    """
    asked = hours_back(requests.select("request_id", "series_id", "ref"), rows)
    hours = wide.select("series_id", F.col("date").alias("ts"), *CHANNELS, F.lit(1).alias("_hit"))
    # A request has exactly ``rows`` rows here, whether its series knows these hours or not.
    of_request = Window.partitionBy("request_id")
    counts = {f"_{c}": F.count(c).over(of_request) for c in ("_hit", *CHANNELS)}
    counted = asked.join(hours, ["series_id", "ts"], "left").withColumns(counts)
    status = F.when(F.col("__hit") < rows, "short")
    for c in CHANNELS:
        status = status.when(F.col(f"_{c}") == 0, f"no {c}")
    judged = counted.withColumn("status", status.otherwise("ok"))
    context = _no_gaps(judged.where(F.col("status") == "ok").select("request_id", "ts", *CHANNELS))
    answered = forecast_batch(context, forecaster, horizon=horizon).withColumn("status", F.lit("ok"))
    refused = judged.where(F.col("status") != "ok").dropDuplicates(["request_id"]).select("request_id", "status")
    return answered.unionByName(refused, allowMissingColumns=True)


def forecast_batch(context: DataFrame, forecaster: Callable | Plugged | None = None, *, levels: Sequence[float] = QUANTILES,
                   horizon: int = HORIZON) -> DataFrame:
    """Quantiles ``(request_id, target_time, channel, q, value)`` for every context.

    ``forecaster`` receives one request's context as a pandas frame (``request_id, ts`` and the channels, in time
    order) and returns rows of the same output layout; a :class:`Plugged` model receives many contexts at once. Without
    either, :func:`profile_forecast` is used.
    """
    if isinstance(forecaster, Plugged):
        return plugged_forecast(context, forecaster)
    if forecaster is None:
        return profile_forecast(long_context(context), levels=levels, horizon=horizon).select(
            "request_id", "target_time", "channel", "q", "value"
        )

    def run(pdf):
        return forecaster(pdf.sort_values("ts", ignore_index=True))

    return context.groupBy("request_id").applyInPandas(run, FORECASTER_OUTPUT)
