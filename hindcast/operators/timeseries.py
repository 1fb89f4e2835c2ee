"""Resampling, gap filling, shifting, rolling and decomposition of series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.scalars import named, round_half_even
from hindcast.operators.blocks import BLOCK_SECONDS, Frame, frame_moments, framed, hour_number, touch, with_neighbours
from hindcast.operators.quantiles import exact_quantiles
from hindcast.schemas import COVARIATE_LEAD

KEY = ("series_id",)


def truncate(ts: Column, step: str = "hour") -> Column:
    return F.date_trunc(step, ts)


def on_grid(df: DataFrame, *, keys: Sequence[str] = KEY, ts: str = "ts", step: str = "hour") -> DataFrame:
    """Insert the missing steps of an already aggregated series as null rows."""
    df = df.where(F.col(ts).isNotNull())
    span = df.groupBy(*keys).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"), touch(df))
    steps = F.explode(F.sequence("_from", "_to", F.expr(f"interval 1 {step}"))).alias(ts)
    grid = span.where(F.col("_touch").isNotNull()).select(*keys, steps)
    return grid.join(df, [*keys, ts], "left")


def hourly_first(df: DataFrame, *, value: str = "value", keys: Sequence[str] = KEY, ts: str = "ts",
                 tie: str | None = None) -> DataFrame:
    """First non-null reading of each hour on a gap-free grid; an hour without one is null."""
    order = F.struct(ts, tie) if tie else F.col(ts)
    first = F.min_by(value, F.when(F.col(value).isNotNull(), order)).alias(value)
    hours = df.groupBy(*keys, truncate(F.col(ts)).alias(ts)).agg(first)
    return on_grid(hours, keys=keys, ts=ts)


def hourly_mean(df: DataFrame, *, value: str = "value", keys: Sequence[str] = KEY, ts: str = "ts") -> DataFrame:
    hours = df.groupBy(*keys, truncate(F.col(ts)).alias(ts)).agg(F.avg(value).alias(value))
    return on_grid(hours, keys=keys, ts=ts)


def hourly_weather(df: DataFrame, *, means: Sequence[str], sums: Sequence[str], keys: Sequence[str] = KEY,
                   ts: str = "ts") -> DataFrame:
    """Hourly means and sums rounded to two decimals; an empty hour has null means and zero sums."""
    hours = df.groupBy(*keys, truncate(F.col(ts)).alias(ts)).agg(
        *[F.avg(c).alias(c) for c in means], *[F.sum(c).alias(c) for c in sums]
    )
    return on_grid(hours, keys=keys, ts=ts).select(
        *keys, ts,
        *[round_half_even(F.col(c)).alias(c) for c in means],
        *[round_half_even(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in sums],
    )


def hourly_median(df: DataFrame, *, value: str = "value", keys: Sequence[str] = KEY, ts: str = "ts") -> DataFrame:
    """Exact hourly median on a gap-free grid."""
    hours = df.select(*keys, truncate(F.col(ts)).alias(ts), value)
    # The grid spans all readings, also hours whose readings are all null.
    return on_grid(exact_quantiles(hours, [*keys, ts], value, {value: 0.5}), keys=keys, ts=ts)


def linear_between(ts: Column, value: Column, prev: Column, following: Column) -> Column:
    """Time-weighted blend of the known neighbours; after the last one its value is repeated."""
    here, left, right = F.unix_micros(ts), F.unix_micros(prev.ts), F.unix_micros(following.ts)
    blend = prev.v + (following.v - prev.v) * ((here - left) / (right - left))
    return (
        F.when(value.isNotNull(), value)
        .when(prev.isNull(), F.lit(None))
        .when(following.isNull(), prev.v)
        .otherwise(blend)
    )


def interpolated(c: str, ts: str = "ts") -> Column:
    return linear_between(F.col(ts), F.col(c), F.col(f"_prev_{c}"), F.col(f"_next_{c}"))


def filled(c: str, ts: str = "ts") -> Column:
    """Interpolated, then filled backward at the start of the series."""
    return F.coalesce(interpolated(c, ts), F.col(f"_next_{c}.v"))


def _replaced(df: DataFrame, source: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return source.select(*[columns[c].alias(c) if c in columns else named(c) for c in df.columns])


def interpolate_time(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEY, ts: str = "ts",
                     block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Fill nulls linearly in time; leading nulls stay, trailing nulls repeat the last value."""
    near = with_neighbours(df, columns, keys=keys, ts=ts, block_seconds=block_seconds)
    return _replaced(df, near, {c: interpolated(c, ts) for c in columns})


def fill_both_ways(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEY, ts: str = "ts",
                   block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Repeat the last known value forward, then the first one backward."""
    near = with_neighbours(df, columns, keys=keys, ts=ts, block_seconds=block_seconds)
    return _replaced(df, near, {c: F.coalesce(F.col(f"_prev_{c}.v"), F.col(f"_next_{c}.v")) for c in columns})


def bounded_fill(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEY, ts: str = "ts",
                 block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Fill up to the last real reading of each series and leave everything after it null."""
    near = with_neighbours(df, columns, keys=keys, ts=ts, block_seconds=block_seconds)
    # A row lies at or before the last reading exactly when a reading follows it.
    return _replaced(
        df, near, {c: F.when(F.col(f"_next_{c}").isNotNull(), filled(c, ts)) for c in columns}
    )


def lead_rows(df: DataFrame, columns: dict[str, str], rows: int = COVARIATE_LEAD, *, index: str = "_rn",
              keys: Sequence[str] = KEY) -> DataFrame:
    """Bring the value found ``rows`` rows later to each row; ``columns`` maps source to output name."""
    return framed(
        df, index, lambda w: {out: F.lead(c, rows).over(w) for c, out in columns.items()}, after=rows, keys=keys
    )


def rolling_mean(df: DataFrame, column: str, out: str, rows: int = 720, *, index: str,
                 keys: Sequence[str] = KEY) -> DataFrame:
    """Mean of the last ``rows`` rows, as soon as one of them is known."""
    return frame_moments(df, index, column, {"past": (rows - 1, 0)}, lambda f, w: {out: f["past"].mean}, keys=keys)


def last_known(df: DataFrame, value: str = "value", *, keys: Sequence[str] = KEY, ts: str = "ts") -> DataFrame:
    """Time of the last non-null reading of each series."""
    return df.groupBy(*keys).agg(F.max(F.when(F.col(value).isNotNull(), F.col(ts))).alias("last_ts"))


def decompose(df: DataFrame, column: str, kernels: Sequence[int] = (25,), *, index: str,
              keys: Sequence[str] = KEY) -> DataFrame:
    """Split a gap-free series into ``trend`` and ``seasonal``.

    The trend is a centred moving average whose edges repeat the end values; several kernels are averaged.
    """
    if any(k % 2 == 0 for k in kernels):
        raise ValueError("decomposition kernels must be odd")

    def parts(around: dict[str, Frame], w) -> dict[str, Column]:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

        def trend(kernel: int) -> Column:
            # Only the true ends of a series cut a frame short, and then the chunk's outermost row is the value to repeat.
            frame = around[str(kernel)]
            ends = frame.left * F.first(column).over(whole) + frame.right * F.last(column).over(whole)
            return (frame.total + ends) / kernel

        total = sum((trend(k) for k in kernels[1:]), trend(kernels[0]))
        return {"trend": total / len(kernels)}

    out = frame_moments(df, index, column, {str(k): (k // 2, k // 2) for k in kernels}, parts, keys=keys)
    return out.withColumn("seasonal", F.col(column) - F.col("trend"))


NORM_MODES = ("identity", "subtract_last", "subtract_median")


def norm_statistics(df: DataFrame, column: str, modes: str | Sequence[str], *, keys: Sequence[str] = KEY,
                    order: str = "ts", eps: float = 1e-5) -> DataFrame:
    """mode, location and scale of each series, one row per mode; the median is the lower one of an even count.

    All modes share the aggregates: the mean square around any location is the variance plus the square of the mean's
    distance from it.
    """
    keys, modes = list(keys), [modes] if isinstance(modes, str) else list(modes)
    for mode in modes:
        if mode not in NORM_MODES:
            raise ValueError(f"unknown mode {mode!r}, expected one of {NORM_MODES}")
    aggregates = {
        "_mean": F.avg(column), "_spread": F.var_pop(column), "subtract_last": F.max_by(column, order),
    }
    if "subtract_median" in modes:
        stats = exact_quantiles(df, keys, column, {"subtract_median": 0.5}, lower=True, also=aggregates)
    else:
        stats = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()])

    def of(mode: str) -> Column:
        location = F.lit(0.0) if mode == "identity" else F.col(mode).cast("double")
        away = F.col("_mean") - location
        scale = F.lit(1.0) if mode == "identity" else F.sqrt(F.col("_spread") + away * away + F.lit(eps))
        return F.struct(F.lit(mode).alias("mode"), location.alias("location"), scale.alias("scale"))

    return stats.select(*keys, F.inline(F.array(*map(of, modes))))


def normalise(df: DataFrame, column: str, mode: str | Sequence[str], *, keys: Sequence[str] = KEY, order: str = "ts",
              eps: float = 1e-5, gamma: float = 1.0, beta: float = 0.0) -> DataFrame:
    """Add ``location``, ``scale`` and ``normed``; ``gamma`` and ``beta`` are an optional affine step.

    With a list of modes each row comes once per mode, named in ``mode``.
    """
    stats = norm_statistics(df, column, mode, keys=keys, order=order, eps=eps)
    if isinstance(mode, str):
        stats = stats.drop("mode")
    normed = (F.col(column) - F.col("location")) / F.col("scale") * gamma + beta
    return df.join(stats, list(keys)).withColumn("normed", normed)


def denormalise(df: DataFrame, column: str, out: str, *, gamma: float = 1.0, beta: float = 0.0) -> DataFrame:
    return df.withColumn(out, (F.col(column) - beta) / gamma * F.col("scale") + F.col("location"))


def step_check(df: DataFrame, *, keys: Sequence[str] = KEY, ts: str = "ts",
               block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Smallest and largest step of each series, and whether they agree.

    With unique times a constant step holds exactly when ``(last - first) / (rows - 1)`` divides every offset
    from the first row, which needs aggregates only.
    """
    keys = list(keys)
    micros = F.unix_micros(ts)
    ends = df.groupBy(*keys).agg(
        F.min(micros).alias("_first"), F.max(micros).alias("_last"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct(ts).alias("_distinct"),
    )
    step = F.expr("(_last - _first) div nullif(rows - 1, 0)")
    checked = df.join(ends.withColumn("_step", step), keys)
    off = F.pmod(micros - F.col("_first"), F.col("_step"))
    return checked.groupBy(*keys).agg(
        F.first("rows").alias("rows"),
        F.expr("first(_step) div 1000000").alias("step_seconds"),
        (
            (F.first("rows") > 2)
            & (F.first("_distinct") == F.first("rows"))
            & (F.max(off) == 0)
            & (F.first("_first") + F.first("_step") * (F.first("rows") - 1) == F.first("_last"))
        ).alias("is_regular"),
    )


def require_regular(df: DataFrame, **kwargs) -> DataFrame:
    """Pass a frame through, failing the job when a series has no constant step."""
    keys = list(kwargs.get("keys", KEY))
    verdict = step_check(df, **kwargs).select(
        *keys,
        F.when(F.col("is_regular"), F.lit(True))
        .otherwise(F.raise_error(F.lit("no regular time step: resample the series first")).cast("boolean"))
        .alias("_ok"),
    )
    return df.join(verdict, keys).where("_ok").drop("_ok")


def future_index(df: DataFrame, horizon: int, *, keys: Sequence[str] = KEY, ts: str = "ts",
                 step: str = "interval 1 hour") -> DataFrame:
    """The ``horizon`` times that follow the last one of each series."""
    last = df.groupBy(*keys).agg(F.max(ts).alias("_last"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    return last.select(*keys, "_last", steps).select(
        *keys, "step", (F.col("_last") + F.expr(step) * F.col("step")).alias("target_time")
    )


def rolling_origins(ends: DataFrame, offsets: Sequence[int], *, last: str = "last_ts",
                    keys: Sequence[str] = KEY) -> DataFrame:
    """One origin per series and offset, counted in hours back from the last observation."""
    each = F.explode(F.array(*[F.lit(o) for o in offsets])).alias("offset_hours")
    return ends.where(F.col(last).isNotNull()).select(*keys, last, each).select(
        *keys, "offset_hours", (F.col(last) - F.expr("interval 1 hour") * F.col("offset_hours")).alias("ref")
    )


def hours_back(requests: DataFrame, hours: int, *, ref: str = "ref", out: str = "ts") -> DataFrame:
    """The last ``hours`` grid hours at or before each request's reference time."""
    back = F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("_back")
    return requests.select("*", back).withColumn(
        out, truncate(F.col(ref)) - F.expr("interval 1 hour") * F.col("_back")
    ).drop("_back")


__all__ = [name for name in dir() if not name.startswith("_")]
