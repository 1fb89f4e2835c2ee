"""Joint covariate fits at every hour as the origin, from moments that neighbouring origins share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.operators.backtests import CONFIGURATIONS, Configuration
from hindcast.operators.blocks import framed, hour_number

PHASES = 24
DAYS = 21
STEPS = (1, 24, 96)
LEAST_PIVOT = 1e-9  # share of a covariate's own spread that the ones before it must leave


def _moment(i: str, j: str) -> str:
    return f"_w_{i}_{j}" if i <= j else f"_w_{j}_{i}"


def rolling_moments(frame: DataFrame, target: str, covariates: Sequence[str], *, days: int = DAYS,
                    ahead: Sequence[int] = (), keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Moments of the last ``days`` days at every row of a gap-free hourly frame.

    The rows of one hour of the day among the last ``days`` days give a mean and spreads around it; the last 24 rows hold
    these for all hours of the day, and the sum of their spreads is that of the whole context. So a row looks at
    ``days + 24`` rows and not at ``days * 24``, and each spread is taken around a mean, without differences of large sums.

    Adds ``_rows`` (rows in the context), ``_n`` (complete ones; only these count), ``_w_<i>_<j>`` for ``y`` and
    ``x0``, ``x1`` and so on, and for each entry of ``ahead`` the means ``_m<step>_<i>`` of that step's hour of the day with
    the values ``_a<step>_<i>`` there.
    """
    keys = list(keys)
    names = {"y": target} | {f"x{i}": c for i, c in enumerate(covariates)}
    whole = F.lit(True)
    for c in names.values():
        whole = whole & F.col(c).isNotNull()
    hour = hour_number(F.col("ts"))
    numbered = frame.select(
        *keys, "ts", hour.alias("_hour"), F.floor(hour / PHASES).alias("_day"), F.pmod(hour, F.lit(PHASES)).alias("_phase"),
        *[F.col(c).cast("double").alias(f"_{i}") for i, c in names.items()],
        *[F.when(whole, F.col(c).cast("double")).alias(f"_k_{i}") for i, c in names.items()],
    )
    pairs = [(i, j) for i in names for j in names if i <= j]

    def season(w) -> dict[str, Column]:
        w = w.rowsBetween(1 - days, 0)
        known = F.count("_k_y").over(w)
        return {
            "_s_rows": F.count(F.lit(1)).over(w), "_s_n": known,
            **{f"_s_{i}": F.avg(f"_k_{i}").over(w) for i in names},
            **{f"_s{_moment(i, j)}": F.coalesce(F.covar_pop(f"_k_{i}", f"_k_{j}").over(w) * known, F.lit(0.0)) for i, j in pairs},
        }

    def context(w) -> dict[str, Column]:
        day = w.rowsBetween(1 - PHASES, 0)
        out = {"_rows": F.sum("_s_rows").over(day), "_n": F.sum("_s_n").over(day)}
        out |= {_moment(i, j): F.sum(f"_s{_moment(i, j)}").over(day) for i, j in pairs}
        for step in ahead:
            back = -step % PHASES  # the last row of the context with the hour of the day of that step
            out |= {f"_m{step}_{i}": F.lag(f"_s_{i}", back).over(w) for i in names}
            out |= {f"_a{step}_{i}": F.lead(f"_{i}", step).over(w) for i in names}
        return out

    seasons = framed(numbered, "_day", season, before=days - 1, keys=[*keys, "_phase"])
    return framed(seasons, "_hour", context, before=PHASES - 1, after=max(ahead, default=0), keys=keys)


def with_slopes(moments: DataFrame, xs: Sequence[str], out: str) -> DataFrame:
    """Add the joint least-squares slope ``<out>_<x>`` of ``y`` on every ``x``, by elimination in the order given.

    A covariate that is constant, or that the ones before it explain, has slope 0.
    """
    columns, scratch = [*xs, "y"], []

    def cell(i: str, j: str) -> str:
        return f"_{out}_cell_{i}_{j}"

    df = moments.select("*", *[F.col(_moment(i, j)).alias(cell(i, j)) for i in xs for j in columns])
    for k, x in enumerate(xs):
        pivot = F.col(cell(x, x))
        df = df.withColumn(
            f"_{out}_inverse_{x}", F.when(pivot > LEAST_PIVOT * F.col(_moment(x, x)), 1 / pivot).otherwise(F.lit(0.0)))
        factors = {i: F.col(cell(i, x)) * F.col(f"_{out}_inverse_{x}") for i in xs[k + 1:]}
        left = {cell(i, j): F.col(cell(i, j)) - f * F.col(cell(x, j)) for i, f in factors.items() for j in columns[k + 1:]}
        df = df.withColumns(left) if left else df
        scratch += [f"_{out}_inverse_{x}", *[cell(x, j) for j in columns]]
    for k in reversed(range(len(xs))):
        rest = F.col(cell(xs[k], "y"))
        for j in xs[k + 1:]:
            rest = rest - F.col(cell(xs[k], j)) * F.col(f"{out}_{j}")
        df = df.withColumn(f"{out}_{xs[k]}", rest * F.col(f"_{out}_inverse_{xs[k]}"))
    return df.drop(*scratch)


def rolling_origin_scores(frame: DataFrame, *, configurations: Sequence[Configuration] = CONFIGURATIONS,
                          steps: Sequence[int] = STEPS, days: int = DAYS) -> DataFrame:
    """Origins, mean absolute and root mean square error per series, configuration and step, with every hour an origin.

    ``frame`` is hourly and gap-free: ``series_id, ts, target, air, other``; unknown values are null. A forecast is the mean
    of its hour of the (UTC) day over the last ``days`` days plus the joint effect of the configuration's covariates; one
    not known ahead keeps its last value. An hour is an origin of a step if its series has ``days`` whole days of rows up
    to it and the step's value and forecast are known.
    """
    names = {"air": "x0", "other": "x1"}
    fitted = rolling_moments(frame, "target", list(names), days=days, ahead=steps).where(
        (F.col("_rows") == days * PHASES) & (F.col("_n") > 0))
    used = {c: tuple(x for n, x in names.items() if getattr(c, n)) for c in configurations}
    sets = {xs: f"_b{i}" for i, xs in enumerate(sorted(set(used.values()))) if xs}
    for xs, out in sets.items():
        fitted = with_slopes(fitted, xs, out)

    def missed(c: Configuration, step: int) -> Column:
        drawn = F.col(f"_m{step}_y")
        for x in used[c]:
            ahead = c.air_ahead and x == names["air"]
            seen = F.col(f"_a{step}_{x}") if ahead else F.col(f"_{x}")
            drawn = drawn + F.col(f"{sets[used[c]]}_{x}") * (seen - F.col(f"_m{step}_{x}"))
        return F.col(f"_a{step}_y") - drawn

    cases = F.array(*[
        F.struct(F.lit(c.name).alias("configuration"), F.lit(s).alias("step"), missed(c, s).alias("miss"))
        for c in configurations for s in steps
    ])
    return fitted.select("series_id", F.inline(cases)).where(F.col("miss").isNotNull()).groupBy(
        "series_id", "configuration", "step"
    ).agg(
        F.count(F.lit(1)).alias("origins"), F.avg(F.abs("miss")).alias("mae"), F.sqrt(F.avg(F.col("miss") ** 2)).alias("rmse"),
    )
