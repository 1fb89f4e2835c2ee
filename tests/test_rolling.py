"""Rolling-origin fits against least squares on every context."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hindcast.operators.backtests import CONFIGURATIONS
from hindcast.operators.rolling import rolling_moments, rolling_origin_scores, with_slopes

START = pd.Timestamp("2026-03-20 05:00")  # a clock change lies inside
DAYS = 3


def series(name, n, seed, holes=0.0):
    rng = np.random.default_rng(seed)
    ts = START + pd.to_timedelta(np.arange(n), "h")
    air = 10 + rng.normal(size=n).cumsum() / 5
    other = 950 + 0.5 * air + rng.normal(size=n)
    target = np.sin(ts.hour / 4) + 0.7 * air - 0.2 * other + rng.normal(size=n) / 10
    out = pd.DataFrame({"series_id": name, "ts": ts, "target": target, "air": air, "other": other})
    for c in ("target", "air", "other"):
        out.loc[rng.random(n) < holes, c] = np.nan
    return out


@pytest.fixture(scope="module")
def tables():
    flat = series("flat", 120, 3)
    flat["air"] = 4.0
    twin = series("twin", 120, 4)
    twin["other"] = 2 * twin["air"]
    return {"a": series("a", 150, 1), "holes": series("holes", 150, 2, 0.1), "flat": flat, "twin": twin, "short": series("short", 60, 5)}


def frame(spark, tables):
    rows = pd.concat(tables.values())
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, target double, air double, other double")
    return df.replace(float("nan"), None).repartition(4, "ts")


def brute(past, used):
    """Means by hour of the day, and joint slopes on what is left after them."""
    known = past.dropna(subset=["target", "air", "other"])
    season = known.groupby(known.ts.dt.hour)[["target", "air", "other"]].mean()
    rest = known[["target", "air", "other"]].to_numpy() - season.loc[known.ts.dt.hour].to_numpy()
    kept = [i for i, c in enumerate(used) if np.ptp(known[c]) > 0]
    slopes = np.zeros(len(used))
    if kept:
        x = rest[:, [1 if used[i] == "air" else 2 for i in kept]]
        slopes[kept] = np.linalg.lstsq(x, rest[:, 0], rcond=None)[0]
    return season, slopes


def test_scores_equal_least_squares_at_every_origin(spark, tables):
    steps = (1, 5, 24, 30)
    whole = {k: t for k, t in tables.items() if k != "twin"}
    got = {(r.series_id, r.configuration, r.step): r for r in rolling_origin_scores(frame(spark, whole), steps=steps, days=DAYS).collect()}
    want = {}
    for name, t in whole.items():
        for c in CONFIGURATIONS:
            used = [x for x in ("air", "other") if getattr(c, x)]
            for at in range(24 * DAYS - 1, len(t)):
                season, slopes = brute(t.iloc[at - 24 * DAYS + 1:at + 1], used)
                for step in steps:
                    if at + step >= len(t):
                        continue
                    then, last = t.iloc[at + step], t.iloc[at]
                    if then.ts.hour not in season.index:
                        continue
                    means = season.loc[then.ts.hour]
                    miss = then.target - means.target
                    for x, b in zip(used, slopes):
                        miss -= b * ((then if x == "air" and c.air_ahead else last)[x] - means[x])
                    if not np.isnan(miss):
                        want.setdefault((name, c.name, step), []).append(miss)
    assert set(got) == set(want) and not any(k[0] == "short" for k in got)
    for k, misses in want.items():
        assert got[k].origins == len(misses)
        assert got[k].mae == pytest.approx(np.mean(np.abs(misses)), rel=1e-6)
        assert got[k].rmse == pytest.approx(np.sqrt(np.mean(np.square(misses))), rel=1e-6)


def test_a_covariate_that_another_explains_is_left_out(spark, tables):
    fitted = with_slopes(rolling_moments(frame(spark, {"twin": tables["twin"]}), "target", ["air", "other"], days=DAYS), ["x0", "x1"], "b")
    alone = with_slopes(fitted, ["x0"], "c").where(F.col("_rows") == 24 * DAYS).collect()
    assert len(alone) == 120 - 24 * DAYS + 1
    assert all(r.b_x1 == 0 and r.b_x0 == pytest.approx(r.c_x0) for r in alone)


def test_three_covariates_are_fitted_jointly(spark, tables):
    t = tables["a"].assign(third=np.random.default_rng(9).normal(size=150))
    df = spark.createDataFrame(t)
    moments = rolling_moments(df, "target", ["air", "other", "third"], days=DAYS)
    row = with_slopes(moments, ["x0", "x1", "x2"], "b").orderBy(F.desc("ts")).first()
    past = t.iloc[-24 * DAYS:]
    rest = past[["target", "air", "other", "third"]] - past.groupby(past.ts.dt.hour)[["target", "air", "other", "third"]].transform("mean")
    want = np.linalg.lstsq(rest.iloc[:, 1:].to_numpy(), rest.target.to_numpy(), rcond=None)[0]
    np.testing.assert_allclose([row.b_x0, row.b_x1, row.b_x2], want, rtol=1e-8)


def test_empty_frame(spark):
    empty = spark.createDataFrame([], "series_id string, ts timestamp, target double, air double, other double")
    assert rolling_origin_scores(empty).count() == 0
