import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import utc
from hindcast.functions import scalars
from hindcast.functions.student_t import expand_quantiles, t_quantile
from hindcast.operators import metrics, quality, reshape, selection
from hindcast.schemas import CHANNELS, QUANTILES

SERIES = "series_id string, ts timestamp, value double"


def test_spaced_top_is_greedy(spark):
    rng = random.Random(4)
    rows = [(s, pd.Timestamp("2026-01-01") + pd.Timedelta(hours=i), i, float(rng.randrange(40))) for s in "abc" for i in range(300)]
    scored = spark.createDataFrame([(s, t.to_pydatetime(), i, v) for s, t, i, v in rows], "series_id string, ts timestamp, start bigint, score double")
    for count, width in ((5, 24), (3, 7), (4, 96)):
        got = {}
        for r in selection.spaced_top(scored, count, width).orderBy("series_id", "place").collect():
            got.setdefault(r.series_id, []).append((r.start, r.score))
        for s in "abc":
            kept = []
            for _, _, i, v in sorted((r for r in rows if r[0] == s), key=lambda r: (-r[3], r[2])):
                if len(kept) < count and all(abs(i - k) >= width for k, _ in kept):
                    kept.append((i, v))
            assert got[s] == kept


def test_volatility_bounds(spark):
    n = 1120
    values = np.random.default_rng(0).normal(14.5, 1.0, size=n)
    times = pd.date_range("2026-01-01", periods=n, freq="1h")
    df = spark.createDataFrame([("a", t.to_pydatetime(), float(v)) for t, v in zip(times, values)], SERIES)
    rows = selection.volatility_scores(df, "value", 24, margin=96).orderBy("start").collect()
    assert [rows[0].start, rows[-1].start] == [1000, n - 98]
    assert rows[0].score == pytest.approx(np.var(values[1000:1024]))
    trend = selection.volatility_scores(df, "value", 96, trend=True, mean_between=(13, 16)).orderBy("start").first()
    assert trend.score == pytest.approx(np.var(values[1000:1096]) * abs(values[1000] - values[1095]))
    assert selection.volatility_scores(df, "value", 96, trend=True, mean_between=(0, 1)).isEmpty()


def brute_peaks(x, distance, prominence):
    tops = []
    for i in range(1, len(x) - 1):
        lo, hi = i, i
        while lo > 0 and x[lo - 1] == x[i]:
            lo -= 1
        while hi < len(x) - 1 and x[hi + 1] == x[i]:
            hi += 1
        if lo > 0 and hi < len(x) - 1 and x[lo - 1] < x[i] > x[hi + 1] and (lo + hi) // 2 == i:
            tops.append(i)
    kept = []
    for i in sorted(tops, key=lambda i: (-x[i], -i)):
        if all(abs(i - k) >= distance for k in kept):
            kept.append(i)
    out = []
    for i in sorted(kept):
        left = i
        while left > 0 and x[left - 1] <= x[i]:
            left -= 1
        right = i
        while right < len(x) - 1 and x[right + 1] <= x[i]:
            right += 1
        if x[i] - max(min(x[left:i + 1]), min(x[i:right + 1])) >= prominence:
            out.append(i)
    return out


def test_peaks_match_brute_force(spark):
    rng = np.random.default_rng(9)
    curves = [np.round(rng.normal(size=rng.integers(1, 60)), 1) for _ in range(300)]
    rows = [("a", k, i, float(v)) for k, x in enumerate(curves) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "series_id string, reference_time long, target_time long, value double")
    found = selection.find_peaks(df, "value", distance=5, prominence=0.5)
    assert "Python" not in found._jdf.queryExecution().toString()
    got = {}
    for row in found.collect():
        got.setdefault(row.reference_time, []).append(row.position)
    for k, x in enumerate(curves):
        assert sorted(got.get(k, [])) == brute_peaks(list(x), 5, 0.5)


def test_peaks_per_forecast(spark):
    start = utc("2026-05-01 00:00")
    wave = [min(i % 24, 24 - i % 24) / 4 for i in range(96)]
    rows = [("a", start, start + pd.Timedelta(hours=i), float(v)) for i, v in enumerate(wave)]
    df = spark.createDataFrame(rows, "series_id string, reference_time timestamp, target_time timestamp, value double")
    found = selection.find_peaks(df, "value").orderBy("position").collect()
    assert [r.position for r in found] == [12, 36, 60, 84] and [r.prominence for r in found] == [3.0, 3.0, 3.0, 2.75]
    note = spark.range(1).select(scalars.peak_label(F.lit(15.26), F.lit(start.replace(tzinfo=None))).alias("n")).first().n
    assert note == "Max: 15.3°C\n00:00"


# Published two-sided and one-sided critical values of Student's t.
@pytest.mark.parametrize("q,freedom,expected", [
    (0.975, 1, 12.7062), (0.975, 2, 4.30265), (0.95, 5, 2.01505), (0.995, 10, 3.16927), (0.99, 30, 2.45726), (0.975, 120, 1.97993),
])
def test_published_t_values(q, freedom, expected):
    assert t_quantile(q, freedom, 0.0) == pytest.approx(expected, abs=2e-5)
    assert t_quantile(1 - q, freedom, 0.0) == pytest.approx(-expected, abs=2e-5)
    assert t_quantile([0.0, 0.5, 1.0], freedom).tolist() == [-np.inf, 0.0, np.inf]


def test_expanded_quantiles(spark):
    df = spark.createDataFrame([(0.3, 0.1, -1.0, 10.0, 2.0), (0.3, 0.1, -1.0, 10.0, 0.0)], "a double, b double, c double, location double, scale double")
    rows = expand_quantiles(df, QUANTILES, raw_freedom="a", raw_loc="b", raw_scale="c").orderBy("scale", "q").collect()
    assert len(rows) == 14
    width, freedom = np.log1p(np.exp(-1.0)) + 1e-6, np.log1p(np.exp(0.3)) + 2
    assert rows[-1].value == pytest.approx(10 + 2 * (0.1 + width * t_quantile(0.99, freedom)), rel=1e-9)
    assert [r.value for r in rows[7:]] == sorted(r.value for r in rows[7:])
    assert rows[0].value == pytest.approx(10 + 1e-6 * (0.1 + width * t_quantile(0.01, freedom)), rel=1e-12)


def quantile_rows(spark, table, truth):
    rows = [("a", utc("2026-01-01 00:00"), utc(f"2026-01-01 0{t}:00"), truth[t], "wassertemp", q, v) for t, levels in enumerate(table) for q, v in levels.items()]
    return spark.createDataFrame(rows, "series_id string, reference_time timestamp, target_time timestamp, actual double, channel string, q double, value double")


def test_scores_match_loops(spark):
    rng = np.random.default_rng(6)
    levels = (0.1, 0.3, 0.5, 0.9)
    table = [dict(zip(levels, np.sort(rng.normal(size=4)).tolist())) for _ in range(6)]
    table[1][0.3] = None
    table[2][0.9] = float("nan")
    table[3] = dict.fromkeys(levels)
    table[4] = {0.1: None, 0.3: None, 0.5: 0.2, 0.9: None}
    truth = rng.normal(size=6).tolist()
    trapezoid, midpoint = [], []
    for t, row in enumerate(table):
        known = [(q, v) for q, v in row.items() if v is not None and not np.isnan(v)]
        loss = [2 * ((truth[t] - v) * q if truth[t] >= v else (v - truth[t]) * (1 - q)) for q, v in known]
        if known:
            trapezoid.append(sum((loss[i] + loss[i - 1]) / 2 * (known[i][0] - known[i - 1][0]) for i in range(1, len(known))))
    steps = metrics.crps_steps(quantile_rows(spark, table, truth)).orderBy("target_time").collect()
    assert [r.crps for r in steps] == pytest.approx(trapezoid)
    whole = [table[0], table[5]]
    for row, y in zip(whole, (truth[0], truth[1])):
        q, v = list(row), list(row.values())
        total = 0.0
        for i in range(1, 4):
            p = (q[i] + q[i - 1]) / 2
            total += (p * p if y < (v[i] + v[i - 1]) / 2 else (1 - p) ** 2) * (v[i] - v[i - 1])
        midpoint.append(total)
    steps = metrics.crps_midpoint_steps(quantile_rows(spark, whole, truth)).orderBy("target_time").collect()
    assert [r.crps for r in steps] == pytest.approx(midpoint)


def test_interval_score_and_means(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (3.0, 2.0, 4.0), (5.0, 2.0, 4.0), (1.0, None, 4.0)], "y double, l double, u double")
    score = metrics.interval_score(F.col("y"), F.col("l"), F.col("u"), 0.5)
    assert [r.s for r in df.select(score.alias("s")).collect()] == [6.0, 2.0, 6.0, None]
    scores = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0)], "k string, mae double")
    assert metrics.mean_scores(scores, ["k"], ["mae"]).first().mae == 2.0


def test_gates(spark):
    good = [{q: 10 + q for q in QUANTILES} for _ in range(3)]
    rows = quantile_rows(spark, good, [10.5] * 3)
    assert all(r.passed for r in quality.range_gate(rows).collect())
    hot = quantile_rows(spark, good[:2] + [{q: 300.0 for q in QUANTILES}], [1.0] * 3)
    assert not any(r.passed for r in quality.range_gate(hot).collect())
    with pytest.raises(quality.GateFailed, match="7 failed"):
        quality.enforce(quality.range_gate(hot), "ranges")
    missing = quantile_rows(spark, [{0.5: None}, {0.5: 1.0}], [1.0] * 2)
    row = quality.range_gate(missing).first()
    assert row.missing == 1 and not row.passed

    keys = ["series_id", "reference_time"]
    shaped = rows.withColumn("last_input", F.col("target_time") - F.expr("interval 1 hour"))
    shaped = shaped.withColumn("last_input", F.lit(utc("2025-12-31 23:00")))
    assert quality.shape_gate(shaped, keys=keys, last_input="last_input", horizon=3).first().passed
    assert not quality.shape_gate(shaped, keys=keys, last_input="last_input", horizon=4).first().passed
    crossed = quality.shape_gate(quantile_rows(spark, [{0.1: 2.0, 0.5: 1.0}], [1.0]), keys=keys, horizon=1).first()
    assert crossed.crossings == 1 and not crossed.passed

    actuals = spark.createDataFrame([("a", utc("2026-01-01 00:00"), 10.5), ("a", utc("2026-01-01 01:00"), 99.0), ("a", utc("2026-01-01 02:00"), None)],
                                    "series_id string, ts timestamp, actual double")
    leaks = quality.leak_gate(rows, actuals).first()
    assert leaks.leaked == 2 and not leaks.passed
    bands = rows.groupBy("series_id", "target_time").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    share = quality.coverage_gate(bands, actuals, keys=["series_id"]).first()
    assert share.coverage == 0.5 and not share.passed
    none = quality.coverage_gate(bands, actuals.limit(0), keys=["series_id"]).first()
    assert none.coverage is None and none.passed


def test_wide_and_long(spark):
    day = utc("2026-01-01 00:00")
    wide = spark.createDataFrame([("a", day, 1.0, None, 3.0)], f"series_id string, date timestamp, {', '.join(f'{c} double' for c in CHANNELS)}")
    long = reshape.to_long(wide)
    assert [(r.cols, r.cols_ord, r.data) for r in long.orderBy("cols_ord").collect()] == [
        (CHANNELS[0], 1, 1.0), (CHANNELS[1], 2, None), (CHANNELS[2], 3, 3.0)]
    assert reshape.to_wide(long).collect() == wide.collect()
    with pytest.raises(Exception, match="duplicate channel rows"):
        reshape.to_wide(long.union(long)).collect()
    with pytest.raises(ValueError, match="missing required channels"):
        reshape.require_channels(long.where(F.col("cols") != CHANNELS[1]))


def test_canonical_weather_prefers_processed_names_per_snapshot(spark):
    rows = [("a", 1, 1, 1.0, 10.0, 1000.0, None), ("a", 1, 1, 2.0, None, 1001.0, None), ("a", 2, 1, 3.0, None, 1002.0, 902.0)]
    names = "series_id string, anchor int, fetched_at int, temperature double, lufttemperatur_c double, pressure_msl double, pressure double"
    out = reshape.canonical_weather(spark.createDataFrame(rows, names)).orderBy("anchor", "pressure").collect()
    assert [(r.lufttemperatur_c, r.pressure) for r in out] == [(10.0, 1000.0), (None, 1001.0), (3.0, 902.0)]
    with pytest.raises(ValueError, match="neither"):
        reshape.canonical_weather(spark.createDataFrame(rows, names).drop("temperature", "lufttemperatur_c"))


def test_text_and_names(spark):
    df = spark.createDataFrame([("live", "wassertemp_q0.05"), ("oracle", "x"), ("odd", "airtemp_96_q0.5")], "kind string, name string")
    rows = df.select(
        scalars.kind_rank(F.col("kind")).alias("rank"), scalars.backtest_label(F.lit(96), F.col("kind")).alias("label"),
        scalars.name_channel(F.col("name")).alias("channel"), scalars.name_level(F.col("name")).alias("q"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (2, "Backtest -96h (live)", "wassertemp", 0.05), (0, "Backtest -96h (oracle, perfect weather)", "", None),
        (-1, "Backtest -96h (odd)", "airtemp_96", 0.5)]
    numbers = spark.createDataFrame([(0.125,), (0.135,), (2.675,), (-0.125,)], "x double").select(scalars.round_half_even(F.col("x")).alias("y")).collect()
    assert [r.y for r in numbers] == list(np.round([0.125, 0.135, 2.675, -0.125], 2))


@pytest.mark.parametrize("freedom,expected", [
    (2.1, -6.530822), (5.0, -3.364930), (150.0, -2.351457), (199.9, -2.345242), (200.0, -2.345137), (500.0, -2.333829), (1e3, -2.330083),
    (1e5, -2.326385), (1e6, -2.326352),
])
def test_t_quantile_over_all_freedoms(freedom, expected):
    assert float(t_quantile(0.01, freedom, 0.0)) == pytest.approx(expected, abs=2e-4)


def test_one_decimal_rounds_the_exact_value(spark):
    rng = random.Random(4)
    values = [88.25, 88.75, 0.15, 0.25, 15.15, 0.05, 9.95, 9.96, -0.04, -2.25, 0.0, 1e12 + 0.25, 2.0 ** 60, -15.26]
    values += [round(rng.uniform(-40, 40), rng.choice([2, 3, 5, 17])) for _ in range(2000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", scalars.one_decimal(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [f"{r.v:.1f}" for r in got]
    assert spark.range(1).select(scalars.one_decimal(F.lit(None).cast("double")).alias("t")).first().t is None
