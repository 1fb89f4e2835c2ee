import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hindcast.operators import timeseries as ts
from hindcast.operators.blocks import frame_moments, framed, number_rows
from hindcast.operators.quantiles import exact_quantiles

SCHEMA = "series_id string, ts timestamp, value double"


def frame(spark, rows):
    return spark.createDataFrame([(s, pd.Timestamp(t).to_pydatetime(), None if v is None or pd.isna(v) else float(v)) for s, t, v in rows], SCHEMA)


def sample(seed=3, n=400, holes=0.5, freq="37min"):
    rng = np.random.default_rng(seed)
    rows = []
    for s in ("a", "b"):
        times = pd.date_range("2026-02-27", periods=n, freq=freq)
        keep = rng.random(n) > 0.2
        values = np.where(rng.random(n) < holes, np.nan, rng.normal(size=n))
        rows += [(s, t, v) for t, v, k in zip(times, values, keep) if k]
    return pd.DataFrame(rows, columns=["series_id", "ts", "value"])


def back(df, *columns):
    out = df.toPandas().sort_values(["series_id", "ts"]).reset_index(drop=True)
    return out[list(columns)] if columns else out


def by_series(pdf, fn):
    return pd.concat([fn(g.set_index("ts").value) for _, g in pdf.groupby("series_id")]).to_numpy()


@pytest.mark.parametrize("block", [3600, 7200, 86400 * 3, 86400 * 400])
def test_fills_agree_with_pandas_for_any_block(spark, block):
    pdf = sample()
    df = frame(spark, pdf.itertuples(index=False))
    got = back(ts.interpolate_time(df, ["value"], block_seconds=block)).value.to_numpy()
    np.testing.assert_allclose(got, by_series(pdf, lambda s: s.interpolate(method="time")), rtol=1e-12)
    got = back(ts.fill_both_ways(df, ["value"], block_seconds=block)).value.to_numpy()
    np.testing.assert_array_equal(got, by_series(pdf, lambda s: s.ffill().bfill()))
    got = back(ts.bounded_fill(df, ["value"], block_seconds=block)).value.to_numpy()
    np.testing.assert_allclose(
        got, by_series(pdf, lambda s: s.interpolate(method="time").bfill().where(s.index <= s.last_valid_index())), rtol=1e-12
    )


def test_a_series_without_values_stays_null(spark):
    df = frame(spark, [("a", "2026-01-01 00:00", None), ("a", "2026-01-01 01:00", None)])
    for out in (ts.interpolate_time(df, ["value"]), ts.fill_both_ways(df, ["value"]), ts.bounded_fill(df, ["value"])):
        assert [r.value for r in out.collect()] == [None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-9, 9)), min_size=1, max_size=30))
def test_bounded_fill_never_reaches_past_the_last_reading(spark, values):
    times = pd.date_range("2026-01-01", periods=len(values), freq="1h")
    out = back(ts.bounded_fill(frame(spark, [("a", t, v) for t, v in zip(times, values)]), ["value"], block_seconds=7200)).value
    known = [i for i, v in enumerate(values) if v is not None]
    for i, v in enumerate(out):
        assert pd.isna(v) == (not known or i > known[-1])
        if values[i] is not None:
            assert v == values[i]


def test_hourly_resampling(spark):
    pdf = sample(holes=0.3)
    df = frame(spark, pdf.itertuples(index=False))
    np.testing.assert_array_equal(back(ts.hourly_first(df)).value.to_numpy(), by_series(pdf, lambda s: s.resample("1h").first()))
    np.testing.assert_allclose(back(ts.hourly_mean(df)).value.to_numpy(), by_series(pdf, lambda s: s.resample("1h").mean()))
    np.testing.assert_allclose(back(ts.hourly_median(df)).value.to_numpy(), by_series(pdf, lambda s: s.resample("1h").median()))
    both = ts.hourly_weather(df.withColumn("rain", F.col("value")), means=["value"], sums=["rain"])
    np.testing.assert_array_equal(back(both).rain.to_numpy(), by_series(pdf, lambda s: s.resample("1h").sum().round(2)))
    np.testing.assert_array_equal(back(both).value.to_numpy(), by_series(pdf, lambda s: s.resample("1h").mean().round(2)))


@pytest.mark.parametrize("chunk", [16, 50, 8192])
def test_frames_equal_plain_windows(spark, chunk):
    df = number_rows(frame(spark, sample(holes=0.1).itertuples(index=False)), block_seconds=20_000)
    plain = Window.partitionBy("series_id").orderBy("ts")

    def build(w):
        return {"x": F.avg("value").over(w.rowsBetween(-19, 0)), "y": F.lead("value", 7).over(w), "z": F.sum("value").over(w.rowsBetween(-3, 5))}

    got = back(framed(df, "_rn", build, before=19, after=7, chunk_rows=chunk), "x", "y", "z")
    want = back(df.select("*", *[c.alias(n) for n, c in build(plain).items()]), "x", "y", "z")
    pd.testing.assert_frame_equal(got, want)
    assert back(df)._rn.tolist() == back(df.withColumn("n", F.row_number().over(plain))).n.tolist()


@pytest.mark.parametrize("chunk", [16, 8192])
def test_frame_moments_equal_plain_windows(spark, chunk):
    rng = np.random.default_rng(chunk)
    pdf = sample(holes=0.1)
    pdf["value"] = pdf["value"] * 1e3 + 1e6
    odd = rng.random(len(pdf))
    pdf.loc[odd < 0.02, "value"] = np.nan
    pdf.loc[odd > 0.99, "value"] = np.inf
    pdf.loc[(odd > 0.985) & (odd < 0.99), "value"] = -np.inf
    df = number_rows(frame(spark, pdf.itertuples(index=False)), block_seconds=20_000)
    df = df.withColumn("value", F.when(F.col("_rn") % 11 != 0, F.col("value")))
    plain = Window.partitionBy("series_id").orderBy("ts")
    spans = {"past": (19, 0), "around": (5, 5), "ahead": (0, 7)}

    def build(frames, w):
        return {f"{name}_{part}": getattr(frames[name], part) for name in spans for part in ("count", "mean", "total", "variance")}

    got = back(frame_moments(df, "_rn", "value", spans, build, chunk_rows=chunk))
    made = {}
    for name, (before, after) in spans.items():
        w = plain.rowsBetween(-before, after)
        made |= {f"{name}_count": F.count("value").over(w), f"{name}_mean": F.avg("value").over(w), f"{name}_total": F.sum("value").over(w),
                 f"{name}_variance": F.var_pop("value").over(w)}
    want = back(df.select("*", *[c.alias(n) for n, c in made.items()]))
    for name in made:
        np.testing.assert_allclose(got[name].to_numpy(float), want[name].to_numpy(float), rtol=1e-9, atol=1e-6)


def test_decomposition(spark):
    n = 60
    values = np.random.default_rng(5).normal(size=n)
    df = frame(spark, [("a", t, v) for t, v in zip(pd.date_range("2026-01-01", periods=n, freq="1h"), values)])
    df = df.withColumn("hour", F.floor(F.unix_micros("ts") / F.lit(3_600_000_000)))

    def trend(k):
        padded = np.concatenate([np.repeat(values[0], k // 2), values, np.repeat(values[-1], k // 2)])
        return np.convolve(padded, np.ones(k) / k, mode="valid")

    out = back(ts.decompose(df, "value", (25,), index="hour"))
    np.testing.assert_allclose(out.trend, trend(25), rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(out.seasonal, values - trend(25), rtol=1e-9, atol=1e-12)
    out = back(ts.decompose(df, "value", (7, 25), index="hour"))
    np.testing.assert_allclose(out.trend, (trend(7) + trend(25)) / 2, rtol=1e-9, atol=1e-12)
    with pytest.raises(ValueError, match="odd"):
        ts.decompose(df, "value", (24,), index="hour")


def test_normalisation_uses_the_lower_median(spark):
    df = frame(spark, [("a", f"2026-01-01 0{i}:00", v) for i, v in enumerate([4, 1, 3, 10])])
    out = ts.normalise(df, "value", "subtract_median")
    row = out.first()
    assert row.location == 3.0
    assert row.scale == pytest.approx(np.sqrt(np.mean((np.array([4, 1, 3, 10]) - 3.0) ** 2) + 1e-5))
    restored = ts.denormalise(ts.normalise(df, "value", "subtract_last", gamma=2.0, beta=0.5), "normed", "back", gamma=2.0, beta=0.5)
    assert all(r.back == pytest.approx(r.value) for r in restored.collect())
    assert ts.normalise(df, "value", "identity").first().scale == 1.0
    with pytest.raises(ValueError):
        ts.normalise(df, "value", "other")


def test_regular_steps(spark):
    times = ["00:00", "01:00", "02:00", "03:00"]
    good = [("a", f"2026-01-01 {t}", 1) for t in times]
    bad = [("b", f"2026-01-01 {t}", 1) for t in ("00:00", "01:00", "02:30", "03:00")]
    checked = {r.series_id: r for r in ts.step_check(frame(spark, good + bad)).collect()}
    assert checked["a"].is_regular and checked["a"].step_seconds == 3600
    assert not checked["b"].is_regular
    assert ts.require_regular(frame(spark, good)).count() == 4
    with pytest.raises(Exception, match="resample the series first"):
        ts.require_regular(frame(spark, bad)).collect()


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_quantiles_are_exact(spark, hot):
    rng = random.Random(2)
    rows = []
    for key, n in (("big", 5000), ("two", 2), ("one", 1), ("mid", 101)):
        rows += [(key, None if rng.random() < 0.05 and n > 2 else 7.0 if rng.random() < hot else rng.expovariate(1.0)) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v double")
    levels = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", levels).collect()}
    disc = {r.k: r.m for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}, lower=True).collect()}
    for key in ("big", "two", "one", "mid"):
        values = np.sort([v for k, v in rows if k == key and v is not None])
        for name, p in levels.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert disc[key] == values[(len(values) - 1) // 2]


def test_quantiles_of_large_groups_count_only_the_brackets(spark):
    from hindcast.operators import quantiles

    rng = np.random.default_rng(5)
    n = 12 * int(quantiles.whole_below())
    groups = {
        "spread": rng.normal(size=n), "sorted": np.arange(n) / 7.0, "ties": rng.integers(0, 3, size=n) * 1.5,
        "tail": np.where(rng.random(n) < 0.7, 2.0, rng.exponential(size=n)), "small": rng.normal(size=9),
    }
    rows = pd.concat([pd.DataFrame({"k": k, "v": v}) for k, v in groups.items()] + [pd.DataFrame({"k": ["none"], "v": [float("nan")]})])
    df = spark.createDataFrame(rows, "k string, v double").replace(float("nan"), None).repartition(8, "v")
    levels = {"a": 0.0, "b": 0.0003, "c": 0.25, "d": 0.5, "e": 0.9999, "f": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", levels, also={"n": F.count("v"), "top": F.max("v")}).collect()}
    for key, values in groups.items():
        assert (got[key].n, got[key].top) == (len(values), values.max())
        for name, p in levels.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
    assert got["none"].n == 0 and got["none"].d is None


def test_quantile_statistics_take_two_passes(spark, tmp_path):
    from hindcast.operators import metrics

    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id % 3 series_id", "timestamp_seconds(id * 600) ts", "id * 1.0D value").write.parquet(path)
    df = spark.read.parquet(path)
    for out in (
        metrics.describe(df, "value"), ts.hourly_median(df),
        ts.norm_statistics(df, "value", ["identity", "subtract_last", "subtract_median"]),
    ):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") <= 2 and plan.count("Exchange hash") < 8


def test_quantiles_survive_a_bad_sketch(spark, monkeypatch):
    from hindcast.operators import quantiles

    monkeypatch.setattr(quantiles, "BRACKET", 0.0)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 2)
    values = np.random.default_rng(1).normal(size=3000)
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    row = quantiles.exact_quantiles(df, ["k"], "v", {"m": 0.5, "h": 0.97}).first()
    assert row.m == pytest.approx(np.quantile(values, 0.5)) and row.h == pytest.approx(np.quantile(values, 0.97))
