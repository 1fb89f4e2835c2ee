"""Whole runs over small stores: which tier answers each backtest, what is archived, and what is refused."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import hours, utc
from hindcast.operators import backtests as bt
from hindcast.operators import forecasting, quality, views
from hindcast.plans.cycle import FORECASTS, OBSERVATIONS, WEATHER, run_cycle, stored_snapshots
from hindcast.schemas import CHANNELS, FORECAST_LONG, OBSERVATION, QUANTILES, SNAPSHOT
from hindcast.sources.archives import read_store, upsert_forecasts, upsert_snapshots

START = utc("2026-04-10 00:00")
COUNT = 721
LAST = START + timedelta(hours=COUNT - 1)
ROWS, HORIZON = 48, 24


def inputs(spark, ahead=200):
    rng = np.random.default_rng(1)
    water = [("a", t, float(14 + np.sin(i / 4) + rng.normal() / 9)) for i, t in enumerate(hours(START, COUNT))]
    weather = [("a", t, 10 + i / 100, 1000 + i / 100, 0.0) for i, t in enumerate(hours(START, COUNT + ahead))]
    return (spark.createDataFrame(water, OBSERVATION),
            spark.createDataFrame(weather, "series_id string, ts timestamp, airtemp double, pressure double, precip double"))


def run(spark, root, **kwargs):
    gauge, weather = inputs(spark)
    return run_cycle(str(root), gauge, weather, fetched_at=LAST + timedelta(minutes=17), rows=ROWS, horizon=HORIZON, gates=False, **kwargs)


def kinds(cycle):
    return {r.offset_hours: (r.kind, r.covariate_source, r.is_honest) for r in
            cycle.backtests.select("offset_hours", "kind", "covariate_source", "is_honest").distinct().collect()}


def stored_forecast(spark, ref, kind="live", value=42.0):
    rows = [("a", ref, t, kind, "dwd_forecast", ref, "", "", CHANNELS[0], 0.5, value) for t in hours(ref + timedelta(hours=1), HORIZON)]
    return spark.createDataFrame(rows, FORECAST_LONG)


def snapshot(spark, anchor, fetched, names=("temperature", "pressure_msl")):
    rows = [("a", t, 12 + i / 10, 1005 + i / 10, fetched, anchor) for i, t in enumerate(hours(anchor, 120))]
    return spark.createDataFrame(rows, f"series_id string, ts timestamp, {names[0]} double, {names[1]} double, fetched_at timestamp, reference_time timestamp")


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plain")
    export = root / "export"
    return root, run(spark, root, export=str(export)), export


def test_an_empty_archive_falls_back_to_the_oracle(spark, plain):
    root, cycle, export = plain
    assert kinds(cycle) == {o: ("oracle", "dwd_observed", False) for o in (96, 192, 288)}
    assert cycle.forecast.count() == HORIZON * len(CHANNELS) * len(QUANTILES)
    first = cycle.forecast.agg(F.min("target_time").alias("t")).first().t
    assert first == (LAST + timedelta(hours=1)).replace(tzinfo=None)


def test_everything_is_archived(spark, plain):
    root, cycle, export = plain
    held = read_store(spark, f"{root}/{FORECASTS}", FORECAST_LONG)
    by_kind = {r.kind: r.n for r in held.groupBy("kind").agg(F.count_distinct("reference_time").alias("n")).collect()}
    assert by_kind == {"live": 1, "oracle": 3}
    assert {r.covariate_source for r in held.where("kind = 'live'").collect()} == {"dwd_forecast"}
    assert read_store(spark, f"{root}/{OBSERVATIONS}", OBSERVATION).count() == COUNT
    weather = read_store(spark, f"{root}/{WEATHER}", SNAPSHOT)
    assert weather.count() == COUNT + 200
    assert weather.first().archive_timestamp.endswith("+00:00")


def test_the_export_is_in_local_time(spark, plain):
    root, cycle, export = plain
    rows = spark.read.option("header", True).csv(str(export)).collect()
    assert len(rows) == HORIZON
    assert min(r.target_time for r in rows) == "2026-05-10 03:00"


def test_forecasts_pass_the_shape_gate(plain):
    root, cycle, export = plain
    gate = quality.shape_gate(cycle.forecast, keys=["series_id", "reference_time"], last_input="reference_time", horizon=HORIZON)
    assert gate.first().passed


def test_chart_tables(spark, plain):
    root, cycle, export = plain
    gauge, weather = inputs(spark)
    lines = views.fan_lines(cycle.backtests).collect()
    assert {r.dashed for r in lines} == {True} and all("perfect weather" in r.label for r in lines)
    axes = views.backtest_axes(cycle.forecast, cycle.backtests, weather).first()
    assert axes.oracle_note and axes.x_to == pd.Timestamp("2026-05-11 02:00")
    honest = views.backtest_axes(cycle.forecast, cycle.backtests.withColumn("kind", F.lit("replay")), weather).first()
    assert not honest.oracle_note
    alone = views.backtest_axes(cycle.forecast, cycle.backtests.limit(0), weather).first()
    assert not alone.oracle_note and alone.x_from == pd.Timestamp("2026-05-10 03:00")
    main = views.forecast_axes(cycle.forecast, gauge, weather).first()
    assert main.x_from == pd.Timestamp("2026-05-09 03:00") and main.y_from < 14 < main.y_to


def test_tiers_together(spark, tmp_path):
    """A stored forecast answers one backtest, a snapshot another; a second run replays nothing it already has."""
    upsert_forecasts(stored_forecast(spark, LAST - timedelta(hours=97)), f"{tmp_path}/{FORECASTS}", FORECAST_LONG)
    anchor = LAST - timedelta(hours=192)
    upsert_snapshots(snapshot(spark, anchor, anchor + timedelta(minutes=20)), f"{tmp_path}/{WEATHER}", SNAPSHOT)
    late = LAST - timedelta(hours=289)
    upsert_snapshots(snapshot(spark, late, late + timedelta(hours=5)), f"{tmp_path}/{WEATHER}", SNAPSHOT)
    cycle = run(spark, tmp_path)
    assert kinds(cycle) == {96: ("live", "dwd_forecast", True), 192: ("replay", "dwd_forecast_archived", True), 288: ("oracle", "dwd_observed", False)}
    reused = cycle.backtests.where("offset_hours = 96")
    assert {r.value for r in reused.collect()} == {42.0}
    assert {r.reference_time for r in reused.collect()} == {(LAST - timedelta(hours=97)).replace(tzinfo=None)}
    again = run(spark, tmp_path)
    assert kinds(again)[192][0] == "replay"
    assert again.backtests.where("offset_hours = 192 and from_archive").count() > 0


def test_replay_sees_the_snapshot_and_not_what_happened(spark):
    """The replayed context ends with the weather the snapshot promised."""
    gauge, weather = inputs(spark)
    ref = LAST - timedelta(hours=192)
    hits = spark.createDataFrame([("r", "a", ref)], "request_id string, series_id string, ref timestamp")
    ahead = spark.createDataFrame([("r", ref, ref + timedelta(hours=h), 50.0 + h, None if h % 2 else 990.0) for h in range(1, 101)],
                                  "request_id string, ref timestamp, ts timestamp, airtemp double, pressure double")
    known = forecasting.known_hours(gauge, weather, block_seconds=86_400)
    rows = forecasting.replay_rows(hits, ahead, known, ROWS).orderBy("ts").collect()
    assert len(rows) == ROWS and rows[-1].ts == ref.replace(tzinfo=None)
    assert rows[-1].airtemp_96 == 50.0 + 96 and rows[-ROWS].airtemp_96 == 50.0 + 96 - ROWS + 1
    assert all(r.pressure_96 == pytest.approx(990.0) for r in rows)
    frame = pd.DataFrame([r.asDict() for r in gauge.collect()]).set_index("ts").value
    assert [r.wassertemp for r in rows] == list(frame[: ref.replace(tzinfo=None)].iloc[-ROWS:])


def test_a_plugged_forecaster_gets_one_context_per_request(spark, tmp_path):
    def flat(pdf):
        assert len(pdf) == ROWS and pdf.ts.is_monotonic_increasing
        last = pdf.ts.iloc[-1]
        return pd.DataFrame([
            {"request_id": pdf.request_id.iloc[0], "target_time": last + pd.Timedelta(hours=h), "channel": c, "q": q, "value": 7.0 + q}
            for h in range(1, HORIZON + 1) for c in CHANNELS for q in QUANTILES
        ])

    cycle = run(spark, tmp_path, forecaster=flat)
    assert cycle.forecast.count() == HORIZON * 21 and cycle.backtests.count() == 3 * HORIZON * 21
    assert {round(r.value - r.q, 6) for r in cycle.backtests.collect()} == {7.0}


def test_refusals(spark, tmp_path):
    gauge, weather = inputs(spark)
    with pytest.raises(ValueError, match="no series has a reading"):
        run_cycle(str(tmp_path), gauge.withColumn("value", F.lit(None).cast("double")), weather, fetched_at=LAST)
    with pytest.raises(Exception, match="not enough data: 5000 regular rows are required"):
        run_cycle(str(tmp_path), gauge, weather, fetched_at=LAST, rows=5000)
    with pytest.raises(quality.GateFailed, match="plausible range"):
        run_cycle(str(tmp_path / "hot"), gauge.withColumn("value", F.col("value") + 300), weather, fetched_at=LAST, rows=ROWS, horizon=HORIZON)


def test_water_is_null_after_the_last_gauge_row(spark):
    gauge, weather = inputs(spark)
    holed = gauge.withColumn("value", F.when(F.hour("ts") % 5 != 0, F.col("value")))
    wide = forecasting.assemble(holed, weather, block_seconds=86_400)
    past, after = wide.where(F.col("date") <= F.lit(LAST)), wide.where(F.col("date") > F.lit(LAST))
    assert past.where("wassertemp is null").isEmpty() and after.where("wassertemp is not null").isEmpty()
    assert after.count() == 200


def test_skipping_short_requests(spark):
    gauge, weather = inputs(spark)
    asks = spark.createDataFrame([("r", "a", 1, START + timedelta(hours=10)), ("s", "a", 2, LAST)],
                                 "request_id string, series_id string, offset_hours int, ref timestamp")
    out = bt.resolve_backtests(asks, spark.createDataFrame([], FORECAST_LONG), stored_snapshots(spark, "/nowhere/at/all"), gauge, weather,
                               rows=ROWS, horizon=HORIZON, short="skip")
    assert {r.request_id for r in out.select("request_id").distinct().collect()} == {"s"}
