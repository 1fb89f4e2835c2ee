"""Plugged models over packs of contexts, requests without a context, and runs that go on past bad series."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import hours, utc
from hindcast.operators import forecasting
from hindcast.operators.forecasting import Plugged, answer_requests, forecast_batch, packs
from hindcast.plans.cycle import run_cycle
from hindcast.schemas import CHANNELS, OBSERVATION, QUANTILES
from hindcast.sources.archives import csv_layouts, read_csv_months

START = utc("2026-04-10 00:00")
ROWS, HORIZON = 48, 24


def wide(spark, counts):
    """Model input of one series per entry, so many rows each."""
    rows = [(name, t, float(i), None if name == "dry" else 2.0 * i, 3.0 * i) for name, n in counts.items() for i, t in enumerate(hours(START, n))]
    return spark.createDataFrame(rows, "series_id string, date timestamp, " + ", ".join(f"{c} double" for c in CHANNELS))


def asks(spark, counts):
    rows = [(f"{name}-{back}", name, START + timedelta(hours=n - 1 - back)) for name, n in counts.items() for back in (0, 1)]
    return spark.createDataFrame(rows, "request_id string, series_id string, ref timestamp")


def counting(folder):
    """A model that writes a file per load and per call and answers with the last water of each context."""

    def load():
        (folder / f"load-{np.random.default_rng().integers(1 << 60)}").touch()

        def answer(contexts):
            (folder / f"call-{np.random.default_rng().integers(1 << 60)}-{contexts.request_id.nunique()}").touch()
            assert (contexts.groupby("request_id").size() == ROWS).all()
            last = contexts.groupby("request_id", sort=False).last().reset_index()
            assert contexts.groupby("request_id").ts.apply(lambda t: t.is_monotonic_increasing).all()
            return pd.DataFrame({"request_id": last.request_id, "target_time": last.ts + pd.Timedelta(hours=1), "channel": CHANNELS[0],
                                 "q": 0.5, "value": last[CHANNELS[0]], "extra": 1})

        return answer

    return load


def test_packs_hold_whole_requests():
    rows = pd.DataFrame({"request_id": np.repeat([f"r{i:02}" for i in range(23)], 7), "ts": range(161)})
    for size in (1, 5, 7, 40, 200):
        batches = [rows.iloc[a:a + size] for a in range(0, len(rows), size)] + [rows.iloc[:0]]
        found = list(packs(iter(batches), 4))
        assert [p.request_id.nunique() for p in found] == [4, 4, 4, 4, 4, 3]
        assert pd.concat(found, ignore_index=True).equals(rows)
    assert list(packs(iter([]), 4)) == [] and list(packs(iter([rows.iloc[:0]]), 4)) == []


def test_one_call_answers_many_contexts(spark, tmp_path):
    counts = {f"s{i}": 60 for i in range(30)}
    contexts = forecasting.context_rows(wide(spark, counts), asks(spark, counts), ROWS).coalesce(1)
    plug = Plugged(f"counting-{tmp_path}", counting(tmp_path), contexts=16)
    rows = forecast_batch(contexts, plug).collect()
    assert {r.request_id: r.value for r in rows} == {f"s{i}-{b}": 59.0 - b for i in range(30) for b in (0, 1)} and len(rows) == 60
    calls = [int(p.name.rsplit("-", 1)[1]) for p in tmp_path.glob("call-*")]
    # A call a pack, at most one pack per task that is not full.
    assert sum(calls) == 60 and max(calls) <= 16 and len(calls) <= 60 // 16 + spark.sparkContext.defaultParallelism
    assert len(list(tmp_path.glob("load-*"))) <= spark.sparkContext.defaultParallelism


def test_every_request_is_answered_or_told_why_not(spark, tmp_path):
    counts = {"good": 60, "edge": ROWS, "short": 20, "dry": 60}
    found = answer_requests(wide(spark, counts), asks(spark, counts).unionByName(
        spark.createDataFrame([("x-0", "unknown", START)], "request_id string, series_id string, ref timestamp")),
        Plugged(f"status-{tmp_path}", counting(tmp_path)), rows=ROWS).collect()
    status = {r.request_id: r.status for r in found}
    assert len(found) == len(status) == 9
    assert status == {"good-0": "ok", "good-1": "ok", "edge-0": "ok", "edge-1": "short", "short-0": "short", "short-1": "short",
                      "dry-0": f"no {CHANNELS[1]}", "dry-1": f"no {CHANNELS[1]}", "x-0": "short"}
    assert all((r.value is None) == (r.status != "ok") for r in found)
    assert answer_requests(wide(spark, counts), asks(spark, counts).limit(0), rows=ROWS).count() == 0


def inputs(spark, counts):
    rng = np.random.default_rng(1)
    end = START + timedelta(hours=800)
    water = [(s, t, float(14 + np.sin(i * np.pi / 12) + rng.normal() / 9)) for s, n in counts.items() for i, t in enumerate(hours(end - timedelta(hours=n), n))]
    weather = [(s, t, 10 + i / 100, 1000 + i / 100, 0.0) for s, n in counts.items() for i, t in enumerate(hours(end - timedelta(hours=n), n + 200))]
    return (spark.createDataFrame(water, OBSERVATION),
            spark.createDataFrame(weather, "series_id string, ts timestamp, airtemp double, pressure double, precip double"))


def test_a_run_goes_on_past_a_short_series(spark, tmp_path):
    gauge, weather = inputs(spark, {"long": 500, "short": 30, "young": 150})
    settings = {"fetched_at": START + timedelta(hours=801), "rows": ROWS, "horizon": HORIZON}
    with pytest.raises(Exception, match="not enough data"):
        run_cycle(str(tmp_path / "a"), gauge, weather, gates=False, **settings)
    with pytest.raises(ValueError, match="no series has the 5000 rows"):
        run_cycle(str(tmp_path / "b"), gauge, weather, short="keep", **{**settings, "rows": 5000})
    cycle = run_cycle(str(tmp_path / "c"), gauge, weather, short="keep", **settings)
    assert {r.series_id: r.have for r in cycle.skipped.collect()} == {"short": 30}
    per = HORIZON * len(CHANNELS) * len(QUANTILES)
    assert {r.series_id: r["count"] for r in cycle.forecast.groupBy("series_id").count().collect()} == {"long": per, "young": per}
    kinds = {(r.series_id, r.offset_hours): (r.kind, r.n) for r in cycle.backtests.groupBy("series_id", "offset_hours", "kind").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {**{("long", o): ("oracle", per) for o in (96, 192, 288)}, **{("short", o): (None, 1) for o in (96, 192, 288)},
                     ("young", 96): ("oracle", per), ("young", 192): (None, 1), ("young", 288): (None, 1)}
    unanswered = cycle.backtests.where("kind is null").first()
    assert unanswered.is_honest is None and unanswered.label is None and unanswered.value is None


def test_csv_files_are_read_once_per_layout(spark, tmp_path):
    for i in range(12):
        head, row = (("ts,value,series_id", f"2026-04-{i + 1:02} 00:00:00+00:00,{i}.5,a") if i % 2 else
                     ("series_id,note,ts,ts", f'a,"x, y",2026-04-{i + 1:02}T00:00:00+00:00,never'))
        (tmp_path / f"month {i}.csv").write_text(f"\n{head}\r\n{row}\r\n")
    (tmp_path / "blank.csv").write_text("")
    (tmp_path / "bom.csv").write_text("﻿value,ts\n9,2026-05-01 00:00:00+00:00\n", encoding="utf-8")
    paths = [str(p) for p in sorted(tmp_path.glob("*.csv"))] + [str(tmp_path / "absent.csv")]
    layouts = csv_layouts(spark, paths)
    assert {k: len(v) for k, v in layouts.items()} == {("ts", "value", "series_id"): 6, ("series_id", "note", "ts", "ts#3"): 6, ("value", "ts"): 1}
    found = read_csv_months(spark, paths, OBSERVATION)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    rows = sorted((str(r.ts)[:10], r.series_id, r.value) for r in found.collect())
    assert rows == [*[(f"2026-04-{i + 1:02}", "a", i + 0.5 if i % 2 else None) for i in range(12)], ("2026-05-01", None, 9.0)]
    assert read_csv_months(spark, [str(tmp_path / "absent.csv"), str(tmp_path / "blank.csv")], OBSERVATION).count() == 0
