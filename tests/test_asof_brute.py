"""As-of lookups against brute force on random lines, including hot series and repeated requests."""

import random
from datetime import timedelta

from helpers import utc
from hindcast.operators.asof import current_snapshot, nearest_forecast, splice
from hindcast.schemas import FORECAST_WIDE

START = utc("2026-05-01 00:00")
RANK = {"oracle": 0, "replay": 1, "live": 2}


def moment(rng, span, grain=10):
    return START + timedelta(minutes=grain * rng.randrange(span * 60 // grain))


def test_nearest(spark):
    rng = random.Random(7)
    series = ["hot"] * 4 + ["a", "b"]
    held = {(rng.choice(series), moment(rng, 72), rng.choice(["live", "replay", "oracle", "odd"])) for _ in range(150)}
    asks = [(str(i), rng.choice(series), moment(rng, 80)) for i in range(300)] + [(f"x{i}", "hot", moment(random.Random(1), 72)) for i in range(50)]
    schema = "series_id string, reference_time timestamp, kind string"
    rows = spark.createDataFrame(sorted(held), schema)
    for name in ("target_time", "issued_at"):
        rows = rows.withColumn(name, rows.reference_time)
    for name in ("covariate_source", "model_id", "code_version"):
        rows = rows.withColumn(name, rows.kind)
    assert set(rows.columns) <= set(FORECAST_WIDE.names)
    requests = spark.createDataFrame(asks, "request_id string, series_id string, ref timestamp")
    for kinds, tolerance in ((None, 2), (["live", "replay"], 5), (["oracle"], 0.5)):
        got = {r.request_id: (r.reference_time, r.kind) for r in nearest_forecast(requests, rows, tolerance_hours=tolerance, kinds=kinds).collect()}
        expected = {}
        for rid, s, ref in asks:
            fits = [(abs(t - ref), -RANK.get(k, -1), t, k) for x, t, k in held
                    if x == s and (kinds is None or k in kinds) and abs(t - ref) <= timedelta(hours=tolerance)]
            if fits:
                expected[rid] = (min(fits)[2].replace(tzinfo=None), min(fits)[3])
        assert got == expected


def test_two_clock_lookup(spark):
    rng = random.Random(11)
    series = ["hot"] * 4 + ["a", "b"]
    held = set()
    for _ in range(200):
        fetched = moment(rng, 96)
        anchor = None if rng.random() < 0.2 else fetched - timedelta(minutes=10 * rng.randrange(-6, 90))
        held.add((rng.choice(series), anchor, fetched))
    asks = [(str(i), rng.choice(series), moment(rng, 100)) for i in range(300)]
    snapshots = spark.createDataFrame(list(held), "series_id string, reference_time timestamp, fetched_at timestamp")
    requests = spark.createDataFrame(asks, "request_id string, series_id string, ref timestamp")
    got = {r.request_id: (r.anchor, r.fetched_at) for r in current_snapshot(requests, snapshots).collect()}
    expected = {}
    for rid, s, ref in asks:
        fits = []
        for x, a, f in held:
            a = a or f
            if x == s and a >= ref - timedelta(hours=12) and (a == ref or (a < ref and f <= ref)):
                fits.append((a, f))
        if fits:
            expected[rid] = tuple(t.replace(tzinfo=None) for t in max(fits))
    assert got == expected


def test_splice_has_no_hindsight(spark):
    schema = "request_id string, ref timestamp, ts timestamp, v double"
    ref = START + timedelta(hours=2)
    observed = spark.createDataFrame([("r", ref, START + timedelta(hours=h), float(h)) for h in range(5)], schema)
    predicted = spark.createDataFrame([("r", ref, START + timedelta(hours=h), 100.0 + h) for h in range(6)], schema)
    rows = splice(observed, predicted).orderBy("ts").collect()
    assert [r.v for r in rows] == [0.0, 1.0, 2.0, 103.0, 104.0, 105.0]
