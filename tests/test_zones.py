from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hindcast.functions.zones import from_local, to_local

BERLIN = "Europe/Berlin"


def localise(spark, walls, series="a", **kwargs):
    rows = [(series if isinstance(series, str) else series[i], i, w) for i, w in enumerate(walls)]
    df = spark.createDataFrame(rows, "series_id string, n int, wall timestamp_ntz")
    out = from_local(df, BERLIN, order="n", **kwargs).orderBy("series_id", "ts", "n")
    return [(r.series_id, r.n, pd.Timestamp(r.epoch, unit="s", tz="UTC"))
            for r in out.withColumn("epoch", F.unix_seconds("ts")).collect()]


def at(text):
    return datetime.fromisoformat(text)


def test_both_repeats_of_the_autumn_hour_are_told_apart(spark):
    out = localise(spark, [at(f"2026-10-25 0{h}:00") for h in (0, 1, 2, 2, 3)])
    offsets = [t.tz_convert(BERLIN).utcoffset() for _, _, t in out]
    assert len(out) == 5
    assert offsets[2] == timedelta(hours=2) and offsets[3] == timedelta(hours=1)


def test_a_single_ambiguous_reading_is_dropped(spark):
    out = localise(spark, [at(f"2026-10-25 0{h}:00") for h in (0, 1, 2, 3)])
    assert [n for _, n, _ in out] == [0, 1, 3]


def test_a_bad_fold_drops_the_other_folds_of_that_series_only(spark):
    good = [at(f"2025-10-26 0{h}:00") for h in (1, 2, 2, 3)]
    bad = [at(f"2026-10-25 0{h}:00") for h in (1, 2, 3)]
    out = localise(spark, good + bad + good, ["a"] * 7 + ["b"] * 4)
    assert [n for s, n, _ in out if s == "a"] == [0, 3, 4, 6]
    assert len([1 for s, *_ in out if s == "b"]) == 4
    kept = localise(spark, good + bad, "a", per_fold=True)
    assert [n for _, n, _ in kept] == [0, 1, 2, 3, 4, 6]


def test_the_spring_gap_moves_to_the_first_valid_instant(spark):
    out = localise(spark, [at("2026-03-29 01:00"), at("2026-03-29 02:00"), at("2026-03-29 02:30"), at("2026-03-29 03:00")])
    assert [t.isoformat() for _, _, t in out] == ["2026-03-29T00:00:00+00:00"] + ["2026-03-29T01:00:00+00:00"] * 3


def test_order_of_input_does_not_matter(spark):
    walls = [at(f"2026-10-25 0{h}:00") for h in (3, 2, 0, 2, 1)]
    out = localise(spark, walls)
    assert [t.hour for _, _, t in out] == [22, 23, 0, 1, 2]


@pytest.mark.parametrize("start", ["1975-01-01", "2026-03-20", "2026-10-18", "2099-12-30"])
def test_agrees_with_pandas(spark, start):
    instants = pd.date_range(start, periods=24 * 14, freq="1h", tz="UTC")
    walls = instants.tz_convert(BERLIN).tz_localize(None)
    expected = pd.Series(walls).dt.tz_localize(BERLIN, ambiguous="infer", nonexistent="shift_forward").dt.tz_convert("UTC")
    out = localise(spark, [w.to_pydatetime() for w in walls])
    assert [t for _, _, t in out] == list(expected)


def test_instants_to_wall_time(spark):
    df = spark.sql("select timestamp'2026-07-01 12:00:00Z' as a, timestamp'2026-01-01 12:00:00Z' as b")
    row = df.select(to_local(F.col("a")).alias("a"), to_local(F.col("b")).alias("b")).first()
    assert row.a == at("2026-07-01 14:00") and row.b == at("2026-01-01 13:00")


def test_years_far_from_now_keep_their_rows(spark):
    out = localise(spark, [at("1850-06-01 12:00"), at("2150-07-01 12:00")])
    assert [(t.year, t.to_pydatetime().astimezone(ZoneInfo(BERLIN)).hour) for _, _, t in out] == [(1850, 12), (2150, 12)]
    with pytest.raises(Exception, match="no clock changes known"):
        localise(spark, [at("2900-07-01 12:00")])
