"""Named queries over the test tables, one or more per operator, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.functions import scalars, zones
from hindcast.functions.student_t import expand_quantiles
from hindcast.operators import (
    asof, backtests, forecasting, metrics, quality, reshape, rolling, selection, timeseries, upserts, views,
)
from hindcast.operators.blocks import framed, hour_number, number_rows
from hindcast.plans import fixtures as fx
from hindcast.plans import oracle as sq
from hindcast.schemas import CHANNELS, FORECAST_WIDE, OBSERVATION, PROVENANCE, QUANTILES, SOURCE_LIVE
from hindcast.session import configure
from hindcast.sources import archives, exports, payloads
from hindcast.streaming import ingest

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None, **extra: str) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        CATALOGUE[build.__name__] = Query(run, sq.steady(sq.sql(sql, **extra)) if sql else None)
        return run

    return register


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison, off the ties: the order of a distributed sum changes its last bits."""
    return F.round((F.col(column) if isinstance(column, str) else column) + sq.NUDGE, digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.select(*[r(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def held(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Hourly gauge and weather, each written once and read back."""
    return fx.settled(fx.gauge(spark, folder), "gauge"), fx.settled(fx.clean_weather(spark, folder), "weather")




# ---- resampling and cleaning -----------------------------------------------------------------------------------


@query("SELECT series_id, ts, value FROM gauge")
def resample_first(spark, folder):
    return fx.gauge(spark, folder)


@query("SELECT series_id, ts, airtemp, pressure, precip FROM clean_weather")
def resample_mean_sum(spark, folder):
    return fx.clean_weather(spark, folder)


@query("""SELECT g.series_id, g.ts, round(m.value, 6) AS value FROM obs_grid g LEFT JOIN (
    SELECT series_id, date_trunc('hour', ts) AS ts, quantile_cont(value, 0.5) AS value FROM obs GROUP BY 1, 2) m USING (series_id, ts)""")
def resample_median(spark, folder):
    return rounded(timeseries.hourly_median(fx.obs(spark, folder)), "value")


@query(f"SELECT series_id, ts, round({sq.blend('value')}, 6) AS value FROM gauge_near")
def interpolate_time(spark, folder):
    return rounded(timeseries.interpolate_time(fx.gauge(spark, folder), ["value"]), "value")


@query("""SELECT series_id, ts, coalesce(value_pv, value_nv) AS value FROM gauge_near""")
def ffill_bfill(spark, folder):
    return timeseries.fill_both_ways(fx.gauge(spark, folder), ["value"])


@query(f"SELECT series_id, ts, round(CASE WHEN value_nt IS NOT NULL THEN {sq.fill('value')} END, 6) AS value FROM ahead_near",
       ahead="""SELECT series_id, ts, value FROM gauge UNION ALL SELECT series_id, hi + INTERVAL 1 HOUR * s.step, NULL
       FROM (SELECT series_id, max(ts) AS hi FROM gauge GROUP BY 1), (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step) s""",
       ahead_near=sq.neighbours("ahead", ["value"]))
def bounded_fill(spark, folder):
    gauge = fx.gauge(spark, folder)
    later = timeseries.future_index(gauge, 6).select(
        "series_id", F.col("target_time").alias("ts"), F.lit(None).cast("double").alias("value")
    )
    return rounded(timeseries.bounded_fill(gauge.unionByName(later), ["value"]), "value")


@query("""SELECT series_id, ts, round(value, 6) AS value, round(lead(value, 96) OVER (PARTITION BY series_id ORDER BY ts), 6) AS value_96
    FROM hourly""")
def lead_covariates(spark, folder):
    rows = number_rows(fx.hourly(spark, folder))
    return rounded(timeseries.lead_rows(rows, {"value": "value_96"}).select("series_id", "ts", "value", "value_96"),
                   "value", "value_96")


@query("""SELECT series_id, date, cols, cols_ord, round(data, 6) AS data FROM (
    SELECT series_id, date, 'wassertemp' AS cols, 1::INTEGER AS cols_ord, wassertemp AS data FROM wide UNION ALL
    SELECT series_id, date, 'airtemp_96', 2::INTEGER, airtemp_96 FROM wide UNION ALL
    SELECT series_id, date, 'pressure_96', 3::INTEGER, pressure_96 FROM wide)""")
def assemble_long(spark, folder):
    long = forecasting.assemble_long(*held(spark, folder))
    return reshape.in_channel_order(rounded(long, "data"))


@query("""SELECT series_id, ts, round(avg(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 719 PRECEDING AND CURRENT ROW), 6)
    AS rolling FROM gauge""")
def rolling_mean_720(spark, folder):
    rows = fx.gauge(spark, folder).withColumn("hour", hour_number(F.col("ts")))
    return rounded(timeseries.rolling_mean(rows, "value", "rolling", 720, index="hour").select("series_id", "ts", "rolling"),
                   "rolling")


@query(f"""SELECT series_id, hour, round(mean, 6) AS mean, round(std, 6) AS std, round(mean - std, 6) AS low, round(mean + std, 6) AS high
    FROM (SELECT series_id, hour({sq.local('ts')})::INTEGER AS hour, avg(value) AS mean, stddev_samp(value) AS std FROM hourly GROUP BY 1, 2)""")
def daily_profile(spark, folder):
    profile = metrics.local_profile(fx.hourly(spark, folder), "value", "hour", keys=["series_id"])
    return rounded(profile, "mean", "std", "low", "high")


@query(f"""SELECT series_id, month, round(mean, 6) AS mean, round(std, 6) AS std, round(mean - std, 6) AS low, round(mean + std, 6) AS high
    FROM (SELECT series_id, month({sq.local('ts')})::INTEGER AS month, avg(value) AS mean, stddev_samp(value) AS std FROM daily GROUP BY 1, 2)""")
def seasonal_profile(spark, folder):
    profile = metrics.local_profile(fx.daily(spark, folder), "value", "month", keys=["series_id"])
    return rounded(profile, "mean", "std", "low", "high")


STATS = """count(value)::BIGINT AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
    round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
    round(max(value), 6) AS max"""
STAT_COLUMNS = ("mean", "std", "min", "p25", "p50", "p75", "max")


@query(f"SELECT series_id, {STATS} FROM obs GROUP BY 1")
def series_stats(spark, folder):
    return rounded(metrics.describe(fx.obs(spark, folder), "value"), *STAT_COLUMNS)


@query(f"SELECT series_id, {STATS} FROM (SELECT series_id, first_river - second_river AS value FROM pairs) GROUP BY 1")
def series_diff_stats(spark, folder):
    diff = metrics.difference(fx.pairs(spark, folder), "first_river", "second_river", "value")
    return rounded(metrics.describe(diff, "value"), *STAT_COLUMNS)


def _decomposed(kernels: tuple[int, ...]) -> str:
    parts = []
    for k in kernels:
        h = k // 2
        parts.append(
            f"(sum(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) "
            f"+ greatest(0, {h} - start) * first_value(value) OVER p + greatest(0, {h} - (n - 1 - start)) * last_value(value) OVER p) / {k}"
        )
    trend = f"({' + '.join(parts)}) / {len(kernels)}"
    return f"""SELECT series_id, ts, round(trend, 6) AS trend, round(value - trend, 6) AS seasonal FROM (SELECT series_id, ts, value, {trend} AS trend
        FROM daily WINDOW p AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _split(spark, folder, kernels):
    rows = fx.daily(spark, folder).withColumn("day", fx.day_number())
    parts = timeseries.decompose(rows, "value", kernels, index="day").select("series_id", "ts", "trend", "seasonal")
    return rounded(parts, "trend", "seasonal")


@query(_decomposed((25,)))
def decompose_25(spark, folder):
    return _split(spark, folder, (25,))


@query(_decomposed((7, 25, 49)))
def decompose_multi(spark, folder):
    return _split(spark, folder, (7, 25, 49))


@query("""SELECT d.series_id, d.ts, s.mode, round((value - location) / scale, 6) AS normed, round(value, 6) AS restored FROM daily d JOIN (
    SELECT l.series_id, l.mode, l.location, CASE WHEN max(l.mode) = 'identity' THEN 1 ELSE sqrt(avg((value - location) * (value - location)) + 1e-5) END
    AS scale FROM daily JOIN (SELECT series_id, 'identity' AS mode, 0::DOUBLE AS location FROM daily GROUP BY 1 UNION ALL
    SELECT series_id, 'subtract_last', arg_max(value, ts) FROM daily GROUP BY 1 UNION ALL
    SELECT series_id, 'subtract_median', quantile_disc(value, 0.5) FROM daily GROUP BY 1) l USING (series_id) GROUP BY l.series_id, l.mode, l.location) s USING (series_id)""")
def instance_normalise(spark, folder):
    normed = timeseries.normalise(fx.daily(spark, folder), "value", timeseries.NORM_MODES)
    restored = timeseries.denormalise(normed, "normed", "restored")
    return rounded(restored.select("series_id", "ts", "mode", "normed", "restored"), "normed", "restored")


# ---- volatile windows and peaks --------------------------------------------------------------------------------


def _greedy(source: str, count: int, width: int) -> str:
    """Unrolled greedy choice: each step takes the best start that is clear of all earlier ones."""
    steps, picks = [], []
    for i in range(1, count + 1):
        clear = " AND ".join(
            f"NOT EXISTS (SELECT 1 FROM pick{j} p WHERE p.series_id = s.series_id AND abs(p.start - s.start) < {width})" for j in range(1, i)
        ) or "true"
        picks.append(f"SELECT series_id, {i}::INTEGER AS place, start, ts, score FROM pick{i}")
        steps.append(
            f"pick{i} AS (SELECT series_id, start, ts, score FROM {source} s WHERE {clear} "
            "QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY score DESC, start) = 1)"
        )
    return ", ".join(steps), " UNION ALL ".join(picks)


def _volatile_sql() -> str:
    steps24, picks24 = _greedy("score24", 5, 24)
    steps96, picks96 = _greedy("score96", 4, 96)
    steps96, picks96 = steps96.replace("pick", "trend"), picks96.replace("pick", "trend")
    base = """scored AS (SELECT series_id, ts, start, n, value, var_pop(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 23
        FOLLOWING) AS v24, var_pop(value) OVER w AS v96, avg(value) OVER w AS m96, lead(value, 95) OVER (PARTITION BY series_id ORDER BY ts) AS final
        FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 95 FOLLOWING)),
        score24 AS (SELECT series_id, ts, start, v24 AS score FROM scored WHERE start >= 1000 AND start < n - 97),
        score96 AS (SELECT series_id, ts, start, v96 * abs(value - final) AS score FROM scored WHERE start >= 1000 AND start < n - 97
        AND m96 BETWEEN 13 AND 16)"""
    lead = sq.sql("SELECT 1 FROM daily")
    lead = lead[: lead.rindex("SELECT 1 FROM daily")].rstrip()
    return (
        f"{lead}, {base}, {steps24}, {steps96} SELECT series_id, 24::INTEGER AS width, place, start, ts, round(score, 6) AS score FROM ({picks24}) "
        f"UNION ALL SELECT series_id, 96::INTEGER, place, start, ts, round(score, 6) FROM ({picks96})"
    )


def _volatile(spark, folder):
    rows = fx.daily(spark, folder)
    years = 720 * 86_400
    calm = selection.volatility_scores(rows, "value", 24, margin=96, block_seconds=years)
    trending = selection.volatility_scores(rows, "value", 96, trend=True, mean_between=(13.0, 16.0), block_seconds=years)
    short = selection.spaced_top(calm, 5, 24).withColumn("width", F.lit(24))
    return short.unionByName(selection.spaced_top(trending, 4, 96).withColumn("width", F.lit(96)))


def volatile_windows(spark, folder):
    picks = _volatile(configure(spark), folder)
    return rounded(picks.select("series_id", "width", "place", "start", "ts", "score"), "score")


CATALOGUE["volatile_windows"] = Query(volatile_windows, sq.steady(_volatile_sql()))


CURVES = """SELECT series_id, date_trunc('month', ts)::TIMESTAMP AS reference_time, ts AS target_time, round(trend, 6) AS value FROM (
    SELECT series_id, ts, avg(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS trend FROM daily)"""


PEAKS = """SELECT k.series_id, k.reference_time, k.target_time, k.value, k.pos::INTEGER AS position, round(k.value - greatest(l.low, h.low), 6) AS prominence
    FROM (SELECT c.* FROM curve_rows c JOIN kept ON kept.series_id = c.series_id AND kept.reference_time = c.reference_time
        AND list_contains(kept.chosen, c.pos)) k,
    LATERAL (SELECT min(b.value) AS low FROM curve_rows b WHERE b.series_id = k.series_id AND b.reference_time = k.reference_time AND b.pos <= k.pos
        AND b.pos > coalesce((SELECT max(a.pos) FROM curve_rows a WHERE a.series_id = k.series_id AND a.reference_time = k.reference_time
        AND a.pos < k.pos AND a.value > k.value), -1)) l,
    LATERAL (SELECT min(b.value) AS low FROM curve_rows b WHERE b.series_id = k.series_id AND b.reference_time = k.reference_time AND b.pos >= k.pos
        AND b.pos < coalesce((SELECT min(a.pos) FROM curve_rows a WHERE a.series_id = k.series_id AND a.reference_time = k.reference_time
        AND a.pos > k.pos AND a.value > k.value), 1000000)) h
    WHERE k.value - greatest(l.low, h.low) >= 0.2"""


def _peak_steps(curves: str, distance: int) -> dict[str, str]:
    """Tops of each curve, chosen from the highest down; ``curves`` has series_id, reference_time, target_time, value."""
    return {
        "curves": curves,
        "curve_rows": "SELECT *, row_number() OVER (PARTITION BY series_id, reference_time ORDER BY target_time) - 1 AS pos FROM curves",
        "runs": """SELECT series_id, reference_time, value, min(pos) AS lo, max(pos) AS hi FROM (SELECT *, sum(fresh) OVER (PARTITION BY series_id,
        reference_time ORDER BY pos) AS run FROM (SELECT *, CASE WHEN value IS NOT DISTINCT FROM lag(value) OVER (PARTITION BY series_id, reference_time
        ORDER BY pos) THEN 0 ELSE 1 END AS fresh FROM curve_rows)) GROUP BY series_id, reference_time, value, run""",
        "tops": """SELECT *, row_number() OVER (PARTITION BY series_id, reference_time ORDER BY value DESC, pos DESC) AS turn FROM (
        SELECT series_id, reference_time, value, (lo + hi) // 2 AS pos, lag(value) OVER w AS before, lead(value) OVER w AS after FROM runs
        WINDOW w AS (PARTITION BY series_id, reference_time ORDER BY lo)) WHERE value > before AND value > after""",
        "walk": f"""SELECT series_id, reference_time, 0::BIGINT AS turn, []::BIGINT[] AS chosen FROM (SELECT DISTINCT series_id, reference_time FROM tops)
        UNION ALL SELECT w.series_id, w.reference_time, t.turn, CASE WHEN len(list_filter(w.chosen, lambda x: abs(x - t.pos) < {distance})) = 0
        THEN list_append(w.chosen, t.pos) ELSE w.chosen END FROM walk w JOIN tops t ON t.series_id = w.series_id
        AND t.reference_time = w.reference_time AND t.turn = w.turn + 1""",
        "kept": "SELECT series_id, reference_time, arg_max(chosen, turn) AS chosen FROM walk GROUP BY 1, 2",
    }


@query(PEAKS, **_peak_steps(CURVES, 6))
def peaks(spark, folder):
    """Significant maxima of monthly curves of the five-day mean."""
    rows = fx.daily(spark, folder).withColumn("day", fx.day_number())
    smooth = framed(rows, "day", lambda w: {"mean": F.avg("value").over(w.rowsBetween(-2, 2))}, before=2, after=2)
    curves = smooth.select(
        "series_id", F.date_trunc("month", "ts").alias("reference_time"), F.col("ts").alias("target_time"), r("mean").alias("value")
    )
    found = selection.find_peaks(curves, "value", distance=6, prominence=0.2)
    return rounded(found.select("series_id", "reference_time", "target_time", "value", "position", "prominence"), "prominence")


# ---- deduplication and upserts ---------------------------------------------------------------------------------


@query("""SELECT series_id, reference_time, target_time, kind, covariate_source, wassertemp FROM resolved""")
def precedence_dedup(spark, folder):
    best = selection.resolve_precedence(fx.candidates(spark, folder))
    return best.select("series_id", "reference_time", "target_time", "kind", "covariate_source", "wassertemp")


@query("""SELECT series_id, hour, arg_min(value, event_id) AS first_value, arg_max(value, event_id) AS last_value FROM (
    SELECT event_type AS series_id, hour(ts)::INTEGER AS hour, value, event_id FROM events) GROUP BY 1, 2""")
def dedup_first_last(spark, folder):
    rows = fx.events(spark, folder).select(F.col("event_type").alias("series_id"), F.hour("ts").alias("hour"), "value", "event_id")
    keys = ["series_id", "hour"]
    first = selection.keep_one(rows, keys, [F.asc("event_id")]).select(*keys, F.col("value").alias("first_value"))
    last = selection.keep_one(rows, keys, [F.desc("event_id")]).select(*keys, F.col("value").alias("last_value"))
    return first.join(last, keys)


WIDE_NAMES = "series_id, reference_time, target_time, kind, covariate_source, issued_at, model_id, code_version, wassertemp"
RELABELLED = f"""SELECT * REPLACE (CASE WHEN kind = 'wishful' THEN 'oracle' ELSE kind END AS kind) FROM candidates"""
RERUN = """SELECT * REPLACE (CASE kind WHEN 'live' THEN 'replay' WHEN 'replay' THEN 'oracle' ELSE 'live' END AS kind,
    issued_at + INTERVAL 90 MINUTE AS issued_at, wassertemp + 1 AS wassertemp) FROM relabelled"""


@query(f"""SELECT {WIDE_NAMES} FROM (SELECT *, -1::BIGINT AS seq FROM relabelled UNION ALL SELECT *, write_seq FROM rerun)
    QUALIFY row_number() OVER (PARTITION BY series_id, reference_time, target_time ORDER BY {sq.rank('kind')} DESC, issued_at DESC NULLS LAST,
    seq DESC, wassertemp DESC) = 1""", relabelled=RELABELLED + """ QUALIFY row_number() OVER (PARTITION BY series_id, reference_time, target_time
    ORDER BY (CASE kind WHEN 'live' THEN 2 WHEN 'replay' THEN 1 ELSE 0 END) DESC, issued_at DESC NULLS LAST, write_seq DESC) = 1""",
       rerun=RERUN.replace("relabelled", f"({RELABELLED})"))
def archive_upsert(spark, folder):
    """A stored archive meets a rerun of everything with other kinds, later issues and other values."""
    stored = selection.resolve_precedence(fx.known_candidates(spark, folder)).drop("write_seq")
    kind = F.when(F.col("kind") == "live", "replay").when(F.col("kind") == "replay", "oracle").otherwise("live")
    rerun = fx.known_candidates(spark, folder).withColumns({
        "kind": kind, "issued_at": F.col("issued_at") + F.expr("interval 90 minutes"), "wassertemp": F.col("wassertemp") + 1,
    })
    return upserts.merge_forecasts(stored, rerun).select(*[c.strip() for c in WIDE_NAMES.split(",")])


@query("""SELECT series_id, ts, value FROM (SELECT series_id, date_trunc('hour', ts) AS ts, value, event_id FROM obs)
    QUALIFY row_number() OVER (PARTITION BY series_id, ts ORDER BY event_id DESC) = 1""")
def observation_upsert(spark, folder):
    """Hourly first readings are corrected by every later reading of the hour."""
    stored = timeseries.hourly_first(fx.obs(spark, folder))
    arriving = fx.obs(spark, folder).select(
        "series_id", F.date_trunc("hour", "ts").alias("ts"), "value", F.col("event_id").alias("write_seq")
    )
    merged = upserts.merge_observations(stored.where(F.col("value").isNotNull()), arriving)
    return merged.select("series_id", "ts", "value")


@query("""SELECT h.series_id, h.reference_time, h.fetched_at, h.temperature FROM written h
    WHERE h.seq = (SELECT max(o.seq) FROM written o WHERE o.series_id = h.series_id AND o.fetched_at = h.fetched_at AND o.month = h.month)
    AND (h.reference_time IS NULL OR h.seq = (SELECT max(o.seq) FROM written o WHERE o.series_id = h.series_id AND o.reference_time = h.reference_time))""",
       written="""SELECT *, strftime(coalesce(reference_time, fetched_at), '%Y-%m') AS month FROM (
       SELECT series_id, reference_time, fetched_at, temperature, -1::BIGINT AS seq FROM legacy UNION ALL
       SELECT series_id, coalesce(reference_time, fetched_at), fetched_at, temperature, write_seq FROM snapshot_heads)""",
       legacy="""SELECT series_id, NULL::TIMESTAMP AS reference_time, date_trunc('hour', fetched_at) AS fetched_at, max(temperature) AS temperature
       FROM snapshot_heads GROUP BY ALL""")
def snapshot_upsert(spark, folder):
    """Legacy snapshots without an anchor meet one write per event."""
    writes = fx.snapshot_heads(spark, folder)
    legacy = writes.groupBy("series_id", F.date_trunc("hour", "fetched_at").alias("fetched_at")).agg(
        F.max("temperature").alias("temperature")
    ).withColumn("reference_time", F.lit(None).cast("timestamp"))
    return upserts.merge_snapshots(legacy, writes).select("series_id", "reference_time", "fetched_at", "temperature")


@query("""SELECT series_id, ts, round(value, 6) AS value FROM (SELECT o_orderpriority AS series_id, date_trunc('day', o_orderdate)::TIMESTAMP AS ts,
    avg(o_totalprice) AS value FROM orders GROUP BY 1, 2)""")
def chunk_union(spark, folder):
    """Yearly downloads whose first and last days overlap, laid end to end."""
    days = fx.table(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("series_id"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("ts")
    ).agg(F.avg("o_totalprice").alias("value"))
    year = F.year("ts")
    chunks = [days.where(year <= 1996)]
    chunks += [days.where((year == y) | (F.col("ts") == F.make_date(F.lit(y), F.lit(1), F.lit(1)) - F.expr("interval 1 day"))) for y in range(1997, 2001)]
    chunks.append(days.where(year >= 2001))
    return rounded(upserts.union_chunks(chunks, ["series_id", "ts"]), "value")


@query("""SELECT series_id, reference_time, target_time, 'live' AS kind, 'dwd_forecast' AS covariate_source, reference_time AS issued_at,
    '' AS model_id, 'legacy' AS code_version, max(wassertemp) AS wassertemp FROM candidates GROUP BY series_id, reference_time, target_time""")
def migrate_flat(spark, folder):
    """The same from flat CSV files, by way of a store."""
    path = fx.scratch(spark, "flat")
    flat = fx.candidates(spark, folder).groupBy("series_id", "reference_time", "target_time").agg(F.max("wassertemp").alias("wassertemp"))
    spelled = F.date_format("target_time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("target_time")
    flat.select("wassertemp", spelled, F.date_format("reference_time", "yyyy-MM-dd HH:mm:ssXXX").alias("reference_time"), "series_id").write.option(
        "header", True).csv(f"{path}/csv")
    schema = type(FORECAST_WIDE)([f for f in FORECAST_WIDE.fields if "_q" not in f.name]).add("wassertemp", "double")
    archives.migrate_legacy(spark, f"{path}/csv", f"{path}/store", schema)
    return archives.read_store(spark, f"{path}/store", schema)


@query("""SELECT series_id, reference_time, target_time, 'live' AS kind, 'dwd_forecast' AS covariate_source, reference_time AS issued_at,
    '' AS model_id, 'legacy' AS code_version, max(wassertemp) AS wassertemp FROM candidates GROUP BY series_id, reference_time, target_time""")
def legacy_migration(spark, folder):
    """Flat forecasts stamped as live and folded into an empty archive."""
    flat = fx.candidates(spark, folder).groupBy("series_id", "reference_time", "target_time").agg(F.max("wassertemp").alias("wassertemp"))
    stamped = upserts.stamp_forecast(
        flat, kind="live", covariate_source=SOURCE_LIVE, issued_at=F.col("reference_time"), code_version="legacy"
    )
    return reshape.metadata_first(upserts.merge_forecasts(stamped.limit(0), stamped))


@query("""SELECT series_id, reference_time, target_time, CASE WHEN layout <> 1 THEN kind END AS kind,
    CASE WHEN layout = 0 THEN date_trunc('second', issued_at) END AS issued_at, CASE WHEN layout <> 2 OR event_id % 5 <> 0 THEN wassertemp END AS wassertemp
    FROM (SELECT *, write_seq AS event_id, floor(epoch(reference_time) / 86400)::BIGINT % 3 AS layout FROM candidates)""")
def csv_months(spark, folder):
    """A CSV file a day in three layouts that drift: columns in other places, missing, unknown, unreadable."""
    path = fx.scratch(spark, "csv")
    rows = fx.candidates(spark, folder).withColumn("day", F.floor(F.unix_micros("reference_time") / F.lit(86_400_000_000)))
    plain = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ssXXX").alias(c) for c in ("reference_time", "target_time", "issued_at")}
    other = F.date_format("target_time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("target_time")
    unread = F.when(F.col("write_seq") % 5 != 0, F.col("wassertemp").cast("string")).otherwise("NaN").alias("wassertemp")
    layouts = (
        ["series_id", plain["reference_time"], plain["target_time"], "kind", plain["issued_at"], "wassertemp"],
        ["wassertemp", plain["target_time"], plain["reference_time"], "series_id"],
        [other, "series_id", F.lit("a, note").alias("note"), plain["reference_time"], unread, "kind"],
    )
    for at, columns in enumerate(layouts):
        part = rows.where(F.col("day") % 3 == at).select(*columns, "day").repartition("day")
        part.write.partitionBy("day").option("header", True).csv(f"{path}/{at}")
    names = ("series_id", "reference_time", "target_time", "kind", "issued_at", "wassertemp")
    schema = type(FORECAST_WIDE)([f for f in FORECAST_WIDE.fields if f.name in names]).add("wassertemp", "double")
    return archives.read_csv_months(spark, [f"{path}/{at}/day=*" for at in range(len(layouts))], schema)


@query(f"""SELECT {WIDE_NAMES} FROM relabelled WHERE kind IN ('live', 'replay')""", relabelled=RELABELLED + """
    QUALIFY row_number() OVER (PARTITION BY series_id, reference_time, target_time
    ORDER BY (CASE kind WHEN 'live' THEN 2 WHEN 'replay' THEN 1 ELSE 0 END) DESC, issued_at DESC NULLS LAST, write_seq DESC) = 1""")
def forecast_store(spark, folder):
    """Write all forecasts to a month-partitioned store and read the honest ones back."""
    names = [c.strip() for c in WIDE_NAMES.split(",")]
    schema = type(FORECAST_WIDE)([f for f in FORECAST_WIDE.fields if f.name in names])
    schema.add("wassertemp", "double")
    path = fx.scratch(spark, "forecasts")
    archives.upsert_forecasts(fx.known_candidates(spark, folder), path, schema)
    return archives.read_forecasts(spark, path, schema, ["live", "replay"]).select(*names)


# ---- as-of lookups ---------------------------------------------------------------------------------------------


@query(f"""SELECT r.event_id AS request_id, r.event_type AS series_id, h.reference_time, h.kind, h.covariate_source,
    round(abs(epoch_us(h.reference_time) - epoch_us(r.ts)) / 1000000, 6) AS distance_seconds FROM events r JOIN heads h ON h.series_id = r.event_type
    AND h.kind IN ('live', 'replay') AND abs(epoch_us(h.reference_time) - epoch_us(r.ts)) <= 7200000000
    QUALIFY row_number() OVER (PARTITION BY r.event_id ORDER BY abs(epoch_us(h.reference_time) - epoch_us(r.ts)), {sq.rank('h.kind')} DESC,
    h.reference_time) = 1""")
def asof_nearest(spark, folder):
    stored = selection.resolve_precedence(fx.candidates(spark, folder))
    hits = asof.nearest_forecast(fx.asks(spark, folder), stored, kinds=["live", "replay"])
    return rounded(hits.select("request_id", "series_id", "reference_time", "kind", "covariate_source", "distance_seconds"), "distance_seconds")


@query(f"""SELECT r.event_id AS request_id, h.reference_time, h.kind, s.target_time, s.wassertemp FROM events r JOIN heads h ON h.series_id = r.event_type
    AND abs(epoch_us(h.reference_time) - epoch_us(r.ts)) <= 7200000000 JOIN resolved s ON s.series_id = h.series_id AND s.reference_time = h.reference_time
    AND s.kind = h.kind QUALIFY dense_rank() OVER (PARTITION BY r.event_id ORDER BY abs(epoch_us(h.reference_time) - epoch_us(r.ts)),
    {sq.rank('h.kind')} DESC, h.reference_time, h.kind) = 1""")
def asof_forecast_rows(spark, folder):
    stored = selection.resolve_precedence(fx.candidates(spark, folder))
    hits = asof.nearest_forecast(fx.asks(spark, folder), stored)
    return asof.forecast_rows(hits, stored).select("request_id", "reference_time", "kind", "target_time", "wassertemp")


@query("""SELECT r.event_id AS request_id, r.event_type AS series_id, s.anchor, s.fetched_at FROM events r JOIN (
    SELECT DISTINCT series_id, coalesce(reference_time, fetched_at) AS anchor, fetched_at FROM snapshot_heads) s ON s.series_id = r.event_type
    AND s.anchor >= r.ts - INTERVAL 12 HOUR AND (s.anchor = r.ts OR (s.anchor < r.ts AND s.fetched_at <= r.ts))
    QUALIFY row_number() OVER (PARTITION BY r.event_id ORDER BY s.anchor DESC, s.fetched_at DESC) = 1""")
def asof_bitemporal(spark, folder):
    hits = asof.current_snapshot(fx.asks(spark, folder), fx.snapshot_heads(spark, folder))
    return hits.select("request_id", "series_id", "anchor", "fetched_at")


@query("""SELECT r.request_id, w.ts, w.airtemp, w.pressure FROM requests r JOIN clean_weather w ON w.series_id = r.series_id AND w.ts <= r.ref
    UNION ALL SELECT r.request_id, s.ts, s.airtemp, s.pressure FROM spliced r JOIN snapshots s ON s.series_id = r.series_id AND s.anchor = r.anchor
    AND s.fetched_at = r.fetched_at AND s.ts > r.ref""",
       spliced="""SELECT r.*, s.anchor, s.fetched_at FROM requests r JOIN (SELECT DISTINCT series_id, anchor, fetched_at FROM snapshots) s
    ON s.series_id = r.series_id AND s.anchor >= r.ref - INTERVAL 12 HOUR AND (s.anchor = r.ref OR (s.anchor < r.ref AND s.fetched_at <= r.ref))
    QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY s.anchor DESC, s.fetched_at DESC) = 1""")
def splice(spark, folder):
    gauge, weather = held(spark, folder)
    asked = fx.requests(gauge).select("request_id", "series_id", "ref")
    observed = asked.join(weather.select("series_id", "ts", "airtemp", "pressure"), "series_id")
    stored = fx.snapshots(gauge)
    ahead = asof.snapshot_rows(asof.current_snapshot(asked, stored), stored).select(observed.columns)
    return asof.splice(observed, ahead).select("request_id", "ts", "airtemp", "pressure")


@query("""SELECT c.series_id, c.reference_time, c.target_time, c.wassertemp, w.airtemp, w.precip FROM resolved c LEFT JOIN clean_weather w
    ON w.series_id = c.series_id AND w.ts = c.target_time""")
def left_join_weather(spark, folder):
    stored = selection.resolve_precedence(fx.candidates(spark, folder))
    weather = selection.keep_one(fx.clean_weather(spark, folder), ["series_id", "ts"], [F.asc("airtemp")])
    joined = stored.join(weather.withColumnRenamed("ts", "target_time"), ["series_id", "target_time"], "left")
    return joined.select("series_id", "reference_time", "target_time", "wassertemp", "airtemp", "precip")


@query("""SELECT request_id, series_id, offset_hours, reference_time, kind, covariate_source, is_honest, label, target_time, channel, q,
    round(value, 5) AS value FROM every_backtest""")
def tiered_backtest(spark, folder):
    """Every request: its forecast from the best tier, or one row without a kind where its context is too short."""
    return rounded(_backtests(spark, folder).drop("from_archive"), "value", digits=5)


def _backtests(spark, folder):
    gauge, weather = held(spark, folder)
    return backtests.resolve_backtests(
        fx.requests(gauge), fx.archive(gauge), fx.snapshots(gauge), gauge,
        weather, short="keep",
    )


@query("""SELECT series_id, reference_time, target_time, kind, channel, q, round(value, 5) AS value FROM (
    SELECT series_id, reference_time, target_time, kind, channel, q, value, 1 AS stored FROM archive UNION ALL
    SELECT DISTINCT series_id, reference_time, target_time, kind, channel, q, value, 0 FROM backtests WHERE NOT from_archive)
    QUALIFY row_number() OVER (PARTITION BY series_id, reference_time, target_time, channel, q
    ORDER BY CASE kind WHEN 'live' THEN 2 WHEN 'replay' THEN 1 ELSE 0 END DESC, stored DESC) = 1""")
def backtest_archiving(spark, folder):
    """Recomputed backtests enter the archive with their kind and never displace a better row."""
    fresh = backtests.to_archive(_backtests(spark, folder), F.lit("2000-01-01").cast("timestamp"))
    merged = upserts.merge_forecasts(fx.archive(fx.gauge(spark, folder)), fresh, long=True)
    return rounded(merged.select("series_id", "reference_time", "target_time", "kind", "channel", "q", "value"), "value", digits=5)


# ---- scores ----------------------------------------------------------------------------------------------------


@query("SELECT series_id, round(avg(abs(actual - value)), 6) AS mae FROM quantiles WHERE q = 0.5 GROUP BY 1")
def mae(spark, folder):
    middle = fx.quantiles(spark, folder).where(F.col("q") == 0.5)
    return rounded(middle.groupBy("series_id").agg(metrics.absolute_error("actual", "value").alias("mae")), "mae")


@query("SELECT series_id, round(avg(crps), 6) AS crps, count(*) AS steps FROM crps_steps GROUP BY 1")
def crps_trapz(spark, folder):
    steps = metrics.crps_steps(fx.quantiles(spark, folder))
    return rounded(steps.groupBy("series_id").agg(F.avg("crps").alias("crps"), F.count(F.lit(1)).alias("steps")), "crps")


@query("""SELECT series_id, round(avg(crps), 6) AS crps FROM (SELECT series_id, target_time,
    CASE WHEN count(*) FILTER (WHERE value IS NULL OR actual IS NULL) = 0 THEN coalesce(sum(part), 0) END AS crps FROM (
    SELECT *, CASE WHEN actual < (value + lag(value) OVER w) / 2 THEN power((q + lag(q) OVER w) / 2, 2) ELSE power(1 - (q + lag(q) OVER w) / 2, 2) END
    * (value - lag(value) OVER w) AS part FROM quantiles
    WINDOW w AS (PARTITION BY series_id, reference_time, target_time ORDER BY q)) GROUP BY 1, 2) GROUP BY 1""")
def crps_midpoint(spark, folder):
    steps = metrics.crps_midpoint_steps(fx.quantiles(spark, folder))
    return rounded(steps.groupBy("series_id").agg(F.avg("crps").alias("crps")), "crps")


@query("""SELECT series_id, round(avg(CASE WHEN low IS NOT NULL AND high IS NOT NULL THEN (high - low) + 2 / 0.5 * greatest(low - actual, 0)
    + 2 / 0.5 * greatest(actual - high, 0) END), 6) AS score FROM (SELECT series_id, target_time, any_value(actual) AS actual,
    max(value) FILTER (q = 0.25) AS low, max(value) FILTER (q = 0.75) AS high FROM quantiles GROUP BY 1, 2) GROUP BY 1""")
def interval_score(spark, folder):
    score = metrics.interval_score(F.col("actual"), F.col("low"), F.col("high"), 0.5)
    return rounded(fx.bands(spark, folder, 0.25, 0.75).groupBy("series_id").agg(F.avg(score).alias("score")), "score")


@query("""SELECT series_id, reference_time, round(avg(coalesce(actual BETWEEN low AND high, false)::INTEGER), 6) AS coverage, count(*) AS steps
    FROM bands GROUP BY 1, 2""")
def coverage(spark, folder):
    return rounded(metrics.coverage(fx.bands(spark, folder), keys=["series_id", "reference_time"]), "coverage")


@query("""SELECT series_id, horizon, round(avg(mae), 6) AS mae, round(avg(crps), 6) AS crps FROM (
    SELECT q.series_id, q.reference_time, CASE WHEN hour(q.target_time) < 12 THEN 'near' ELSE 'far' END AS horizon,
    avg(abs(q.actual - q.value)) FILTER (q.q = 0.5) AS mae, avg(c.crps) AS crps FROM quantiles q JOIN crps_steps c USING (series_id, reference_time, target_time)
    GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def mean_scores(spark, folder):
    """Scores per day and horizon, then averaged over days, missing days skipped."""
    rows = fx.quantiles(spark, folder)
    steps = backtests.score_steps(rows, metrics.STEP)
    horizon = F.when(F.hour("target_time") < 12, "near").otherwise("far").alias("horizon")
    per_day = steps.groupBy("series_id", "reference_time", horizon).agg(F.avg("error").alias("mae"), F.avg("crps").alias("crps"))
    return rounded(metrics.mean_scores(per_day, ["series_id", "horizon"], ["mae", "crps"]), "mae", "crps")


# ---- gates -----------------------------------------------------------------------------------------------------


@query("""SELECT s.series_id, count(q.series_id) AS rows, count(q.series_id) > 0 AS passed FROM (SELECT DISTINCT event_type AS series_id FROM events
    UNION ALL SELECT DISTINCT o_orderpriority FROM orders) s LEFT JOIN quantiles q USING (series_id) GROUP BY 1""")
def emptiness_gate(spark, folder):
    wanted = fx.events(spark, folder).select(F.col("event_type").alias("series_id")).unionByName(
        fx.table(spark, folder, "orders").select(F.col("o_orderpriority").alias("series_id"))
    )
    return quality.emptiness_gate(wanted, fx.quantiles(spark, folder))


@query("""SELECT series_id, channel, q, count(*) FILTER (value IS NULL) AS missing, round(min(value), 6) AS lowest, round(max(value), 6) AS highest,
    count(*) FILTER (value IS NULL) = 0 AND min(value) >= -10 AND max(value) <= 35 AS passed FROM quantiles GROUP BY 1, 2, 3""")
def range_gate(spark, folder):
    return rounded(quality.range_gate(fx.quantiles(spark, folder)), "lowest", "highest")


@query("""SELECT c.series_id, count(DISTINCT c.target_time) FILTER (g.ts IS NOT NULL) AS leaked,
    count(DISTINCT c.target_time) FILTER (g.ts IS NOT NULL) = 0 AS passed FROM candidates c LEFT JOIN (SELECT * FROM gauge WHERE value IS NOT NULL) g
    ON g.series_id = c.series_id AND g.ts = c.target_time GROUP BY 1""")
def leak_gate(spark, folder):
    actuals = fx.gauge(spark, folder).withColumnRenamed("value", "actual")
    return quality.leak_gate(fx.candidates(spark, folder), actuals)


@query("""SELECT b.series_id, b.reference_time, round(avg(CASE WHEN g.value IS NOT NULL THEN coalesce(g.value BETWEEN b.low AND b.high, false)::INTEGER END), 6)
    AS coverage, count(g.value) AS steps, coalesce(avg(CASE WHEN g.value IS NOT NULL THEN coalesce(g.value BETWEEN b.low AND b.high, false)::INTEGER END)
    >= 0.8, true) AS passed FROM bands b LEFT JOIN gauge g ON g.series_id = b.series_id AND g.ts = b.target_time GROUP BY 1, 2""")
def coverage_gate(spark, folder):
    actuals = fx.gauge(spark, folder).withColumnRenamed("value", "actual")
    return rounded(
        quality.coverage_gate(fx.bands(spark, folder).drop("actual"), actuals, keys=["series_id", "reference_time"]), "coverage"
    )


@query("""SELECT series_id, reference_time, sum(crossed)::BIGINT AS crossings, sum(bad)::BIGINT AS not_finite, count(DISTINCT target_time) AS steps,
    sum(crossed) = 0 AND sum(bad) = 0 AND count(DISTINCT target_time) = 24 AS passed FROM (SELECT *, (value IS NULL)::INTEGER AS bad,
    coalesce(value < lag(value) OVER (PARTITION BY series_id, reference_time, target_time, channel ORDER BY q) - 1e-6, false)::INTEGER AS crossed
    FROM quantiles) GROUP BY 1, 2""")
def quantile_order_gate(spark, folder):
    return quality.shape_gate(fx.quantiles(spark, folder), keys=["series_id", "reference_time"], horizon=24)


# ---- reshaping -------------------------------------------------------------------------------------------------


@query("SELECT series_id, date, round(wassertemp, 6) AS wassertemp, round(airtemp_96, 6) AS airtemp_96, round(pressure_96, 6) AS pressure_96 FROM wide")
def pivot_channels(spark, folder):
    long = forecasting.assemble_long(*held(spark, folder))
    return rounded(reshape.to_wide(long), *CHANNELS)


@query("""SELECT series_id, target_time, l AS q_low, h AS q_high, round(max(value) FILTER (q = l), 6) AS low, round(max(value) FILTER (q = h), 6) AS high
    FROM quantiles, (SELECT unnest([0.01::DOUBLE, 0.05, 0.25]) AS l, unnest([0.99::DOUBLE, 0.95, 0.75]) AS h) GROUP BY 1, 2, 3, 4""")
def quantile_bands(spark, folder):
    return rounded(reshape.quantile_bands(fx.quantiles(spark, folder), keys=["series_id", "target_time"]), "low", "high")


@query("""SELECT series_id, target_time, channel, q, round(value, 6) AS value FROM quantiles""")
def quantile_names(spark, folder):
    """Long quantiles to named columns and back through the names."""
    keys = ["series_id", "target_time"]
    names = [f"wassertemp_q{q}" for q in QUANTILES]
    wide = reshape.quantiles_to_wide(fx.quantiles(spark, folder), keys=keys, columns=names)
    return rounded(reshape.quantiles_to_long(wide, keys=keys), "value")


@query("""SELECT series_id, anchor, fetched_at, ts, CASE WHEN any_new THEN new_air ELSE old_air END AS lufttemperatur_c,
    CASE WHEN any_press THEN new_press ELSE old_press END AS pressure FROM (SELECT *,
    bool_or(new_air IS NOT NULL) OVER (PARTITION BY series_id, anchor, fetched_at) AS any_new,
    bool_or(new_press IS NOT NULL) OVER (PARTITION BY series_id, anchor, fetched_at) AS any_press FROM layouts)""",
       layouts="""SELECT series_id, anchor, fetched_at, ts, airtemp AS old_air, pressure AS old_press,
       CASE WHEN hour(anchor) % 3 = 0 AND epoch_us(ts) > epoch_us(anchor) THEN airtemp + 1 END AS new_air,
       CASE WHEN hour(anchor) % 3 = 1 THEN pressure + 1 END AS new_press FROM snapshots""")
def canonical_weather(spark, folder):
    """Snapshots of either layout: a third carries processed air, a third processed pressure."""
    s = fx.snapshots(fx.gauge(spark, folder)).withColumnRenamed("reference_time", "anchor")
    turn = F.hour("anchor") % 3
    both = s.select(
        "series_id", "anchor", "fetched_at", "ts", F.col("airtemp").alias("temperature"), F.col("pressure").alias("pressure_msl"),
        F.when((turn == 0) & (F.col("ts") > F.col("anchor")), F.col("airtemp") + 1).alias("lufttemperatur_c"),
        F.when(turn == 1, F.col("pressure") + 1).alias("pressure"),
    )
    return reshape.canonical_weather(both).select("series_id", "anchor", "fetched_at", "ts", "lufttemperatur_c", "pressure")


@query("""SELECT 'gauge' AS part, series_id, ts, value, NULL::DOUBLE AS airtemp FROM gauge UNION ALL
    SELECT 'weather', series_id, ts, NULL, airtemp FROM clean_weather""")
def union_drift(spark, folder):
    """Parts with different columns under one roof."""
    left = fx.gauge(spark, folder).withColumn("part", F.lit("gauge"))
    right = fx.clean_weather(spark, folder).select("series_id", "ts", "airtemp").withColumn("part", F.lit("weather"))
    return left.unionByName(right, allowMissingColumns=True).select("part", "series_id", "ts", "value", "airtemp")


@query("""SELECT series_id, ts FROM gauge WHERE value IS NOT NULL INTERSECT SELECT series_id, target_time FROM candidates""")
def index_intersection(spark, folder):
    held = fx.gauge(spark, folder).where(F.col("value").isNotNull()).select("series_id", "ts")
    return held.intersect(fx.candidates(spark, folder).select("series_id", F.col("target_time").alias("ts")))


# ---- times, text and payloads ----------------------------------------------------------------------------------


@query(f"SELECT event_id, {sq.local('ts')} AS local_time FROM events")
def utc_to_local(spark, folder):
    return fx.events(spark, folder).select("event_id", zones.to_local(F.col("ts")).alias("local_time"))


@query("""SELECT series_id || '|spring' AS series_id, readings, CASE WHEN wall < '2024-03-31 02:00' THEN wall - INTERVAL 1 HOUR
    WHEN wall < '2024-03-31 03:00' THEN TIMESTAMP '2024-03-31 01:00' ELSE wall - INTERVAL 2 HOUR END AS ts, wall
    FROM (SELECT *, hour_at + INTERVAL 80 DAY AS wall FROM readings_by_hour) UNION ALL
    SELECT series_id || '|autumn', readings, CASE WHEN wall < '2024-10-27 02:00' THEN wall - INTERVAL 2 HOUR WHEN wall >= '2024-10-27 03:00'
    THEN wall - INTERVAL 1 HOUR ELSE hour_at + INTERVAL 290 DAY END AS ts, wall FROM (
    SELECT *, count(*) OVER (PARTITION BY series_id, wall) AS copies FROM (SELECT *, """ + sq.local("hour_at + INTERVAL 290 DAY") + """ AS wall
    FROM readings_by_hour)) WHERE copies = 2 OR wall < '2024-10-27 02:00' OR wall >= '2024-10-27 03:00'""",
       readings_by_hour="SELECT series_id, date_trunc('hour', ts) AS hour_at, count(*) AS readings FROM obs GROUP BY 1, 2")
def local_to_utc(spark, folder):
    solved = zones.from_local(fx.wall_times(spark, folder), order="at")
    return solved.select("series_id", "readings", "wall", "ts")


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN date_trunc('second', ts) END AS instant,
    CASE WHEN event_id % 3 <> 2 THEN date_trunc('minute', ts) END AS wall, CASE WHEN event_id % 13 <> 0 THEN value END AS number FROM events""")
def parse_text(spark, folder):
    """Times and numbers written in several spellings, some unreadable, read back."""
    e = fx.events(spark, folder)
    pick = F.col("event_id") % 5
    stamp = (
        F.when(pick == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ssXXX"))
        .when(pick == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX"))
        .when(pick == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(pick == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("not a time")
    )
    third = F.col("event_id") % 3
    clock = F.date_format("ts", "dd.MM.yyyy HH:mm")
    gauge_text = F.when(third == 0, clock).when(third == 1, F.concat(clock, F.lit(" Uhr"))).otherwise("31.02.2024 99:00")
    number = F.when(fx.every(13), "--").otherwise(F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")))
    texts = e.select("event_id", stamp.alias("a"), gauge_text.alias("b"), number.alias("c"))
    return texts.select(
        "event_id", scalars.as_utc(F.col("a")).alias("instant"), scalars.gauge_wall_time(F.col("b")).alias("wall"),
        scalars.decimal_comma(F.col("c")).alias("number"),
    )


@query("""SELECT series_id, event_id // 64 AS payload_id, ts, temperature, precipitation, pressure_msl FROM raw_weather
    WHERE (event_id // 64) % 10 NOT IN (3, 7)""")
def json_payload(spark, folder):
    parsed = payloads.parse_weather(fx.payloads(spark, folder))
    return payloads.weather_hours(parsed, ["series_id", "payload_id"]).select(
        "series_id", "payload_id", "ts", "temperature", "precipitation", "pressure_msl"
    )


@query("""SELECT status, count(*) AS payloads FROM (SELECT DISTINCT series_id, event_id // 64 AS payload_id,
    CASE (event_id // 64) % 10 WHEN 3 THEN 'failed' WHEN 7 THEN 'empty' ELSE 'ok' END AS status FROM raw_weather) GROUP BY 1""")
def json_payload_status(spark, folder):
    return payloads.parse_weather(fx.payloads(spark, folder)).groupBy("status").agg(F.count(F.lit(1)).alias("payloads"))


@query("""SELECT series_id, event_id // 64 AS payload_id, date_trunc('minute', ts) AS wall, value FROM obs WHERE (event_id // 64) % 5 <> 4""")
def html_table(spark, folder):
    return payloads.gauge_readings(fx.gauge_pages(spark, folder), "wassertemp", keys=["series_id", "payload_id"])


@query(f"""SELECT series_id, strftime({sq.local('reference_time')}, '%Y-%m-%d %H:%M') AS reference_time,
    strftime({sq.local('target_time')}, '%Y-%m-%d %H:%M') AS target_time, wassertemp FROM resolved""")
def readable_export(spark, folder):
    stored = selection.resolve_precedence(fx.candidates(spark, folder))
    text = exports.readable(exports.readable(stored), ts="reference_time")
    return text.select("series_id", "reference_time", "target_time", "wassertemp")


@query(f"""SELECT series_id, strftime(ts, '%Y-%m') AS month_key, hour({sq.local('ts')})::INTEGER AS local_hour, month({sq.local('ts')})::INTEGER AS local_month,
    CASE series_id WHEN 'click' THEN 'first_river' WHEN 'view' THEN 'second_river' ELSE series_id END AS river, count(*) AS readings
    FROM obs GROUP BY ALL""")
def calendar_parts(spark, folder):
    local = zones.to_local(F.col("ts"))
    river = scalars.relabel(F.col("series_id"), {"click": "first_river", "view": "second_river"})
    return fx.obs(spark, folder).groupBy(
        "series_id", scalars.month_key(F.col("ts")).alias("month_key"), F.hour(local).alias("local_hour"),
        F.month(local).alias("local_month"), river.alias("river"),
    ).agg(F.count(F.lit(1)).alias("readings"))


# ---- forecasting -----------------------------------------------------------------------------------------------


@query("SELECT request_id, target_time, channel, q, round(value, 5) AS value FROM forecast",
       forecast="SELECT c.* FROM computed c",
       tier1="SELECT * FROM requests WHERE false", tier2="""SELECT *, ref AS anchor, ref AS fetched_at FROM requests WHERE false""")
def forecast_profile(spark, folder):
    gauge, weather = held(spark, folder)
    context = forecasting.context_rows(forecasting.assemble(gauge, weather), fx.requests(gauge), short="skip")
    return rounded(forecasting.forecast_batch(context), "value", digits=5)


@query("""SELECT request_id, ts, round(wassertemp, 6) AS wassertemp, round(airtemp_96, 6) AS airtemp_96, round(pressure_96, 6) AS pressure_96
    FROM contexts""", tier1="SELECT * FROM requests WHERE false",
       tier2="""SELECT *, ref AS anchor, ref AS fetched_at FROM requests WHERE false""")
def context_windows(spark, folder):
    gauge, weather = held(spark, folder)
    wide = forecasting.assemble(gauge, weather)
    return rounded(forecasting.context_rows(wide, fx.requests(gauge), short="skip"), *CHANNELS)


OLD_OFFSETS = (96, 192, 480)
OLD_REQUESTS = {
    "requests": sq.CTES["requests"].replace("[96, 192, 288]", str(list(OLD_OFFSETS))),
    "tier1": "SELECT * FROM requests WHERE false", "tier2": "SELECT *, ref AS anchor, ref AS fetched_at FROM requests WHERE false",
}


def _seasonal_naive():
    """A small model in place of a network: the last day again, and levels by the mean step of each channel."""
    steps = pd.RangeIndex(1, 97)
    levels = np.array(QUANTILES)

    def answer(contexts: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for request, rows in contexts.groupby("request_id", sort=False):
            last = rows["ts"].iloc[-1]
            for channel in CHANNELS:
                values = rows[channel].to_numpy()
                day = values[-24:][(steps - 1) % 24]
                spread = np.abs(np.diff(values)).mean()
                parts.append(pd.DataFrame({
                    "request_id": request, "target_time": np.repeat(last + pd.to_timedelta(steps, unit="h"), len(levels)), "channel": channel,
                    "q": np.tile(levels, len(steps)), "value": (day[:, None] + (levels - 0.5) * spread).ravel(),
                }))
        return pd.concat(parts, ignore_index=True)

    return answer


@query(f"""SELECT r.request_id, f.target_time, f.channel, f.q, round(f.value, 6) AS value, CASE WHEN f.request_id IS NULL THEN 'short' ELSE 'ok' END AS status
    FROM requests r LEFT JOIN forecast f USING (request_id)""",
       forecast=f"""SELECT d.request_id, d.channel, d.last_ts + INTERVAL 1 HOUR * h.step AS target_time, l.q, d.value + (l.q - 0.5) * s.spread AS value
    FROM last_day d JOIN mean_steps s USING (request_id, channel), (SELECT unnest(generate_series(1, 96)) AS step) h, (SELECT unnest({sq.LEVEL_LIST}) AS q) l
    WHERE (h.step - 1) % 24 = d.place""",
       last_day="""SELECT request_id, channel, value, max(ts) OVER p AS last_ts, 24 - row_number() OVER (PARTITION BY request_id, channel ORDER BY ts DESC) AS place
    FROM context_long WINDOW p AS (PARTITION BY request_id, channel) QUALIFY place >= 0""",
       mean_steps="""SELECT request_id, channel, avg(abs(step)) AS spread FROM (SELECT request_id, channel,
    value - lag(value) OVER (PARTITION BY request_id, channel ORDER BY ts) AS step FROM context_long) GROUP BY 1, 2""", **OLD_REQUESTS)
def plugged_forecast(spark, folder):
    """A plugged model over packs of contexts; requests that reach too far back come out with their status."""
    gauge, weather = held(spark, folder)
    model = forecasting.Plugged("seasonal-naive", _seasonal_naive)
    answers = forecasting.answer_requests(forecasting.assemble(gauge, weather), fx.requests(gauge, OLD_OFFSETS), model)
    return rounded(answers.select("request_id", "target_time", "channel", "q", "value", "status"), "value")


@query("""SELECT r.request_id, r.series_id, least(count(w.date), 384) AS have, count(w.date) >= 384 AS complete
    FROM requests r LEFT JOIN wide w ON w.series_id = r.series_id AND w.date <= r.ref GROUP BY 1, 2""")
def context_status(spark, folder):
    """Every request, with the context it has: the ones that other queries leave out as too short show here."""
    gauge, weather = held(spark, folder)
    wide = forecasting.assemble(gauge, weather)
    return forecasting.context_status(wide, fx.requests(gauge))


@query("""SELECT * FROM (SELECT series_id, count(*) AS rows, (min(gap) / 1000000)::BIGINT AS step_seconds, min(gap) = max(gap) AS is_regular FROM (
    SELECT series_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY series_id ORDER BY ts)) AS gap FROM gauge) GROUP BY 1)""")
def regular_grid_check(spark, folder):
    return timeseries.step_check(fx.gauge(spark, folder)).select("series_id", "rows", "step_seconds", "is_regular")


@query("""SELECT series_id, s.step::INTEGER AS step, last_ts + INTERVAL 1 HOUR * s.step AS target_time FROM (SELECT series_id, max(ts) AS last_ts FROM gauge
    GROUP BY 1), (SELECT unnest(generate_series(1, 96)) AS step) s""")
def future_index(spark, folder):
    return timeseries.future_index(fx.gauge(spark, folder), 96)


@query("SELECT series_id, max(ts) AS last_ts FROM gauge WHERE value IS NOT NULL GROUP BY 1")
def last_observation(spark, folder):
    return timeseries.last_known(fx.gauge(spark, folder))


@query("""SELECT series_id, least(min(w.airtemp), min(g.value)) AS low, greatest(max(w.airtemp), max(g.value)) AS high FROM gauge g
    JOIN clean_weather w USING (series_id, ts) GROUP BY 1""")
def spans(spark, folder):
    gauge, weather = fx.gauge(spark, folder), fx.clean_weather(spark, folder)
    return metrics.widen([metrics.span(gauge, "value"), metrics.span(weather, "airtemp")])


@query(
    f"""SELECT series_id, hour, q, round(CASE WHEN q = 0.5 THEN location + greatest(scale, 1e-6) * raw_loc ELSE location + greatest(scale, 1e-6) *
    (raw_loc + width * sign(q - 0.5) * sqrt(freedom * greatest(1 / (power(cos((lo + hi) / 2), 2) + 1e-8) - 1, 0))) END, 3) AS value FROM solved""",
    raw_params="""SELECT event_type AS series_id, hour(ts)::INTEGER AS hour, avg(value) / 10 AS location, stddev_pop(value) / 10 AS scale,
        (avg(user_id) / 40 * CASE WHEN max(hour(ts)) % 3 = 0 THEN 100 ELSE 1 END) AS raw_freedom, (avg(value) - 50) / 100 AS raw_loc, ln(1 + count(*)) / 10 AS raw_scale FROM events GROUP BY 1, 2""",
    t_params=f"""SELECT *, greatest(raw_freedom, 0) + ln(1 + exp(-abs(raw_freedom))) + 2 AS freedom,
        greatest(raw_scale, 0) + ln(1 + exp(-abs(raw_scale))) + 1e-6 AS width FROM raw_params, (SELECT unnest({sq.LEVEL_LIST}) AS q)""",
    # Share of a Student-t between 0 and sqrt(v) * tan(a): integral of cos^(v-1), by Simpson's rule.
    halving="""SELECT *, 0::DOUBLE AS lo, (pi() / 2)::DOUBLE AS hi, 0 AS turn FROM t_params UNION ALL
        SELECT series_id, hour, location, scale, raw_freedom, raw_loc, raw_scale, q, freedom, width,
        CASE WHEN share < abs(q - 0.5) THEN mid ELSE lo END, CASE WHEN share < abs(q - 0.5) THEN hi ELSE mid END, turn + 1 FROM (
        SELECT *, (lo + hi) / 2 AS mid, exp(lgamma((freedom + 1) / 2) - lgamma(freedom / 2)) / sqrt(pi()) * ((lo + hi) / 2) / 400 / 3 *
        list_sum(list_transform(range(0, 401), lambda i: (CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
        * power(cos((lo + hi) / 2 * i / 400), freedom - 1))) AS share FROM halving WHERE turn < 40)""",
    solved="SELECT * FROM halving WHERE turn = 40",
)
def t_quantiles(spark, folder):
    """Distribution parameters per series and hour, expanded to seven quantiles."""
    raw = fx.events(spark, folder).groupBy(F.col("event_type").alias("series_id"), F.hour("ts").alias("hour")).agg(
        (F.avg("value") / 10).alias("location"), (F.stddev_pop("value") / 10).alias("scale"),
        (F.avg("user_id") / 40 * F.when(F.hour("ts") % 3 == 0, 100).otherwise(1)).alias("raw_freedom"), ((F.avg("value") - 50) / 100).alias("raw_loc"),
        (F.log(1 + F.count(F.lit(1))) / 10).alias("raw_scale"),
    )
    out = expand_quantiles(raw, QUANTILES, raw_freedom="raw_freedom", raw_loc="raw_loc", raw_scale="raw_scale")
    return rounded(out.select("series_id", "hour", "q", "value"), "value", digits=3)


# The model frame: target, air and other at every hour of a series.
FRAME = {
    "frame": """SELECT h.series_id, h.ts, h.value AS target, coalesce(w.airtemp_pv, w.airtemp_nv) AS air, coalesce(w.pressure_pv, w.pressure_nv) AS other FROM hourly h
        JOIN weather_filled w USING (series_id, ts)""",
    "weather_filled": sq.neighbours("clean_weather", ["airtemp", "pressure"]),
}


def _model_frame(spark, folder):
    weather = timeseries.fill_both_ways(
        fx.clean_weather(spark, folder).select("series_id", "ts", F.col("airtemp").alias("air"), F.col("pressure").alias("other")), ["air", "other"]
    )
    frame = fx.hourly(spark, folder).withColumnRenamed("value", "target").join(weather, ["series_id", "ts"])
    return fx.settled(frame, "frame")


@query(
    f"""SELECT series_id, horizon, configuration, round(avg(mae), 6) AS mae, round(avg(crps), 6) AS crps FROM (
    SELECT origin_id, series_id, h AS horizon, configuration, avg(error) AS mae, avg(crps) AS crps FROM step_scores,
    (SELECT unnest([24::INTEGER, 96::INTEGER]) AS h) WHERE step <= h GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""",
    **FRAME,
    origins="""SELECT series_id, b.b AS back, series_id || '|' || b.b AS origin_id, hi - INTERVAL 1 HOUR * (b.b + 96) AS ref FROM (
        SELECT series_id, max(ts) AS hi, min(ts) AS lo FROM frame GROUP BY 1), (SELECT unnest([0, 240, 480]) AS b) b
        WHERE hi - INTERVAL 1 HOUR * (b.b + 96) >= lo""",
    past=f"""SELECT o.origin_id, f.*, hour({sq.local('f.ts')}) AS season, avg(target) OVER (PARTITION BY o.origin_id, hour({sq.local('f.ts')})) AS loc
        FROM origins o JOIN frame f ON f.series_id = o.series_id AND f.ts <= o.ref AND f.ts > o.ref - INTERVAL 512 HOUR""",
    fit="""SELECT origin_id, sqrt(avg((target - loc) * (target - loc))) AS scale, coalesce(regr_slope(target - loc, air), 0) AS air_slope,
        coalesce(regr_slope(target - loc, other), 0) AS other_slope, avg(air) AS air_mean, avg(other) AS other_mean, arg_max(air, ts) AS air_last,
        arg_max(other, ts) AS other_last FROM past GROUP BY 1""",
    profile="SELECT DISTINCT origin_id, season, loc FROM past",
    setups="""SELECT unnest([{'n': 'Univariate', 'a': 0, 'o': 0, 'f': false}, {'n': '+ Luft (Past)', 'a': 1, 'o': 0, 'f': false},
        {'n': '+ Luft (Past+Future)', 'a': 1, 'o': 0, 'f': true}, {'n': '+ Fluss (Past)', 'a': 0, 'o': 1, 'f': false},
        {'n': '+ Fluss+Luft (Past)', 'a': 1, 'o': 1, 'f': false}, {'n': '+ Fluss+Luft (Past+Future)', 'a': 1, 'o': 1, 'f': true}]) AS c""",
    ahead="""SELECT o.origin_id, o.series_id, c.c.n AS configuration, s.step, f.target AS actual, p.loc + (c.c.a * t.air_slope
        * ((CASE WHEN c.c.f THEN f.air ELSE t.air_last END) - t.air_mean) + c.c.o * t.other_slope * (t.other_last - t.other_mean))
        / greatest(c.c.a + c.c.o, 1) AS loc, t.scale FROM origins o JOIN fit t USING (origin_id), (SELECT unnest(generate_series(1, 96)) AS step) s, setups c,
        frame f, profile p WHERE f.series_id = o.series_id AND f.ts = o.ref + INTERVAL 1 HOUR * s.step AND p.origin_id = o.origin_id
        AND p.season = hour(""" + sq.local("f.ts") + """)""",
    drawn=f"""SELECT a.*, l.l.q AS q, a.loc + a.scale * l.l.t AS value, 2 * CASE WHEN actual >= a.loc + a.scale * l.l.t
        THEN (actual - (a.loc + a.scale * l.l.t)) * l.l.q ELSE (a.loc + a.scale * l.l.t - actual) * (1 - l.l.q) END AS loss
        FROM ahead a, (SELECT unnest({sq.levels_with_t(sq.DECILES)}) AS l) l""",
    step_scores="""SELECT origin_id, series_id, configuration, step, max(abs(actual - value)) FILTER (q = 0.5) AS error, sum(area) AS crps FROM (
        SELECT *, (loss + lag(loss) OVER w) / 2 * (q - lag(q) OVER w) AS area FROM drawn
        WINDOW w AS (PARTITION BY origin_id, configuration, step ORDER BY q)) GROUP BY 1, 2, 3, 4""",
)
def experiment_grid(spark, folder):
    """Covariate configurations compared over horizons and rolling windows."""
    return rounded(backtests.experiment_grid(_model_frame(spark, folder)), "mae", "crps")


@query(
    """SELECT series_id, configuration, step, count(*) AS origins, round(avg(abs(miss)), 6) AS mae, round(sqrt(avg(miss * miss)), 6) AS rmse FROM misses
    WHERE miss IS NOT NULL GROUP BY 1, 2, 3""",
    **FRAME,
    phased="SELECT *, hour(ts) AS phase FROM frame",
    past="""SELECT o.series_id, o.ts AS ref, f.ts, f.phase, f.target, f.air, f.other FROM phased o JOIN phased f ON f.series_id = o.series_id AND f.ts <= o.ts
        AND f.ts > o.ts - INTERVAL 336 HOUR""",
    complete="""SELECT *, avg(target) OVER w AS ym, avg(air) OVER w AS am, avg(other) OVER w AS bm FROM past
        WHERE target IS NOT NULL AND air IS NOT NULL AND other IS NOT NULL WINDOW w AS (PARTITION BY series_id, ref, phase)""",
    sums="""SELECT series_id, ref, sum((air - am) * (air - am)) AS aa, sum((other - bm) * (other - bm)) AS bb, sum((air - am) * (other - bm)) AS ab,
        sum((air - am) * (target - ym)) AS ya, sum((other - bm) * (target - ym)) AS yb FROM complete GROUP BY 1, 2""",
    whole="SELECT series_id, ref FROM past GROUP BY 1, 2 HAVING count(*) = 336",
    slopes="""SELECT s.*, ya / aa AS air_alone, yb / bb AS other_alone, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS air_both,
        (yb * aa - ya * ab) / (aa * bb - ab * ab) AS other_both FROM sums s JOIN whole USING (series_id, ref)""",
    seasons="SELECT DISTINCT series_id, ref, phase, ym, am, bm FROM complete",
    setups="""SELECT unnest([{'n': 'Univariate', 'a': 0, 'o': 0, 'f': false}, {'n': '+ Luft (Past)', 'a': 1, 'o': 0, 'f': false},
        {'n': '+ Luft (Past+Future)', 'a': 1, 'o': 0, 'f': true}, {'n': '+ Fluss (Past)', 'a': 0, 'o': 1, 'f': false},
        {'n': '+ Fluss+Luft (Past)', 'a': 1, 'o': 1, 'f': false}, {'n': '+ Fluss+Luft (Past+Future)', 'a': 1, 'o': 1, 'f': true}]) AS c""",
    misses="""SELECT b.series_id, c.c.n AS configuration, k.step, t.target - (m.ym + c.c.a * CASE WHEN c.c.o = 1 THEN b.air_both ELSE b.air_alone END
        * (CASE WHEN c.c.f THEN t.air ELSE l.air END - m.am) + c.c.o * CASE WHEN c.c.a = 1 THEN b.other_both ELSE b.other_alone END * (l.other - m.bm)) AS miss
        FROM slopes b JOIN phased l ON l.series_id = b.series_id AND l.ts = b.ref, (SELECT unnest([1::INTEGER, 24::INTEGER, 96::INTEGER]) AS step) k, setups c,
        phased t, seasons m WHERE t.series_id = b.series_id AND t.ts = b.ref + INTERVAL 1 HOUR * k.step AND m.series_id = b.series_id AND m.ref = b.ref
        AND m.phase = t.phase""",
)
def rolling_origins(spark, folder):
    """Covariate configurations fitted jointly at every hour of every series, two weeks back."""
    return rounded(rolling.rolling_origin_scores(_model_frame(spark, folder), days=14), "mae", "rmse")


def _comparison_sql() -> str:
    steps, picks = _greedy("score24", 3, 24)
    names = "hourly"
    lead = sq.sql(f"SELECT 1 FROM {names}")
    lead = lead[: lead.rindex(f"SELECT 1 FROM {names}")].rstrip()
    parts = []
    for model, levels, season, low, high, alpha in (
        ("profile", sq.LEVELS, f"hour({sq.local('ts')})", 0.25, 0.75, 0.5), ("level", sq.DECILES, "0", 0.1, 0.9, 0.2),
    ):
        parts.append(f"""{model}_past AS (SELECT *, {season} AS season, avg(value) OVER (PARTITION BY series_id, place, {season}) AS loc FROM (
            SELECT w.series_id, w.place, h.ts, h.value FROM chosen w JOIN hourly h ON h.series_id = w.series_id AND h.ts < w.ts
            AND h.ts >= w.ts - INTERVAL 384 HOUR)),
            {model}_fit AS (SELECT series_id, place, sqrt(avg((value - loc) * (value - loc))) AS scale FROM {model}_past GROUP BY 1, 2),
            {model}_season AS (SELECT DISTINCT series_id, place, season, loc FROM {model}_past),
            {model}_drawn AS (SELECT w.series_id, w.place, h.ts, h.value AS actual, l.l.q AS q, s.loc + f.scale * l.l.t AS value FROM chosen w
            JOIN (SELECT *, {season} AS season FROM hourly) h ON h.series_id = w.series_id AND h.ts >= w.ts AND h.ts < w.ts + INTERVAL 24 HOUR
            JOIN {model}_fit f ON f.series_id = w.series_id AND f.place = w.place JOIN {model}_season s ON s.series_id = w.series_id AND s.place = w.place
            AND s.season = h.season, (SELECT unnest({sq.levels_with_t(levels)}) AS l) l),
            {model}_score AS (SELECT series_id, place, '{model}' AS model, avg(error) AS mae, avg(crps) AS crps, avg((high - low) + 2 / {alpha}
            * greatest(low - actual, 0) + 2 / {alpha} * greatest(actual - high, 0)) AS interval_score FROM (SELECT series_id, place, ts, max(actual) AS actual,
            max(abs(actual - value)) FILTER (q = 0.5) AS error, sum(area) AS crps, max(value) FILTER (q = {low}) AS low, max(value) FILTER (q = {high}) AS high
            FROM (SELECT *, (loss + lag(loss) OVER w) / 2 * (q - lag(q) OVER w) AS area FROM (SELECT *, 2 * CASE WHEN actual >= value
            THEN (actual - value) * q ELSE (value - actual) * (1 - q) END AS loss FROM {model}_drawn) WINDOW w AS (PARTITION BY series_id, place, ts ORDER BY q))
            GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
    base = """placed AS (SELECT series_id, ts, value, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS start,
        count(*) OVER (PARTITION BY series_id) AS n FROM hourly), score24 AS (SELECT series_id, ts, start, score FROM (SELECT *,
        var_pop(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS score FROM placed)
        WHERE start >= 384 AND start < n - 97)"""
    return (
        f"{lead}, {base}, {steps}, chosen AS ({picks}), {', '.join(parts)} SELECT series_id, place, model, round(mae, 6) AS mae, round(crps, 6) AS crps, "
        "round(interval_score, 6) AS interval_score FROM profile_score UNION ALL SELECT series_id, place, model, round(mae, 6), round(crps, 6), "
        "round(interval_score, 6) FROM level_score"
    )


def model_comparison(spark, folder):
    """Two forecasters scored on the most volatile days of each series."""
    frame = fx.settled(fx.hourly(configure(spark), folder), "hourly")
    scored = selection.volatility_scores(frame, "value", 24, first_start=384, margin=96)
    windows = selection.spaced_top(scored, 3, 24).select("series_id", "place", "ts")
    return rounded(backtests.compare_models(frame, windows, 24), "mae", "crps", "interval_score")


CATALOGUE["model_comparison"] = Query(model_comparison, sq.steady(_comparison_sql()))


# ---- chart tables ----------------------------------------------------------------------------------------------


@query(f"""SELECT series_id, label, {sq.local('target_time')} AS local_time, round(value, 5) AS median, NOT is_honest AS dashed FROM labelled
    WHERE channel = 'wassertemp' AND q = 0.5""")
def chart_lines(spark, folder):
    return rounded(views.fan_lines(_backtests(spark, folder)), "median", digits=5)


@query(f"""SELECT series_id, label, {sq.local('target_time')} AS local_time, l AS q_low, h AS q_high, round(max(value) FILTER (q = l), 5) AS low,
    round(max(value) FILTER (q = h), 5) AS high FROM labelled, (SELECT unnest([0.01::DOUBLE, 0.05, 0.25]) AS l, unnest([0.99::DOUBLE, 0.95, 0.75]) AS h)
    WHERE channel = 'wassertemp' GROUP BY series_id, label, target_time, l, h HAVING count(*) FILTER (q = l) > 0 AND count(*) FILTER (q = h) > 0""")
def chart_bands(spark, folder):
    return rounded(views.fan_bands(_backtests(spark, folder)), "low", "high", digits=5)


@query(
    f"""SELECT series_id, reference_time AS label, {sq.local('target_time')} AS local_time, value, 'Max: ' || printf('%.1f', value) || '°C' || chr(10) ||
    strftime({sq.local('target_time')}, '%H:%M') AS note FROM found""",
    found=PEAKS,
    **_peak_steps("""SELECT series_id, label AS reference_time, target_time, round(value, 4) AS value FROM labelled
        WHERE channel = 'wassertemp' AND q = 0.5 AND value IS NOT NULL""", 18),
)
def chart_peaks(spark, folder):
    """Texts at the significant maxima of every median line."""
    return views.peak_notes(rounded(_backtests(spark, folder), "value", digits=4))


MAIN = """SELECT r.series_id, c.target_time, c.channel, c.q, c.value FROM computed c JOIN requests r USING (request_id) WHERE r.offset_hours = 96"""
NO_TIERS = {
    "tier1": "SELECT * FROM requests WHERE false", "tier2": "SELECT *, ref AS anchor, ref AS fetched_at FROM requests WHERE false",
    "main": MAIN,
}


def _main(gauge, weather, offset: int = 96):
    """One plain forecast per series, anchored ``offset`` hours before its last reading."""
    asked = fx.requests(gauge, (offset,))
    drawn = forecasting.forecast_batch(forecasting.context_rows(forecasting.assemble(gauge, weather), asked, short="skip"))
    return drawn.join(asked.select("request_id", "series_id"), "request_id")


@query(f"""SELECT l.series_id, x_from, x_to, round(least(b.low, w.low, g.low) - 0.5, 5) AS y_from, round(greatest(b.high, w.high, g.high) + 0.5, 5) AS y_to
    FROM limits l JOIN (SELECT series_id, min(value) AS low, max(value) AS high FROM main WHERE channel = 'wassertemp' AND q IN (0.01, 0.99) GROUP BY 1) b
    USING (series_id) JOIN (SELECT l.series_id, min(airtemp) AS low, max(airtemp) AS high FROM clean_weather JOIN limits l USING (series_id)
    WHERE {sq.local('ts')} BETWEEN x_from AND x_to GROUP BY 1) w USING (series_id) JOIN (SELECT l.series_id, min(value) AS low, max(value) AS high FROM gauge
    JOIN limits l USING (series_id) WHERE {sq.local('ts')} BETWEEN x_from AND x_to GROUP BY 1) g USING (series_id)""",
       limits=f"""SELECT series_id, min({sq.local('target_time')}) - INTERVAL 1 DAY AS x_from, max({sq.local('target_time')}) AS x_to FROM main GROUP BY 1""",
       **NO_TIERS)
def chart_axes(spark, folder):
    gauge, weather = held(spark, folder)
    axes = views.forecast_axes(fx.settled(_main(gauge, weather), "main"), gauge, weather)
    return rounded(axes, "y_from", "y_to", digits=5)


@query(f"""SELECT l.series_id, x_from, x_to, round(least(b.low, w.low) - 0.5, 5) AS y_from, round(greatest(b.high, w.high) + 0.5, 5) AS y_to, oracle_note
    FROM limits l JOIN (SELECT series_id, min(value) AS low, max(value) AS high FROM (SELECT series_id, channel, q, value FROM main UNION ALL
    SELECT series_id, channel, q, value FROM older) WHERE channel = 'wassertemp' AND q IN (0.01, 0.99) GROUP BY 1) b USING (series_id)
    JOIN (SELECT l.series_id, min(airtemp) AS low, max(airtemp) AS high FROM clean_weather JOIN limits l USING (series_id)
    WHERE {sq.local('ts')} BETWEEN x_from AND x_to GROUP BY 1) w USING (series_id)""",
       older="""SELECT r.series_id, c.target_time, c.channel, c.q, c.value FROM computed c JOIN requests r USING (request_id) WHERE r.offset_hours = 192""",
       limits=f"""SELECT series_id, coalesce(o.first_at, m.first_at) AS x_from, m.x_to, o.series_id IS NOT NULL AS oracle_note FROM (
       SELECT series_id, min({sq.local('target_time')}) AS first_at, max({sq.local('target_time')}) AS x_to FROM main GROUP BY 1) m LEFT JOIN (
       SELECT series_id, min({sq.local('target_time')}) AS first_at FROM older GROUP BY 1) o USING (series_id)""", **NO_TIERS)
def chart_backtest_axes(spark, folder):
    gauge, weather = held(spark, folder)
    older = fx.settled(_main(gauge, weather, 192), "older").withColumn("kind", F.lit("oracle"))
    axes = views.backtest_axes(fx.settled(_main(gauge, weather), "main"), older, weather)
    return rounded(axes, "y_from", "y_to", digits=5)


# ---- streams ---------------------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """The events as a stream; with ``files``, dealt out anew over so many files that arrive one per batch."""
    events = fx.table(spark, folder, "events")
    if files:
        path = fx.scratch(spark, "events")
        events.repartition(files, F.xxhash64("event_id")).write.parquet(path)
        stream = ingest.file_stream(spark, path, events.schema, files_per_batch=1)
    else:
        stream = ingest.file_stream(spark, folder, events.schema, glob="events.parquet")
    return stream.select(
        F.col("event_type").alias("series_id"), F.col("ts").cast("timestamp").alias("ts"), "value", "event_id", "user_id"
    )


@query("""SELECT series_id, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS value, count(*) AS readings FROM (SELECT event_type AS series_id, ts, value
    FROM events) GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def stream_hourly(spark, folder):
    """Hourly means of the event stream; the last hours stay open until nothing can be late for them."""
    path = fx.scratch(spark, "hourly")
    hours = ingest.hourly_means(_event_stream(spark, folder))
    run = hours.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-progress")
    run.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.schema(hours.schema).parquet(path), "value")


@query("""SELECT series_id, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS value, count(value) AS readings FROM (
    SELECT event_type AS series_id, ts, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2) GROUP BY 1, 2""")
def stream_late_repair(spark, folder):
    """Readings of all hours in each of four batches: every batch repairs hours that the batches before it had closed."""
    path = fx.scratch(spark, "repair")
    stream = _event_stream(spark, folder, files=4).select("series_id", "ts", "value", F.col("event_id").alias("write_seq"))
    ingest.maintain_hours(stream, f"{path}/readings", f"{path}/hours", f"{path}/progress").awaitTermination()
    return rounded(archives.read_store(spark, f"{path}/hours", ingest.HOURS), "value")


@query("""SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def stream_upsert(spark, folder):
    """Readings streamed into the observation store, out of order over several batches; the latest of each hour stays."""
    path = fx.scratch(spark, "observations")
    stream = _event_stream(spark, folder, files=4).select(
        "series_id", F.date_trunc("hour", "ts").alias("ts"), "value", F.col("event_id").alias("write_seq")
    )
    ingest.ingest_observations(stream, path, OBSERVATION, f"{path}-progress").awaitTermination()
    return archives.read_store(spark, path, OBSERVATION)


@query(f"""SELECT {WIDE_NAMES} FROM relabelled""", relabelled=RELABELLED + """
    QUALIFY row_number() OVER (PARTITION BY series_id, reference_time, target_time
    ORDER BY (CASE kind WHEN 'live' THEN 2 WHEN 'replay' THEN 1 ELSE 0 END) DESC, issued_at DESC NULLS LAST, write_seq DESC) = 1""")
def stream_forecasts(spark, folder):
    """Forecast rows streamed into the archive, out of order over several batches, under the precedence rule."""
    path = fx.scratch(spark, "stream-forecasts")
    names = [c.strip() for c in WIDE_NAMES.split(",")]
    schema = type(FORECAST_WIDE)([f for f in FORECAST_WIDE.fields if f.name in names])
    schema.add("wassertemp", "double")
    at = F.date_trunc("hour", "ts")
    kind = F.when(fx.kind_of() == "wishful", "oracle").otherwise(fx.kind_of())
    rows = _event_stream(spark, folder, files=4).select(
        "series_id", at.alias("reference_time"), (at + fx.hours(F.col("event_id") % 4 + 1)).alias("target_time"), kind.alias("kind"),
        F.concat(F.lit("src-"), (F.col("user_id") % 3).cast("string")).alias("covariate_source"),
        F.when(~fx.every(19), F.col("ts")).alias("issued_at"), F.lit("m1").alias("model_id"), F.lit("v1").alias("code_version"),
        F.col("value").alias("wassertemp"), F.col("event_id").alias("write_seq"),
    )
    ingest.ingest_forecasts(rows, path, schema, f"{path}-progress").awaitTermination()
    return archives.read_store(spark, path, schema).select(*names)
