"""The query catalogue again as plain SQL over the same tables, for side-by-side checks."""

from __future__ import annotations

import re

# Student-t quantiles with five degrees of freedom from published tables.
T5 = {
    0.01: -3.364929998907218, 0.05: -2.015048373333024, 0.25: -0.7266868438004227, 0.5: 0.0,
    0.75: 0.7266868438004227, 0.95: 2.015048373333024, 0.99: 3.364929998907218,
    0.1: -1.475884048824481, 0.2: -0.919543780236361, 0.3: -0.5594296444693683, 0.4: -0.2671808657041455,
    0.6: 0.2671808657041455, 0.7: 0.5594296444693683, 0.8: 0.919543780236361, 0.9: 1.475884048824481,
}
LEVELS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
DECILES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
LEVEL_LIST = "[" + ", ".join(f"{q}::DOUBLE" for q in LEVELS) + "]"


def levels_with_t(levels) -> str:
    return "[" + ", ".join(f"{{'q': {q}::DOUBLE, 't': {T5[q]!r}::DOUBLE}}" for q in levels) + "]"


def local(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin'"


def half_even(x: str) -> str:
    """Two decimals, ties to even."""
    scaled = f"(({x}) * 100)"
    return f"(CASE WHEN abs({scaled} - trunc({scaled})) = 0.5 THEN 2 * round({scaled} / 2) ELSE round({scaled}) END / 100)"


def rank(kind: str) -> str:
    return f"(CASE {kind} WHEN 'oracle' THEN 0 WHEN 'replay' THEN 1 WHEN 'live' THEN 2 ELSE -1 END)"


def neighbours(source: str, columns, keys="series_id", ts="ts") -> str:
    """Known readings at or before and at or after every row."""
    parts = []
    for c in columns:
        seen = f"CASE WHEN {c} IS NOT NULL THEN {ts} END"
        parts += [
            f"last_value({seen} IGNORE NULLS) OVER b AS {c}_pt", f"last_value({c} IGNORE NULLS) OVER b AS {c}_pv",
            f"first_value({seen} IGNORE NULLS) OVER f AS {c}_nt", f"first_value({c} IGNORE NULLS) OVER f AS {c}_nv",
        ]
    return (
        f"SELECT *, {', '.join(parts)} FROM {source} WINDOW "
        f"b AS (PARTITION BY {keys} ORDER BY {ts} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"f AS (PARTITION BY {keys} ORDER BY {ts} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    )


def blend(c: str, ts="ts") -> str:
    return (
        f"(CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pt IS NULL THEN NULL WHEN {c}_nt IS NULL THEN {c}_pv "
        f"ELSE {c}_pv + ({c}_nv - {c}_pv) * ((epoch_us({ts}) - epoch_us({c}_pt)) / (epoch_us({c}_nt) - epoch_us({c}_pt))) END)"
    )


def fill(c: str, ts="ts") -> str:
    return f"coalesce({blend(c, ts)}, {c}_nv)"


def grid(source: str, step="hour") -> str:
    return (
        f"SELECT s.series_id, u.ts FROM (SELECT series_id, min(date_trunc('{step}', ts)) AS lo, max(date_trunc('{step}', ts)) AS hi "
        f"FROM {source} GROUP BY 1) s, LATERAL (SELECT unnest(generate_series(s.lo, s.hi, INTERVAL 1 {step})) AS ts) u"
    )


CTES = {
    "obs": """SELECT event_type AS series_id, ts, CASE WHEN event_id % 13 <> 0 THEN value END AS value, event_id, user_id
        FROM events""",
    "obs_grid": grid("obs"),
    "gauge": """SELECT g.series_id, g.ts, h.value FROM obs_grid g LEFT JOIN (
        SELECT series_id, date_trunc('hour', ts) AS ts, arg_min(value, ts) FILTER (WHERE value IS NOT NULL) AS value
        FROM obs GROUP BY 1, 2) h USING (series_id, ts)""",
    "gauge_near": neighbours("gauge", ["value"]),
    "hour_means": """SELECT series_id, date_trunc('hour', ts) AS ts, avg(value) AS value FROM obs GROUP BY 1, 2""",
    "hourly_near": neighbours(
        "(SELECT g.series_id, g.ts, h.value FROM obs_grid g LEFT JOIN hour_means h USING (series_id, ts))", ["value"]),
    "hourly": """SELECT series_id, ts, coalesce(value_pv, value_nv) AS value FROM hourly_near""",
    "raw_weather": """SELECT event_type AS series_id, ts, event_id,
        CASE WHEN event_id % 11 <> 0 THEN (user_id % 30)::DOUBLE END AS temperature,
        CASE WHEN event_id % 7 <> 0 THEN (event_id % 10)::DOUBLE / 10 END AS precipitation,
        CASE WHEN event_id % 17 <> 0 THEN 990 + (event_id % 40)::DOUBLE END AS pressure_msl FROM events""",
    "dry_weather": """SELECT series_id, ts, temperature AS airtemp, pressure_msl AS pressure, coalesce(precipitation, 0) AS precip
        FROM raw_weather QUALIFY row_number() OVER (PARTITION BY series_id, ts ORDER BY event_id) = 1""",
    "weather_near": neighbours("dry_weather", ["airtemp", "pressure"]),
    "clean_weather": f"""SELECT g.series_id, g.ts, {half_even('h.airtemp')} AS airtemp, {half_even('h.pressure')} AS pressure,
        {half_even('coalesce(h.precip, 0)')} AS precip FROM obs_grid g LEFT JOIN (
        SELECT series_id, date_trunc('hour', ts) AS ts, avg({blend('airtemp')}) AS airtemp, avg({blend('pressure')}) AS pressure,
        sum(precip) AS precip FROM weather_near GROUP BY 1, 2) h USING (series_id, ts)""",
    "pairs": """SELECT 'click-' || v.series_id AS series_id, c.ts, c.value AS first_river, v.value AS second_river FROM hour_means c
        JOIN hour_means v USING (ts) WHERE c.series_id = 'click' AND v.series_id <> 'click'""",
    "days": """SELECT o_orderpriority AS series_id, date_trunc('day', o_orderdate)::TIMESTAMP AS ts, avg(o_totalprice) / 18000 AS value
        FROM orders GROUP BY 1, 2""",
    "days_grid": grid("days", "day"),
    "days_near": neighbours(
        "(SELECT g.series_id, g.ts, d.value FROM days_grid g LEFT JOIN days d USING (series_id, ts))", ["value"]),
    "daily": """SELECT series_id, ts, coalesce(value_pv, value_nv) AS value,
        row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS start, count(*) OVER (PARTITION BY series_id) AS n FROM days_near""",
    "candidates": """SELECT event_type AS series_id, date_trunc('hour', ts) AS reference_time,
        date_trunc('hour', ts) + INTERVAL 1 HOUR * (event_id % 4 + 1) AS target_time,
        CASE user_id % 4 WHEN 0 THEN 'live' WHEN 1 THEN 'replay' WHEN 2 THEN 'oracle' ELSE 'wishful' END AS kind,
        'src-' || (user_id % 3) AS covariate_source, CASE WHEN event_id % 19 <> 0 THEN ts END AS issued_at,
        'm1' AS model_id, 'v1' AS code_version, value AS wassertemp, event_id AS write_seq FROM events""",
    "resolved": f"""SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY series_id, reference_time, target_time
        ORDER BY {rank('kind')} DESC, issued_at DESC NULLS LAST, write_seq DESC) = 1""",
    "heads": """SELECT series_id, reference_time, kind, arg_min(covariate_source, target_time) AS covariate_source
        FROM resolved GROUP BY 1, 2, 3""",
    "snapshot_heads": """SELECT event_type AS series_id, CASE WHEN event_id % 17 <> 0 THEN date_trunc('hour', ts) END AS reference_time,
        date_trunc('minute', ts) + INTERVAL 1 MINUTE * (user_id * 7 % 360) AS fetched_at, value AS temperature, event_id AS write_seq
        FROM events""",
    "quantiles": f"""SELECT series_id, date_trunc('day', target_time)::TIMESTAMP AS reference_time, target_time, actual, 'wassertemp' AS channel, q,
        CASE WHEN (seed + floor(q * 100)) % 13 <> 0 THEN base * (0.5 + q) END AS value FROM (
        SELECT series_id, date_trunc('hour', ts) AS target_time, arg_min(value, ts) AS actual, avg(value) AS base, min(event_id) AS seed
        FROM obs WHERE value IS NOT NULL GROUP BY 1, 2), (SELECT unnest({LEVEL_LIST}) AS q)""",
    "bands": """SELECT series_id, reference_time, target_time, actual, max(value) FILTER (q = 0.01) AS low, max(value) FILTER (q = 0.99) AS high
        FROM quantiles GROUP BY ALL""",
    "crps_parts": """SELECT *, 2 * CASE WHEN actual >= value THEN (actual - value) * q ELSE (value - actual) * (1 - q) END AS loss
        FROM quantiles WHERE value IS NOT NULL""",
    "crps_areas": """SELECT *, (loss + lag(loss) OVER w) / 2 * (q - lag(q) OVER w) AS area FROM crps_parts
        WINDOW w AS (PARTITION BY series_id, reference_time, target_time ORDER BY q)""",
    "crps_steps": """SELECT series_id, reference_time, target_time, coalesce(sum(area), 0) AS crps FROM crps_areas GROUP BY ALL""",
    "requests": """SELECT l.series_id || '|' || o.h AS request_id, l.series_id, o.h::INTEGER AS offset_hours,
        l.last_ts - INTERVAL 1 HOUR * o.h AS ref FROM (SELECT series_id, max(ts) AS last_ts FROM gauge WHERE value IS NOT NULL GROUP BY 1) l,
        (SELECT unnest([96, 192, 288]) AS h) o""",
    "merged": """SELECT series_id, ts, g.value, w.airtemp, w.pressure, CASE WHEN g.series_id IS NOT NULL THEN 1 END AS gauged
        FROM gauge g FULL JOIN clean_weather w USING (series_id, ts)""",
    "merged_near": neighbours("merged", ["value", "airtemp", "pressure", "gauged"]),
    "wide": f"""SELECT series_id, ts AS date, wassertemp, lead(airtemp, 96) OVER w AS airtemp_96, lead(pressure, 96) OVER w AS pressure_96
        FROM (SELECT series_id, ts, CASE WHEN gauged_nt IS NOT NULL THEN {fill('value')} END AS wassertemp, {fill('airtemp')} AS airtemp,
        {fill('pressure')} AS pressure FROM merged_near) WINDOW w AS (PARTITION BY series_id ORDER BY ts)""",
    "archive": """SELECT series_id, ts AS reference_time, ts + INTERVAL 1 HOUR * s.step AS target_time,
        CASE WHEN floor(epoch(ts) / 86400) % 3 <> 0 THEN 'oracle' WHEN hour(ts) % 3 = 0 THEN 'live' WHEN hour(ts) % 3 = 1 THEN 'replay'
        ELSE 'oracle' END AS kind, 'dwd_forecast' AS covariate_source,
        'wassertemp' AS channel, l.q, value / 10 + s.step * 0.1 + (l.q - 0.5) AS value FROM gauge, (SELECT unnest([1, 2, 3, 4]) AS step) s,
        (SELECT unnest([0.01::DOUBLE, 0.5::DOUBLE, 0.99::DOUBLE]) AS q) l""",
    "snapshots": """SELECT series_id, CASE WHEN late THEN ts + INTERVAL 20 MINUTE ELSE ts END AS anchor,
        CASE WHEN late THEN ts + INTERVAL 3 DAY ELSE ts + INTERVAL 30 MINUTE END AS fetched_at, ts + INTERVAL 1 HOUR * s.step AS ts,
        CASE WHEN s.step % 9 <> 0 THEN 5 + hour(ts + INTERVAL 1 HOUR * s.step) * 0.5::DOUBLE + coalesce(value, 0) / 100 END AS airtemp,
        CASE WHEN s.step % 7 <> 0 THEN 1000 + hour(ts + INTERVAL 1 HOUR * s.step) * 0.25::DOUBLE END AS pressure
        FROM (SELECT *, floor(epoch(ts) / 86400) % 3 = 1 AS late FROM gauge), (SELECT unnest(generate_series(-2, 120)) AS step) s""",
    "tier1": f"""SELECT r.request_id, r.series_id, r.offset_hours, a.reference_time, a.kind, a.covariate_source FROM requests r JOIN
        (SELECT DISTINCT series_id, reference_time, kind, covariate_source FROM archive WHERE kind IN ('live', 'replay')) a
        ON a.series_id = r.series_id AND abs(epoch_us(a.reference_time) - epoch_us(r.ref)) <= 7200000000
        QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY abs(epoch_us(a.reference_time) - epoch_us(r.ref)),
        {rank('a.kind')} DESC, a.reference_time) = 1""",
    "tier2": """SELECT r.*, s.anchor, s.fetched_at FROM requests r JOIN (SELECT DISTINCT series_id, anchor, fetched_at FROM snapshots) s
        ON s.series_id = r.series_id AND s.anchor >= r.ref - INTERVAL 12 HOUR
        AND (s.anchor = r.ref OR (s.anchor < r.ref AND s.fetched_at <= r.ref))
        WHERE r.request_id NOT IN (SELECT request_id FROM tier1)
        QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY s.anchor DESC, s.fetched_at DESC) = 1""",
    "tier3": """SELECT * FROM requests WHERE request_id NOT IN (SELECT request_id FROM tier1)
        AND request_id NOT IN (SELECT request_id FROM tier2)""",
    "oracle_rows": """SELECT r.request_id, w.date AS ts, w.wassertemp, w.airtemp_96, w.pressure_96 FROM tier3 r JOIN wide w
        ON w.series_id = r.series_id AND w.date <= r.ref""",
    "replay_merged": """SELECT r.request_id, r.ref, m.ts, m.value, m.airtemp, m.pressure FROM tier2 r JOIN merged m
        ON m.series_id = r.series_id AND m.ts <= r.ref UNION ALL
        SELECT r.request_id, r.ref, s.ts, NULL, s.airtemp, s.pressure FROM tier2 r JOIN snapshots s
        ON s.series_id = r.series_id AND s.anchor = r.anchor AND s.fetched_at = r.fetched_at AND s.ts > r.ref""",
    "replay_near": neighbours("replay_merged", ["value", "airtemp", "pressure"], keys="request_id"),
    "replay_led": f"""SELECT request_id, ref, ts, wassertemp, lead(airtemp, 96) OVER w AS airtemp_96, lead(pressure, 96) OVER w AS pressure_96
        FROM (SELECT request_id, ref, ts, {fill('value')} AS wassertemp, {fill('airtemp')} AS airtemp, {fill('pressure')} AS pressure
        FROM replay_near) WINDOW w AS (PARTITION BY request_id ORDER BY ts)""",
    "model_rows": """SELECT request_id, ts, wassertemp, airtemp_96, pressure_96 FROM oracle_rows UNION ALL
        SELECT request_id, ts, wassertemp, airtemp_96, pressure_96 FROM replay_led WHERE ts <= ref""",
    "model_near": neighbours("model_rows", ["wassertemp", "airtemp_96", "pressure_96"], keys="request_id"),
    "contexts": """SELECT request_id, ts, coalesce(wassertemp_pv, wassertemp_nv) AS wassertemp,
        coalesce(airtemp_96_pv, airtemp_96_nv) AS airtemp_96, coalesce(pressure_96_pv, pressure_96_nv) AS pressure_96 FROM model_near
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ts DESC) <= 384 AND count(*) OVER (PARTITION BY request_id) >= 384""",
    "context_long": """SELECT request_id, ts, 'wassertemp' AS channel, wassertemp AS value FROM contexts UNION ALL
        SELECT request_id, ts, 'airtemp_96', airtemp_96 FROM contexts UNION ALL SELECT request_id, ts, 'pressure_96', pressure_96 FROM contexts""",
    "context_loc": f"""SELECT *, hour({local('ts')}) AS season, avg(value) OVER (PARTITION BY request_id, channel, hour({local('ts')})) AS loc
        FROM context_long""",
    "context_fit": """SELECT request_id, channel, max(ts) AS last_ts, sqrt(avg((value - loc) * (value - loc))) AS scale FROM context_loc
        GROUP BY 1, 2""",
    "context_seasons": "SELECT DISTINCT request_id, channel, season, loc FROM context_loc",
    "computed": f"""SELECT t.request_id, t.target_time, t.channel, l.l.q AS q, s.loc + t.scale * l.l.t AS value FROM (
        SELECT f.*, f.last_ts + INTERVAL 1 HOUR * h.step AS target_time FROM context_fit f, (SELECT unnest(generate_series(1, 96)) AS step) h) t
        JOIN context_seasons s ON s.request_id = t.request_id AND s.channel = t.channel AND s.season = hour({local('t.target_time')}),
        (SELECT unnest({levels_with_t(LEVELS)}) AS l) l""",
    "backtests": """SELECT t.request_id, t.series_id, t.offset_hours, t.reference_time, t.kind, t.covariate_source, a.target_time, a.channel, a.q,
        a.value, true AS from_archive FROM tier1 t JOIN archive a USING (series_id, reference_time, kind) UNION ALL
        SELECT request_id, r.series_id, r.offset_hours, r.ref, 'replay', 'dwd_forecast_archived', c.target_time, c.channel, c.q, c.value, false
        FROM tier2 r JOIN computed c USING (request_id) UNION ALL
        SELECT request_id, r.series_id, r.offset_hours, r.ref, 'oracle', 'dwd_observed', c.target_time, c.channel, c.q, c.value, false
        FROM tier3 r JOIN computed c USING (request_id)""",
    "every_backtest": """SELECT request_id, series_id, offset_hours, b.reference_time, b.kind, b.covariate_source, b.is_honest, b.label,
        b.target_time, b.channel, b.q, b.value FROM requests r LEFT JOIN labelled b USING (request_id, series_id, offset_hours)""",
    "labelled": """SELECT *, kind <> 'oracle' AS is_honest, 'Backtest -' || offset_hours || 'h (' || kind ||
        CASE WHEN kind = 'oracle' THEN ', perfect weather' ELSE '' END || ')' AS label FROM backtests""",
}

NUDGE = 1.3e-9


def steady(text: str) -> str:
    """Move every value off the rounding ties, so that a last-bit difference cannot flip a rounded digit."""
    out, at = [], 0
    for start in [m.start() for m in re.finditer(r"\bround\(", text)]:
        depth, end = 1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        tail = re.search(r", [3456]\)$", text[start:end])
        if tail:
            cut = start + tail.start()
            out += [text[at:cut], f" + {NUDGE!r}"]
            at = cut
    return "".join(out) + text[at:]


def sql(final: str, **extra: str) -> str:
    """Prefix a statement with the common tables it needs, in dependency order."""
    library = {**CTES, **extra}
    names = re.compile(r"\b(" + "|".join(sorted(library, key=len, reverse=True)) + r")\b")
    ordered: list[str] = []

    def visit(text: str, path: tuple[str, ...] = ()) -> None:
        for name in dict.fromkeys(names.findall(text)):
            if name not in ordered and name not in path:
                visit(library[name], (*path, name))
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final
    recursive = "RECURSIVE " if any("UNION ALL" in library[n] and n in names.findall(library[n]) for n in ordered) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({library[n]})" for n in ordered) + "\n" + final
