"""As-of lookups, splicing and alignment in time.

Lookups never pair every request with every candidate. Requests and candidates of one ``(series, time block)``
are laid on one line and a running "last seen" answers all requests in a single ordered pass. Candidates valid
beyond the end of their block are copied to the next ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.functions.scalars import kind_rank
from hindcast.operators.blocks import running
from hindcast.operators.selection import keep_one
from hindcast.schemas import ARCHIVE_TOLERANCE_HOURS, PROVENANCE, SNAPSHOT_MAX_AGE_HOURS

HOUR = 3_600
# Requests are the many side and candidates the few, so blocks are short: a candidate is copied to the blocks it is valid
# in, and so many of them make up its bounded validity.
COPIES = 12
LINE = ["series_id", "_block"]


def _block(micros: Column, seconds: int) -> Column:
    return F.floor(micros / F.lit(seconds * 1_000_000))


def _block_seconds(validity: int) -> int:
    """Block length for candidates valid for so many microseconds."""
    return max(60, validity // (COPIES * 1_000_000))


def _copies(first: Column, last: Column, seconds: int) -> Column:
    """One row for every block that the validity ``first..last`` (micros) touches."""
    return F.explode(F.sequence(_block(first, seconds), _block(last, seconds))).alias("_block")


def _asks(requests: DataFrame, seconds: int) -> DataFrame:
    ref = F.unix_micros("ref")
    return requests.select("series_id", "ref").distinct().select(
        "series_id", "ref", ref.alias("_t"), F.lit(1).alias("_ask"), _block(ref, seconds).alias("_block")
    )


def forecast_heads(archive: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """One row per archived forecast and kind, with the provenance of its first step."""
    chosen = archive if kinds is None else archive.where(F.col("kind").isin(*kinds))
    extra = [c for c in PROVENANCE if c != "kind"]
    first = F.min_by(F.struct(*extra), "target_time").alias("_meta")
    return chosen.groupBy("series_id", "reference_time", "kind").agg(first).select(
        "series_id", "reference_time", "kind", "_meta.*"
    )


def nearest_forecast(requests: DataFrame, archive: DataFrame, *, tolerance_hours: float = ARCHIVE_TOLERANCE_HOURS,
                     kinds: Sequence[str] | None = None) -> DataFrame:
    """The archived forecast nearest to each request, on either side, within an inclusive tolerance.

    Equal distances prefer the more trustworthy kind, then the earlier forecast. Returns each matched request with
    ``reference_time``, ``kind``, its provenance and ``distance_seconds``; unmatched requests are absent.
    """
    reach = int(tolerance_hours * HOUR * 1_000_000)
    seconds = _block_seconds(2 * reach)
    extra = [c for c in PROVENANCE if c != "kind"]
    rank = kind_rank(F.col("kind"))
    heads = keep_one(
        forecast_heads(archive, kinds).withColumn("_rank", rank),
        ["series_id", "reference_time"], [F.desc("_rank"), F.asc("kind")],
    )
    at = F.unix_micros("reference_time")
    head = F.struct(at.alias("t"), F.col("_rank").alias("rank"), "reference_time", "kind", *extra).alias("_head")
    marks = heads.select(
        "series_id", F.lit(None).cast("timestamp").alias("ref"), at.alias("_t"), F.lit(0).alias("_ask"), head,
        _copies(at - reach, at + reach, seconds),
    )
    line = marks.unionByName(_asks(requests, seconds), allowMissingColumns=True)
    seen = line.select(
        *LINE, "ref", "_t", "_ask",
        F.last("_head", True).over(running(LINE, "_t", "_ask")).alias("_left"),
        F.last("_head", True).over(running(LINE, F.desc("_t"), "_ask")).alias("_right"),
    ).where(F.col("_ask") == 1)

    near_left = F.col("_t") - F.col("_left.t")
    near_right = F.col("_right.t") - F.col("_t")
    left_ok = F.coalesce(near_left <= reach, F.lit(False))
    right_ok = F.coalesce(near_right <= reach, F.lit(False))
    left_wins = ~right_ok | (near_left < near_right) | (
        (near_left == near_right) & (F.col("_left.rank") >= F.col("_right.rank"))
    )
    best = F.when(left_ok & left_wins, F.col("_left")).when(right_ok, F.col("_right"))
    found = seen.select("series_id", "ref", best.alias("_best"), "_t").where(F.col("_best").isNotNull())
    found = found.select(
        "series_id", "ref",
        F.col("_best.reference_time").alias("reference_time"), F.col("_best.kind").alias("kind"),
        *[F.col(f"_best.{c}").alias(c) for c in extra],
        (F.abs(F.col("_best.t") - F.col("_t")) / F.lit(1_000_000)).alias("distance_seconds"),
    )
    return requests.join(found, ["series_id", "ref"])


def forecast_rows(hits: DataFrame, archive: DataFrame) -> DataFrame:
    """All archived steps of the forecast each request was matched with."""
    steps = archive.drop(*[c for c in PROVENANCE if c != "kind"])
    return hits.join(steps, ["series_id", "reference_time", "kind"])


def current_snapshot(requests: DataFrame, snapshots: DataFrame, *,
                     max_age_hours: float = SNAPSHOT_MAX_AGE_HOURS) -> DataFrame:
    """The weather snapshot that was current at each request's time, judged by two clocks.

    ``snapshots`` carries ``reference_time`` (the run's anchor, fetch time when absent) and ``fetched_at``. A
    snapshot anchored exactly at the request is that run's own, however late it was fetched. An earlier anchor, at
    most ``max_age_hours`` old, counts only when it was also fetched by then. The newest anchor wins, then the
    newest fetch. Returns each matched request with ``anchor`` and ``fetched_at``.
    """
    age = int(max_age_hours * HOUR * 1_000_000)
    seconds = _block_seconds(age)
    heads = snapshots.select(
        "series_id", F.coalesce("reference_time", "fetched_at").alias("anchor"), "fetched_at"
    ).distinct()
    asks = _asks(requests, seconds)

    own = heads.groupBy("series_id", F.col("anchor").alias("ref")).agg(F.max("fetched_at").alias("_own"))

    anchor, fetched = F.unix_micros("anchor"), F.unix_micros("fetched_at")
    usable_from, usable_to = F.greatest(anchor, fetched), anchor + age
    marks = heads.where(usable_from <= usable_to).select(
        "series_id", F.lit(None).cast("timestamp").alias("ref"), usable_from.alias("_t"), F.lit(0).alias("_ask"),
        F.struct("anchor", "fetched_at").alias("_head"), _copies(usable_from, usable_to, seconds),
    )
    line = marks.unionByName(asks, allowMissingColumns=True)
    # What is usable only grows with time, so a running maximum is the newest anchor fetched so far.
    newest = line.select(
        *LINE, "ref", "_t", "_ask", F.max("_head").over(running(LINE, "_t", "_ask")).alias("_best")
    ).where(F.col("_ask") == 1)

    fresh = F.unix_micros("_best.anchor") >= F.col("_t") - age
    decided = newest.join(own, ["series_id", "ref"], "left").select(
        "series_id", "ref",
        F.when(F.col("_own").isNotNull(), F.col("ref")).when(fresh, F.col("_best.anchor")).alias("anchor"),
        F.when(F.col("_own").isNotNull(), F.col("_own")).when(fresh, F.col("_best.fetched_at")).alias("fetched_at"),
    ).where(F.col("anchor").isNotNull())
    return requests.join(decided, ["series_id", "ref"])


def snapshot_rows(hits: DataFrame, snapshots: DataFrame) -> DataFrame:
    """All rows of the snapshot each request was matched with."""
    keyed = snapshots.withColumn("anchor", F.coalesce("reference_time", "fetched_at")).drop("reference_time")
    return hits.join(keyed, ["series_id", "anchor", "fetched_at"])


def splice(observed: DataFrame, predicted: DataFrame, *, ts: str = "ts", ref: str = "ref",
           keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Observed rows up to and including the reference time, predicted rows strictly after it."""
    past = observed.where(F.col(ts) <= F.col(ref)).withColumn("_turn", F.lit(0))
    ahead = predicted.where(F.col(ts) > F.col(ref)).withColumn("_turn", F.lit(1))
    joined = past.unionByName(ahead, allowMissingColumns=True)
    return keep_one(joined, [*keys, ts], [F.asc("_turn")]).drop("_turn")


def align(forecast: DataFrame, actuals: DataFrame, *, actual: str = "actual") -> DataFrame:
    """Forecast steps together with the value measured at their target time."""
    truth = actuals.where(F.col(actual).isNotNull()).select("series_id", F.col("ts").alias("target_time"), actual)
    return forecast.join(truth, ["series_id", "target_time"])


def already_measured(forecast: DataFrame, actuals: DataFrame, *, actual: str = "actual") -> DataFrame:
    """Forecast steps whose target time had been measured already: there must be none in an honest run."""
    truth = actuals.where(F.col(actual).isNotNull()).select("series_id", F.col("ts").alias("target_time"))
    return forecast.join(truth, ["series_id", "target_time"], "left_semi")
