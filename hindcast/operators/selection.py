"""Deduplication, top-k, volatile windows and peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.scalars import kind_rank, named
from hindcast.operators.blocks import BLOCK_SECONDS, Frame, frame_moments, number_rows
from hindcast.schemas import PEAK_DISTANCE, PEAK_PROMINENCE

KEY = ("series_id",)
SALTS = 64


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a stated order.

    Filtering ``row_number`` to 1 lets Spark keep one row per key in every map task before the shuffle, so
    many copies of one key never meet in one task.
    """
    ranked = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_nth") == 1).drop("_nth")


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """The best ``count`` rows of each key, first within salted shares of the key, then across them."""
    shared = df.withColumn("_salt", F.pmod(F.xxhash64(*[named(c) for c in df.columns]), F.lit(SALTS)))
    best = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    shared = shared.withColumn("_nth", best).where(F.col("_nth") <= count).drop("_nth", "_salt")
    final = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return shared.withColumn("nth", final).where(F.col("nth") <= count)


def resolve_precedence(df: DataFrame, keys: Sequence[str] = ("series_id", "reference_time", "target_time"),
                       tie: Sequence[str] = ("write_seq",)) -> DataFrame:
    """One row per forecast step: best kind, then newest issue (unknown issue loses), then latest write."""
    order = [kind_rank(F.col("kind")).desc(), F.col("issued_at").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in tie if c in df.columns]
    return keep_one(df, keys, order)


def volatility_scores(df: DataFrame, column: str, rows: int, *, trend: bool = False,
                      mean_between: tuple[float, float] | None = None, first_start: int = 1000,
                      margin: int | None = None, keys: Sequence[str] = KEY,
                      block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Score every start position by the variance of the ``rows`` values from there on.

    With ``trend`` the variance is multiplied by the absolute change over the window. ``start`` counts from 0;
    starts below ``first_start`` or less than ``margin + 1`` rows before the end are left out.
    """
    margin = rows if margin is None else margin

    def scores(frames: dict[str, Frame], w) -> dict[str, Column]:
        ahead = frames["ahead"]
        return {"_var": ahead.variance, "_mean": ahead.mean, "_final": F.lead(column, rows - 1).over(w)}

    numbered = number_rows(df.select(*keys, "ts", column), keys=keys, block_seconds=block_seconds)
    scored = frame_moments(numbered, "_rn", column, {"ahead": (0, rows - 1)}, scores, keys=keys)
    start = F.col("_rn") - 1
    score = F.col("_var") * F.abs(F.col(column) - F.col("_final")) if trend else F.col("_var")
    scored = scored.where((start >= first_start) & (start < F.col("_rows") - margin - 1))
    if mean_between:
        scored = scored.where(F.col("_mean").between(*mean_between))
    return scored.select(*keys, "ts", start.alias("start"), score.alias("score"))


def spaced_top(scored: DataFrame, count: int, rows: int, *, keys: Sequence[str] = KEY) -> DataFrame:
    """Greedy choice by score of up to ``count`` starts at least ``rows`` apart; ties go to the earlier start.

    Each choice rules out at most ``2 * rows - 1`` starts, so the best ``(count - 1) * (2 * rows - 1) + 1`` of a
    series always contain every choice and nothing else has to be looked at.
    """
    keys = list(keys)
    pool = (count - 1) * (2 * rows - 1) + 1
    best = top_rows(scored, keys, [F.desc("score"), F.asc("start")], pool)
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col("score")).alias("worse"), "start", "ts")),
    )
    empty = F.expr("cast(array() as array<struct<worse:double,start:bigint,ts:timestamp>>)")

    def add(kept: Column, item: Column) -> Column:
        clash = F.exists(kept, lambda k: F.abs(k.start - item.start) < rows)
        full = F.size(kept) >= count
        return F.when(clash | full, kept).otherwise(F.array_append(kept, item))

    return (
        best.groupBy(*keys)
        .agg(ordered.alias("_pool"))
        .select(*keys, F.posexplode(F.aggregate("_pool", empty, add)).alias("_pos", "_hit"))
        .select(
            *keys, (F.col("_pos") + 1).alias("place"), F.col("_hit.start").alias("start"),
            F.col("_hit.ts").alias("ts"), (-F.col("_hit.worse")).alias("score"),
        )
    )


def _tops(v: Column) -> Column:
    """Positions (from 0) of the local maxima of an array; a flat top counts once, at its middle."""
    n = F.size(v)
    rising = F.filter(F.sequence(F.lit(1), n - 2), lambda i: F.get(v, i - 1) < F.get(v, i))
    # Where a rise ends: the next place with another value.
    ended = F.transform(rising, lambda i: F.struct(
        i.alias("i"), F.array_min(F.filter(F.sequence(i + 1, n - 1), lambda k: F.get(v, k) != F.get(v, i))).alias("k")))
    falling = F.filter(ended, lambda x: F.get(v, x.k) < F.get(v, x.i))
    tops = F.transform(falling, lambda x: F.floor((x.i + x.k - 1) / 2).cast("int"))
    return F.when(n > 2, tops).otherwise(F.expr("cast(array() as array<int>)"))


def _spaced(v: Column, tops: Column, distance: int) -> Column:
    """The highest tops at least ``distance`` apart; of equal ones the later."""
    ordered = F.array_sort(F.transform(tops, lambda p: F.struct((-F.get(v, p)).alias("less"), (-p).alias("p"))))

    def add(kept: Column, x: Column) -> Column:
        return F.when(F.exists(kept, lambda k: F.abs(k + x.p) < distance), kept).otherwise(F.array_append(kept, -x.p))

    return F.array_sort(F.aggregate(ordered, F.expr("cast(array() as array<int>)"), add))


def _rise(v: Column, p: Column) -> Column:
    """Height of a top over the higher of the two lows that part it from anything higher."""
    here, n = F.get(v, p), F.size(v)
    left = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), p), lambda k: F.get(v, k) > here)), F.lit(-1)) + 1
    right = F.coalesce(F.array_min(F.filter(F.sequence(p, n - 1), lambda k: F.get(v, k) > here)), n)
    return here - F.greatest(F.array_min(F.slice(v, left + 1, p - left + 1)), F.array_min(F.slice(v, p + 1, right - p)))


def find_peaks(df: DataFrame, value: str, *, keys: Sequence[str] = ("series_id", "reference_time"),
               order: str = "target_time", distance: int = PEAK_DISTANCE,
               prominence: float = PEAK_PROMINENCE) -> DataFrame:
    """Significant maxima of each forecast curve. A curve is one forecast, so its length is the horizon."""
    curve = F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), F.col(value).cast("double").alias("v"))))
    curves = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(curve.alias("_curve"))
    v = F.col("_v")
    spaced = curves.withColumn("_v", F.col("_curve.v")).withColumn("_kept", _spaced(v, _tops(v), distance))
    found = spaced.withColumn("_peak", F.explode(F.transform("_kept", lambda p: F.struct(
        p.alias("position"), _rise(v, p).alias("prominence"))))).where(F.col("_peak.prominence") >= prominence)
    at = F.get("_curve", F.col("_peak.position"))
    return found.select(
        *keys, F.col("_peak.position").alias("position"), at.t.alias(order), at.v.alias(value),
        F.col("_peak.prominence").alias("prominence"),
    )
