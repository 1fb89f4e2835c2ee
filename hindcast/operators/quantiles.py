"""Exact quantiles of groups of any size in two passes over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
BRACKET = 3.0 / SKETCH_ACCURACY


def whole_below() -> float:
    """Groups of fewer rows are counted by value as a whole.

    A cut lies within ``1 / SKETCH_ACCURACY`` of its share. What a bracket is wider than that must make up for the one
    rank by which ``p * n`` and the rank of an interpolated quantile differ, on both sides.
    """
    slack = BRACKET - 1.0 / SKETCH_ACCURACY
    return 2.0 / slack if slack > 0 else float("inf")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, levels: dict[str, float], *, lower: bool = False,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key with an exact quantile column per entry of ``levels``.

    Quantiles interpolate linearly between order statistics, or take the lower one with ``lower=True``. Null values do
    not count; a key with no other ones has null quantiles. Rows with a null key are left out. ``also`` names further
    aggregates of ``df``, which the first pass takes along.

    The built-in exact percentile gathers all distinct values of a group in one task. Here the first pass is one
    aggregate with a mergeable sketch, which brackets each wanted quantile between two values. The second pass counts
    the rows: by value inside the brackets, normally a few ten-thousandths of the group, and as one number between
    them. Both are combined before they are shuffled, so many copies of one value are one row. Running sums of these
    counts place the wanted ranks. A bracket is wide enough for the sketch's error bound; should a rank lie outside
    nevertheless, the job fails rather than report another value.
    """
    keys, also = list(keys), also or {}
    shares = [min(max(p + side, 0.0), 1.0) for p in levels.values() for side in (-BRACKET, BRACKET)]
    sketch = df.groupBy(*keys).agg(
        F.percentile_approx(value, shares, SKETCH_ACCURACY).alias("_cuts"), F.count(value).alias("_n"),
        F.struct(F.lit(True).alias("_"), *[c.alias(name) for name, c in also.items()]).alias("_also"),
    )
    v = F.col("_v")
    brackets = [(F.col("_cuts")[i], F.col("_cuts")[i + 1]) for i in range(0, len(shares), 2)]
    inside = reduce(or_, [(v >= low) & (v <= high) for low, high in brackets])
    outside = v.isNotNull() & (F.col("_n") >= whole_below()) & ~inside
    # All rows between two brackets are one row behind the lower bracket's end.
    ends = F.array_max(F.filter(F.array(*[high for _, high in brackets]), lambda c: c < v))
    counts = (
        df.select(*keys, F.col(value).alias("_v")).join(sketch, keys)
        .select(*keys, "_n", "_also", F.when(outside, ends).otherwise(v).alias("_at"), outside.alias("_outside"), "_v")
        .groupBy(*keys, "_at", "_outside")
        .agg(F.count("_v").alias("_c"), F.first("_n").alias("_n"), F.first("_also").alias("_also"))
    )
    ordered = (
        Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_at"), "_outside")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = counts.withColumn("_to", F.sum("_c").over(ordered))
    found = F.when(F.col("_outside"), F.raise_error(F.lit("a quantile lies outside its bracket"))).otherwise(F.col("_at"))
    found = found.cast("double")

    def here(rank: Column) -> Column:
        return (rank >= F.col("_to") - F.col("_c")) & (rank < F.col("_to"))

    def quantile(p: float) -> Column:
        if lower:
            return F.sum(F.when(here(F.greatest(F.ceil(F.lit(p) * F.col("_n")) - 1, F.lit(0))), found))
        at = F.lit(p) * (F.col("_n") - 1)
        share = at - F.floor(at)
        first, second = here(F.floor(at)), here(F.ceil(at))
        return F.sum(F.when(first & second, found).when(first, found * (1 - share)).when(second, found * share))

    return placed.groupBy(*keys).agg(
        *[quantile(p).alias(name) for name, p in levels.items()], F.first("_also").alias("_also")
    ).select(*keys, *levels, *[F.col("_also")[name].alias(name) for name in also])
