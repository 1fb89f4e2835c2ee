"""Conversion between instants and local wall-clock times, including the two yearly clock changes."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.schemas import LOCAL_ZONE

# Zones had one fixed offset before clocks were regulated; times outside these years raise an error.
FIRST_YEAR, LAST_YEAR = 1800, 2400

_ZONE_YEAR = T.StructType([
    T.StructField("_year", T.IntegerType()),
    T.StructField("_base", T.LongType()),
    T.StructField("_changes", T.ArrayType(T.StructType([
        T.StructField("at", T.LongType()),
        T.StructField("before", T.LongType()),
        T.StructField("after", T.LongType()),
    ]))),
])


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """The wall-clock time an instant has in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


@lru_cache(maxsize=None)
def _changes(zone: str) -> tuple[tuple[int, int, int], ...]:
    """(instant, offset before, offset after) in seconds for each clock change of the zone."""
    tz = ZoneInfo(zone)

    def offset(second: int) -> int:
        moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=second)
        return int(moment.astimezone(tz).utcoffset().total_seconds())

    start = int(datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc).timestamp())
    stop = int(datetime(LAST_YEAR, 12, 31, tzinfo=timezone.utc).timestamp())
    found, step = [], 7 * 86400
    for left in range(start, stop, step):
        right = left + step
        if offset(left) == offset(right):
            continue
        low, high = left, right
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if offset(middle) == offset(left) else (low, middle)
        found.append((high, offset(left), offset(right)))
    return tuple(found)


@lru_cache(maxsize=None)
def _zone_years(zone: str) -> tuple:
    changes = _changes(zone)
    rows = []
    for year in range(FIRST_YEAR, LAST_YEAR + 1):
        opening = int((datetime(year, 1, 1) - datetime(1970, 1, 1)).total_seconds())
        closing = int((datetime(year + 1, 1, 1) - datetime(1970, 1, 1)).total_seconds())
        mine = [c for c in changes if opening - 86400 <= c[0] < closing + 86400]
        earlier = [c for c in changes if c[0] < opening - 86400]
        base = earlier[-1][2] if earlier else changes[0][1] if changes else 0
        rows.append((year, base, [tuple(c) for c in mine]))
    return tuple(rows)


def from_local(
    df: DataFrame,
    zone: str = LOCAL_ZONE,
    *,
    wall: str = "wall",
    out: str = "ts",
    series: str = "series_id",
    order: str | None = None,
    per_fold: bool = False,
) -> DataFrame:
    """Give wall-clock readings their instant.

    A wall time skipped in spring becomes the first valid instant. A wall time repeated in autumn is
    resolved only when the series repeats exactly one reading of that hour: earlier readings and the first
    of the pair are summer time, the rest winter time. Otherwise all repeated-hour rows of the series are
    dropped (``per_fold=True`` limits that to the fold concerned). ``order`` says which of two readings with
    the same wall time came first.
    """
    zone_table = df.sparkSession.createDataFrame(list(_zone_years(zone)), _ZONE_YEAR)
    second = F.unix_micros(F.col(wall).cast("timestamp")) / F.lit(1_000_000)
    # One row per calendar year of a fixed range, so this side is small whatever the data holds.
    placed = df.where(F.col(wall).isNotNull()).withColumn("_year", F.year(wall)).join(
        F.broadcast(zone_table), "_year", "left"
    )
    in_gap = F.filter("_changes", lambda c: (second >= c.at + c.before) & (second < c.at + c.after))
    in_fold = F.filter("_changes", lambda c: (second >= c.at + c.after) & (second < c.at + c.before))
    passed = F.filter("_changes", lambda c: second >= c.at + F.greatest(c.before, c.after))
    outside = F.raise_error(F.concat(F.lit("no clock changes known for the year "), F.year(wall).cast("string"))).cast("long")
    offset = F.coalesce(F.try_element_at(passed, F.lit(-1)).after, F.col("_base"), outside)

    placed = placed.select(
        *df.columns,
        F.try_element_at(in_gap, F.lit(1)).at.alias("_gap"),
        F.try_element_at(in_fold, F.lit(1)).alias("_fold"),
        offset.alias("_offset"),
    )
    micros = F.unix_micros(F.col(wall).cast("timestamp"))

    def instant(offset_seconds: Column) -> Column:
        return F.timestamp_micros(micros - offset_seconds * F.lit(1_000_000))

    plain = placed.where(F.col("_fold").isNull()).select(
        *df.columns,
        F.when(F.col("_gap").isNotNull(), F.timestamp_seconds("_gap")).otherwise(instant(F.col("_offset"))).alias(out),
    )

    # Only rows of the repeated hour go on from here: at most one hour of each year.
    folded = placed.where(F.col("_fold").isNotNull()).withColumn("_at", F.col("_fold.at"))
    per_wall = folded.groupBy(series, "_at", wall).agg(F.count(F.lit(1)).alias("_copies"))
    verdict = per_wall.groupBy(series, "_at").agg(
        F.sum(F.col("_copies") - 1).alias("_repeats"),
        F.max(F.when(F.col("_copies") > 1, F.col(wall))).alias("_split"),
    )
    bad = verdict.where(F.col("_repeats") != 1)
    good = verdict.join(bad, [series, "_at"] if per_fold else [series], "left_anti").select(series, "_at", "_split")
    solved = folded.join(good, [series, "_at"])
    twin = Window.partitionBy(series, "_at", wall).orderBy(F.col(order or wall))
    # A good fold has at most two rows per wall time, so this window never holds more.
    late = (F.col(wall) > F.col("_split")) | ((F.col(wall) == F.col("_split")) & (F.row_number().over(twin) == 2))
    solved = solved.withColumn("_late", late).select(
        *df.columns,
        instant(F.when(F.col("_late"), F.col("_fold.after")).otherwise(F.col("_fold.before"))).alias(out),
    )
    return plain.unionByName(solved)
