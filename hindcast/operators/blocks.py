"""Windows over long series without putting a whole series into one task.

A window partitioned by series alone runs a hot series in a single task. Here rows are windowed inside
``(series, block)`` and what a block needs from outside arrives in one of two exact ways:

* an unbounded look (last known value, running row number) comes from one summary row per block, and
* a bounded row frame comes from a halo: copies of the few neighbouring rows the frame can touch.

A block of a gridded series holds at most ``block_seconds / step`` rows, however large the series is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DAY = 86_400
BLOCK_SECONDS = 90 * DAY
CHUNK_ROWS = 8_192
HOUR_MICROS = 3_600_000_000


def block_of(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000))


def hour_number(ts: Column) -> Column:
    """Hours since the epoch: a dense index on a gap-free hourly grid."""
    return F.floor(F.unix_micros(ts) / F.lit(HOUR_MICROS))


def touch(df: DataFrame) -> Column:
    """An aggregate that uses every column of ``df``.

    A summary that reads fewer columns than the rows it is joined to makes Spark scan and shuffle them twice. Using all
    columns keeps both branches equal, so the shuffle is done once and reused.
    """
    return F.max(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("_touch")


def running(keys: Sequence[str], *order) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before_current(keys: Sequence[str], *order) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def with_neighbours(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = ("series_id",),
    ts: str = "ts",
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Add, per column, the known reading at or before (``_prev_c``) and at or after (``_next_c``) each row.

    Also adds ``_rn``, the 1-based row number in the series, and ``_rows``, its length. ``ts`` must be unique
    within the keys.
    """
    keys = list(keys)
    home = [*keys, "_block"]
    # The filter is what the join below implies anyway; stated here it reaches both branches alike.
    blocked = df.withColumn("_block", block_of(F.col(ts), block_seconds)).where(F.col("_block").isNotNull())

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(c).alias("v")))

    parts = [F.count(F.lit(1)).alias("_count")]
    for c in columns:
        seen = F.when(F.col(c).isNotNull(), F.col(ts))
        parts += [
            F.min(seen).alias(f"_lo_{c}"), F.min_by(c, seen).alias(f"_lov_{c}"),
            F.max(seen).alias(f"_hi_{c}"), F.max_by(c, seen).alias(f"_hiv_{c}"),
        ]
    summary = blocked.groupBy(*home).agg(*parts, touch(df)).where(F.col("_touch").isNotNull()).drop("_touch")

    # These windows see one row per block, so their size grows with the time span, not with the rows.
    earlier, later = before_current(keys, "_block"), before_current(keys, F.desc("_block"))

    def edge(c: str, side: str) -> Column:
        at = F.col(f"_{side}_{c}")
        return F.when(at.isNotNull(), F.struct(at.alias("ts"), F.col(f"_{side}v_{c}").alias("v")))

    carried = summary.select(
        *home,
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_skip"),
        F.sum("_count").over(Window.partitionBy(*keys)).alias("_rows"),
        *[F.last(edge(c, "hi"), True).over(earlier).alias(f"_cp_{c}") for c in columns],
        *[F.last(edge(c, "lo"), True).over(later).alias(f"_cn_{c}") for c in columns],
    )
    forward, backward = running(home, ts), running(home, F.desc(ts))
    joined = blocked.join(carried, home)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.row_number().over(Window.partitionBy(*home).orderBy(ts)) + F.col("_skip")).alias("_rn"),
        "_rows",
        *[F.coalesce(F.last(known(c), True).over(forward), F.col(f"_cp_{c}")).alias(f"_prev_{c}") for c in columns],
        *[F.coalesce(F.last(known(c), True).over(backward), F.col(f"_cn_{c}")).alias(f"_next_{c}") for c in columns],
    )


def number_rows(df: DataFrame, *, keys: Sequence[str] = ("series_id",), ts: str = "ts",
                block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Add ``_rn`` and ``_rows`` only."""
    return with_neighbours(df, (), keys=keys, ts=ts, block_seconds=block_seconds)


def framed(
    df: DataFrame,
    index: str,
    build: Callable[[WindowSpec], dict[str, Column]],
    *,
    before: int = 0,
    after: int = 0,
    keys: Sequence[str] = ("series_id",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Evaluate row-frame expressions over a dense integer ``index``.

    ``build`` receives the window (keys, chunk, index order) and may look ``before`` rows back and ``after``
    rows ahead. Chunks have equal size for every series, so no key is hot.
    """
    size = max(chunk_rows, 4 * (before + after))
    at = F.col(index)
    spread = F.sequence(F.floor((at - after) / size), F.floor((at + before) / size))
    window = Window.partitionBy(*keys, "_chunk").orderBy(index)
    added = build(window)
    return (
        df.withColumn("_chunk", F.explode(spread))
        .select("*", *[expr.alias(name) for name, expr in added.items()])
        .where(F.col("_chunk") == F.floor(at / size))
        .drop("_chunk")
    )


@dataclass(frozen=True)
class Frame:
    """Moments of the known values in a row frame, as columns."""

    count: Column
    mean: Column
    variance: Column
    total: Column
    left: Column  # rows that the frame lacks before the start of its series, and after its end
    right: Column


def frame_moments(
    df: DataFrame,
    index: str,
    column: str,
    frames: dict[str, tuple[int, int]],
    build: Callable[[dict[str, Frame], WindowSpec], dict[str, Column]],
    *,
    keys: Sequence[str] = ("series_id",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Evaluate expressions over moments of row frames (rows before, rows after) at a cost per row that does not depend on
    the frame's length.

    A chunk gets running sums of its values and their squares, and a frame is the difference of the two running rows at its
    ends. Values are shifted by the chunk's mean, so that the sums stay small and little is lost in the difference. Values
    that are not finite are counted apart and decide only the frames they lie in. ``build`` receives a ``Frame`` for each
    name, and the chunk's window for plain looks along the rows.
    """
    before, after = max(b for b, _ in frames.values()), max(a for _, a in frames.values())
    size = max(chunk_rows, 4 * (before + after))
    at = F.col(index)
    spread = F.sequence(F.floor((at - after) / size), F.floor((at + before) / size))
    chunk = Window.partitionBy(*keys, "_chunk")
    window = chunk.orderBy(index)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.col(column).cast("double")
    endless = F.abs(value) == F.lit(float("inf"))
    finite = F.when(~(F.isnan(value) | endless), value)
    moved = F.col("_finite") - F.coalesce("_shift", F.lit(0.0))
    running_sums = {
        "_n": F.count("_finite"), "_s": F.sum(moved), "_q": F.sum(moved * moved), "_nan": F.count_if(F.isnan(value)),
        "_up": F.count_if(value == float("inf")), "_down": F.count_if(value == float("-inf")),
    }
    kept = [F.col(f"`{c}`") for c in df.columns]
    summed = (
        df.withColumn("_chunk", F.explode(spread))
        .withColumn("_finite", finite).withColumn("_shift", F.avg("_finite").over(chunk))
        .select(*kept, "_chunk", F.coalesce("_shift", F.lit(0.0)).alias("_shift"), F.row_number().over(window).alias("_row"),
                F.count(F.lit(1)).over(chunk).alias("_size"),
                *[F.coalesce(x.over(upto), F.lit(0)).alias(name) for name, x in running_sums.items()])
    )

    def ends(name: str, rows_before: int, rows_after: int) -> dict[str, Column]:
        """The running sum at the frame's last row less that before its first; chunks end short only where series do."""
        whole = chunk.orderBy(index).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = {}
        for c in running_sums:
            last = F.coalesce(F.lead(c, rows_after).over(window), F.last(c).over(whole))
            out[f"_{name}{c}"] = last - F.coalesce(F.lag(c, rows_before + 1).over(window), F.lit(0))
        return out

    differences = {k: v for name, (b, a) in frames.items() for k, v in ends(name, b, a).items()}
    inner = [c for c in summed.columns if c not in df.columns]
    told = summed.select(*kept, *inner, *[x.alias(name) for name, x in differences.items()])

    def frame(name: str) -> Frame:
        n, s, q, nan, up, down = (F.col(f"_{name}{c}") for c in running_sums)
        odd = (
            F.when((nan > 0) | ((up > 0) & (down > 0)), F.lit(float("nan")))
            .when(up > 0, F.lit(float("inf"))).when(down > 0, F.lit(float("-inf"))))
        shift, rows_before, rows_after = F.col("_shift"), *frames[name]
        return Frame(
            n + nan + up + down,
            F.coalesce(odd, F.when(n > 0, shift + s / n)),
            F.when(odd.isNotNull(), F.lit(float("nan"))).when(n > 0, F.greatest(q / n - s / n * (s / n), F.lit(0.0))),
            F.coalesce(odd, F.when(n > 0, shift * n + s)),
            rows_before - F.least(F.col("_row") - 1, F.lit(rows_before)),
            rows_after - F.least(F.col("_size") - F.col("_row"), F.lit(rows_after)))

    added = build({name: frame(name) for name in frames}, window)
    return (
        told.select(*kept, "_chunk", *[x.alias(name) for name, x in added.items()])
        .where(F.col("_chunk") == F.floor(at / size))
        .drop("_chunk")
    )
