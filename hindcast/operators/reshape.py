"""Moving between wide and long layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.functions.scalars import name_channel, name_level, named
from hindcast.schemas import BANDS, CHANNELS, METADATA, RAW_WEATHER, WIDE_QUANTILES, quantile_column


def channel_order(cols: str = "cols", channels: Sequence[str] = CHANNELS):
    return F.array_position(F.array(*[F.lit(c) for c in channels]), F.col(cols)).cast("int")


def to_long(df: DataFrame, *, keys: Sequence[str] = ("series_id", "date"),
            channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One row per channel, nulls kept, with the channel's fixed position."""
    long = df.unpivot(list(keys), list(channels), "cols", "data")
    return long.withColumn("cols_ord", channel_order("cols", channels))


def in_channel_order(df: DataFrame, *, keys: Sequence[str] = ("series_id",), date: str = "date") -> DataFrame:
    return df.orderBy(*keys, "cols_ord", date)


def to_wide(df: DataFrame, *, keys: Sequence[str] = ("series_id", "date"),
            channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One column per channel in fixed order; two rows for one cell fail the job."""
    cells = df.groupBy(*keys).agg(
        *[F.max(F.when(F.col("cols") == c, F.col("data"))).alias(c) for c in channels],
        F.greatest(*[F.count_if(F.col("cols") == c) for c in channels]).alias("_most"),
    )
    single = F.when(F.col("_most") <= 1, F.lit(True)).otherwise(
        F.raise_error(F.lit("duplicate channel rows for one date")).cast("boolean")
    )
    return cells.where(single).drop("_most")


def require_channels(df: DataFrame, channels: Sequence[str] = CHANNELS) -> None:
    """Raise when a channel is absent altogether."""
    flags = df.agg(*[F.bool_or(F.col("cols") == c).alias(c) for c in channels]).first()
    missing = [c for c in channels if not flags[c]]
    if missing:
        raise ValueError(f"missing required channels: {missing}")


def quantiles_to_long(df: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Columns named ``channel_qLEVEL`` to rows ``(channel, q, value)``."""
    names = [c for c in df.columns if c not in keys and "_q" in c]
    long = df.unpivot(list(keys), [f"`{n}`" for n in names], "_name", "value")
    return long.select(*keys, name_channel(F.col("_name")).alias("channel"), name_level(F.col("_name")).alias("q"),
                       "value")


def quantiles_to_wide(df: DataFrame, *, keys: Sequence[str], columns: Sequence[str] = WIDE_QUANTILES) -> DataFrame:
    wanted = {name: tuple(name.rsplit("_q", 1)) for name in columns}
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("channel") == c) & (F.col("q") == float(q)), F.col("value"))).alias(name)
            for name, (c, q) in wanted.items()
        ]
    )


def quantile_bands(df: DataFrame, *, keys: Sequence[str], bands=BANDS) -> DataFrame:
    """Long quantiles to one row per band; a band with a missing side is skipped."""
    at = F.col("q")
    per_step = df.groupBy(*keys).agg(
        *[F.max(F.when(at == q, F.col("value"))).alias(f"_{i}_{side}")
          for i, pair in enumerate(bands) for side, q in zip(("lo", "hi"), pair)],
        *[F.count_if(at == q).alias(f"_{i}_{side}_n")
          for i, pair in enumerate(bands) for side, q in zip(("lo", "hi"), pair)],
    )
    each = F.explode(F.array(*[
        F.struct(
            F.lit(lo).alias("q_low"), F.lit(hi).alias("q_high"),
            F.col(f"_{i}_lo").alias("low"), F.col(f"_{i}_hi").alias("high"),
            ((F.col(f"_{i}_lo_n") > 0) & (F.col(f"_{i}_hi_n") > 0)).alias("whole"),
        )
        for i, (lo, hi) in enumerate(bands)
    ]))
    return per_step.select(*keys, each.alias("_b")).where("_b.whole").select(
        *keys, "_b.q_low", "_b.q_high", "_b.low", "_b.high"
    )


def metadata_first(df: DataFrame) -> DataFrame:
    head = [c for c in ("series_id", *METADATA) if c in df.columns]
    return df.select(*head, *[named(c) for c in df.columns if c not in head])


def canonical_weather(df: DataFrame, *, snapshot: Sequence[str] = ("series_id", "anchor", "fetched_at")) -> DataFrame:
    """Bring snapshots of both layouts to one: a snapshot's canonical column wins if it holds any value at all."""
    snapshot = list(snapshot)
    names = list(RAW_WEATHER.items())
    for raw, canonical in names:
        if raw not in df.columns and canonical not in df.columns:
            raise ValueError(f"no column for {canonical}: neither it nor {raw!r} is there")
        for c in (raw, canonical):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("double"))
    held = df.groupBy(*snapshot).agg(
        *[F.bool_or(F.col(canonical).isNotNull()).alias(f"_has_{canonical}") for _, canonical in names]
    )
    joined = df.join(held, snapshot)

    def pick(raw: str, canonical: str):
        return F.when(F.col(f"_has_{canonical}"), F.col(canonical)).otherwise(F.col(raw))

    picked = {canonical: pick(raw, canonical) for raw, canonical in names}
    keep = [c for c in df.columns if c not in RAW_WEATHER and c not in picked]
    return joined.select(*keep, *[expr.cast("double").alias(c) for c, expr in picked.items()])
