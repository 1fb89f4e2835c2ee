"""Views that present the test tables as gauge readings, weather, forecasts, archives and pages.

Every view keeps all rows of its table. Arithmetic on ids only spreads nulls, kinds and weather values over them.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.functions.zones import to_local
from hindcast.operators.metrics import side_by_side
from hindcast.operators.selection import keep_one
from hindcast.operators.timeseries import (
    fill_both_ways, hourly_first, hourly_mean, hourly_weather, interpolate_time, last_known, on_grid, rolling_origins,
)
from hindcast.schemas import BACKTEST_OFFSETS, QUANTILES
from hindcast.session import shared_dir

# Raw reports have unique times, so a block of five minutes has a hard upper bound even for a very dense series.
RAW_BLOCK = 300


def hours(count: Column) -> Column:
    return F.expr("interval 1 hour") * count


@lru_cache(maxsize=None)
def _layout(path: str):
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_layout(path)).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for a table this run writes and reads back."""
    return f"{shared_dir(spark)}/hindcast-{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder, for results that several later steps read.

    Readings shrink to hourly rows here, so the raw table is scanned once however often the hours are used.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def every(n: int, column: str = "event_id") -> Column:
    return F.col(column) % n == 0


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def obs(spark: SparkSession, folder: str) -> DataFrame:
    """Gauge readings, one series per event type, some without a value."""
    return events(spark, folder).select(
        F.col("event_type").alias("series_id"), "ts", F.when(~every(13), F.col("value")).alias("value"),
        "event_id", "user_id",
    )


def gauge(spark: SparkSession, folder: str) -> DataFrame:
    return hourly_first(obs(spark, folder))


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder)
    return e.select(
        F.col("event_type").alias("series_id"), "ts", "event_id",
        F.when(~every(11), (F.col("user_id") % 30).cast("double")).alias("temperature"),
        F.when(~every(7), (F.col("event_id") % 10).cast("double") / 10).alias("precipitation"),
        F.when(~every(17), 990 + (F.col("event_id") % 40).cast("double")).alias("pressure_msl"),
    )


def clean_weather(spark: SparkSession, folder: str) -> DataFrame:
    """First report per time, no rain where none is reported, gaps interpolated, then hourly."""
    first = keep_one(raw_weather(spark, folder), ["series_id", "ts"], [F.asc("event_id")])
    dry = first.select(
        "series_id", "ts", F.col("temperature").alias("airtemp"), F.col("pressure_msl").alias("pressure"),
        F.coalesce("precipitation", F.lit(0.0)).alias("precip"),
    )
    smooth = interpolate_time(dry, ["airtemp", "pressure"], block_seconds=RAW_BLOCK)
    return hourly_weather(smooth, means=["airtemp", "pressure"], sums=["precip"])


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free hourly means."""
    return fill_both_ways(hourly_mean(obs(spark, folder)), ["value"])


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly means of clicks beside those of every other series."""
    means = obs(spark, folder).groupBy("series_id", F.date_trunc("hour", "ts").alias("ts")).agg(
        F.avg("value").alias("value")
    )
    return side_by_side(means, "click", "value", "first_river", "second_river")


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Long daily series per order priority, scaled to look like temperatures, without gaps."""
    o = table(spark, folder, "orders")
    days = o.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("ts")
    ).agg((F.avg("o_totalprice") / 18000).alias("value"))
    return fill_both_ways(on_grid(days, step="day"), ["value"], block_seconds=720 * 86_400)


def day_number() -> Column:
    return F.floor(F.unix_micros("ts") / F.lit(86_400_000_000))


def kind_of(column: str = "user_id") -> Column:
    k = F.col(column) % 4
    return F.when(k == 0, "live").when(k == 1, "replay").when(k == 2, "oracle").otherwise("wishful")


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Forecast rows that compete for the same steps."""
    e = events(spark, folder)
    at = F.date_trunc("hour", "ts")
    return e.select(
        F.col("event_type").alias("series_id"), at.alias("reference_time"),
        (at + hours(F.col("event_id") % 4 + 1)).alias("target_time"),
        kind_of().alias("kind"), F.concat(F.lit("src-"), (F.col("user_id") % 3).cast("string")).alias("covariate_source"),
        F.when(~every(19), F.col("ts")).alias("issued_at"), F.lit("m1").alias("model_id"), F.lit("v1").alias("code_version"),
        F.col("value").alias("wassertemp"), F.col("event_id").alias("write_seq"),
    )


def known_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with the refused kind read as the lowest one."""
    kind = F.when(F.col("kind") == "wishful", "oracle").otherwise(F.col("kind"))
    return candidates(spark, folder).withColumn("kind", kind)


def asks(spark: SparkSession, folder: str) -> DataFrame:
    """Every event asks for what was known at its time."""
    return events(spark, folder).select(
        F.col("event_id").alias("request_id"), F.col("event_type").alias("series_id"), F.col("ts").alias("ref")
    )


def snapshot_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Weather fetches: anchored at the hour, fetched up to six hours later, some without an anchor."""
    e = events(spark, folder)
    return e.select(
        F.col("event_type").alias("series_id"), F.when(~every(17), F.date_trunc("hour", "ts")).alias("reference_time"),
        (F.date_trunc("minute", "ts") + F.expr("interval 1 minute") * (F.col("user_id") * 7 % 360)).alias("fetched_at"),
        F.col("value").alias("temperature"), F.col("event_id").alias("write_seq"),
    )


def quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Seven levels for every hour that has readings, some levels missing, with the first reading as truth."""
    hours = obs(spark, folder).where(F.col("value").isNotNull()).groupBy(
        "series_id", F.date_trunc("hour", "ts").alias("target_time")
    ).agg(F.min_by("value", "ts").alias("actual"), F.avg("value").alias("base"), F.min("event_id").alias("seed"))
    levels = F.explode(F.array(*[F.lit(q) for q in QUANTILES])).alias("q")
    value = F.when((F.col("seed") + F.floor(F.col("q") * 100)) % 13 != 0, F.col("base") * (0.5 + F.col("q")))
    return hours.select(
        "series_id", F.date_trunc("day", "target_time").alias("reference_time"), "target_time", "actual", "seed", levels, "base",
    ).select(
        "series_id", "reference_time", "target_time", "actual", F.lit("wassertemp").alias("channel"), "q",
        value.alias("value"),
    )


def bands(spark: SparkSession, folder: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    at = F.col("q")
    return quantiles(spark, folder).groupBy("series_id", "reference_time", "target_time", "actual").agg(
        F.max(F.when(at == low, F.col("value"))).alias("low"), F.max(F.when(at == high, F.col("value"))).alias("high")
    )


def requests(gauge: DataFrame, offsets=BACKTEST_OFFSETS) -> DataFrame:
    """Backtests of every series at fixed offsets back from its last reading."""
    origins = rolling_origins(last_known(gauge), offsets)
    return origins.withColumn(
        "request_id", F.concat_ws("|", "series_id", F.col("offset_hours").cast("string"))
    ).select("request_id", "series_id", "offset_hours", "ref")


def archive(gauge: DataFrame) -> DataFrame:
    """Stored forecasts of every hour: four steps, three levels each; live runs on some days, replays or oracles on others."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(4))).alias("step")
    levels = F.explode(F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("q")
    kind = F.when(day_number() % 3 != 0, "oracle").when(F.hour("ts") % 3 == 0, "live").when(F.hour("ts") % 3 == 1, "replay").otherwise("oracle")
    return gauge.select("series_id", "ts", "value", kind.alias("kind"), steps).select("*", levels).select(
        "series_id", F.col("ts").alias("reference_time"), (F.col("ts") + hours(F.col("step"))).alias("target_time"),
        "kind", F.lit("dwd_forecast").alias("covariate_source"), F.col("ts").alias("issued_at"),
        F.lit("m1").alias("model_id"), F.lit("v1").alias("code_version"), F.lit("wassertemp").alias("channel"), "q",
        (F.col("value") / 10 + F.col("step") * 0.1 + (F.col("q") - 0.5)).alias("value"),
    )


def snapshots(gauge: DataFrame) -> DataFrame:
    """Weather forecasts of every hour with holes, reaching 120 hours ahead; on some days they come off the hour, days late."""
    ahead = F.explode(F.sequence(F.lit(-2), F.lit(120))).alias("step")
    at = F.col("ts") + hours(F.col("step"))
    late = day_number() % 3 == 1
    anchor = F.when(late, F.col("ts") + F.expr("interval 20 minutes")).otherwise(F.col("ts"))
    fetched = F.when(late, F.col("ts") + F.expr("interval 3 days")).otherwise(F.col("ts") + F.expr("interval 30 minutes"))
    return gauge.select("series_id", "ts", "value", ahead).select(
        "series_id", anchor.alias("reference_time"), fetched.alias("fetched_at"), at.alias("ts"),
        F.when(F.col("step") % 9 != 0, 5 + F.hour(at) * 0.5 + F.coalesce("value", F.lit(0.0)) / 100).alias("airtemp"),
        F.when(F.col("step") % 7 != 0, 1000 + F.hour(at) * 0.25).alias("pressure"),
    )


CHUNK = 64


def chunked(df: DataFrame, item: Column) -> DataFrame:
    """Rows gathered into payloads of at most ``CHUNK`` items, so that no payload grows with its series."""
    return df.groupBy("series_id", F.floor(F.col("event_id") / CHUNK).alias("payload_id")).agg(
        F.collect_list(item).alias("items")
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Weather answers as JSON text; some are cut off, some hold no hours."""
    hour = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), "temperature", "precipitation", "pressure_msl"
    )
    text = F.to_json(F.struct(F.col("items").alias("weather")))
    body = (
        F.when(F.col("payload_id") % 10 == 3, F.expr("substring(_text, 1, length(_text) - 5)"))
        .when(F.col("payload_id") % 10 == 7, F.lit('{"weather": []}'))
        .otherwise(F.col("_text"))
    )
    return chunked(raw_weather(spark, folder), hour).withColumn("_text", text).select(
        "series_id", "payload_id", body.alias("body")
    )


def gauge_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as HTML tables in both layouts; some pages hold no table."""
    value = F.coalesce(F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")), F.lit("--"))
    both = F.concat(
        F.lit("<tr><td>"), F.date_format("ts", "dd.MM.yyyy HH:mm"), F.lit(" Uhr</td><td> "), value, F.lit("</td></tr>")
    )
    split = F.concat(
        F.lit("<tr><th>"), F.date_format("ts", "dd.MM.yyyy"), F.lit("</th><td>"), F.date_format("ts", "HH:mm"),
        F.lit("</td><td><b>"), value, F.lit("</b></td></tr>"),
    )
    gathered = chunked(obs(spark, folder), F.struct(both.alias("both"), split.alias("split")))
    head = (
        "<html><body><p>x</p><table class='{cls} wide'><thead><tr>{cells}</tr></thead><tbody>"
    )
    one = head.format(cls="tblsort", cells="<th>Zeit</th><th>Wassertemperatur [&deg;C]</th>")
    two = head.format(cls="datentabelle", cells="<th>Datum</th><th>Uhrzeit</th><th>Wassertemp.</th>")
    tail = F.lit("</tbody></table></body></html>")
    page = F.col("payload_id") % 5
    html = (
        F.when(page == 4, F.lit("<html><body><p>No data</p></body></html>"))
        .when(page % 2 == 0, F.concat(F.lit(one), F.array_join("items.both", ""), tail))
        .otherwise(F.concat(F.lit(two), F.array_join("items.split", ""), tail))
    )
    return gathered.select("series_id", "payload_id", html.alias("html"))


def wall_times(spark: SparkSession, folder: str) -> DataFrame:
    """Hours with readings, moved to the weeks around both clock changes of 2024 and written as wall time."""
    hours = obs(spark, folder).groupBy("series_id", F.date_trunc("hour", "ts").alias("at")).agg(
        F.count(F.lit(1)).alias("readings")
    )
    spring = hours.select(
        F.concat("series_id", F.lit("|spring")).alias("series_id"), "readings", "at",
        (F.col("at") + F.expr("interval 80 days")).cast("timestamp_ntz").alias("wall"),
    )
    autumn = hours.select(
        F.concat("series_id", F.lit("|autumn")).alias("series_id"), "readings", "at",
        to_local(F.col("at") + F.expr("interval 290 days")).alias("wall"),
    )
    return spring.unionByName(autumn)
