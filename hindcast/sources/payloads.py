"""Stored service answers to rows: weather as JSON, gauge tables as HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.functions.scalars import as_utc, decimal_comma, gauge_wall_time
from hindcast.schemas import WEATHER_PAYLOAD

_CHECKED = T.StructType([*WEATHER_PAYLOAD.fields, T.StructField("_corrupt", T.StringType())])


def parse_weather(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Add ``hours`` and ``status``: ``failed`` (absent or unreadable), ``empty`` or ``ok``."""
    parsed = F.from_json(F.col(body), _CHECKED, {"columnNameOfCorruptRecord": "_corrupt"})
    failed = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    hours = F.when(~failed, F.col("_parsed.weather"))
    count = F.coalesce(F.size("hours"), F.lit(0))
    return (
        payloads.withColumn("_parsed", parsed)
        .withColumn("hours", hours)
        .withColumn("status", F.when(failed, "failed").when(count <= 0, "empty").otherwise("ok"))
        .drop("_parsed")
    )


def weather_hours(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per hour of each readable payload."""
    hours = parsed.where(F.col("status") == "ok").select(*keys, F.inline("hours"))
    return hours.withColumn("ts", as_utc(F.col("timestamp"))).drop("timestamp")


# The markup of the two gauge table layouts.
TABLE_CLASSES = ("tblsort", "datentabelle")
TIME_WORD = "Uhrzeit"
DATE_WORD = "Datum"
BOTH_WORDS = "Datum/Uhrzeit"


def _table(html: Column, name: str) -> Column:
    pattern = rf"(?is)<table\b[^>]*\bclass\s*=\s*[\"'][^\"']*(?<![\w-]){name}(?![\w-])[^\"']*[\"'][^>]*>(.*?)</table>"
    found = F.regexp_extract(html, pattern, 1)
    return F.when(found != "", found)


def _inside(html: Column, tag: str) -> Column:
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)


def _each(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


ENTITIES = (("&nbsp;", " "), ("&deg;", "°"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
BLANKS = " \t\r\n\u00a0"


def _text(html: Column) -> Column:
    """Cell markup to its text. Most cells hold neither tags nor entities and are only trimmed."""
    plain = F.when(F.contains(html, F.lit("<")), F.regexp_replace(html, r"<[^>]*>", "")).otherwise(html)
    decoded = plain
    for entity, char in ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.btrim(F.when(F.contains(html, F.lit("&")), decoded).otherwise(plain), F.lit(BLANKS))


def gauge_readings(pages: DataFrame, column: str, *, keys: list[str], html: str = "html") -> DataFrame:
    """Rows ``(keys, wall, value)`` of every page that holds a recognisable measurement table.

    The measurement column is the first header containing the part of ``column`` before its first underscore. Pages
    without a table, date column or matching column give no rows; rows with an unreadable time are dropped.
    """
    prefix = column.split("_")[0].lower()
    # Exploding a one-element array pins its value: without that, every later use would run the patterns again.
    table = F.coalesce(*[_table(F.col(html), name) for name in TABLE_CLASSES])
    cut = pages.select(*keys, F.explode(F.array_compact(F.array(table))).alias("_table"))
    raw = F.transform(_each(_inside(F.col("_table"), "thead"), "th"), _text)
    headed = cut.select(*keys, "_table", F.explode(F.array(raw)).alias("_raw")).withColumn(
        "_heads",
        F.when(F.exists("_raw", lambda h: F.contains(h, F.lit(TIME_WORD))), F.col("_raw")).otherwise(
            F.concat(F.array(F.lit(BOTH_WORDS)), F.slice("_raw", 2, F.greatest(F.size("_raw"), F.lit(1))))
        ),
    )

    def position(name: str) -> Column:
        return F.array_position("_heads", F.lit(name)).cast("int")

    measured = F.filter("_heads", lambda h: F.contains(F.lower(h), F.lit(prefix)))
    placed = headed.select(
        *keys, "_table", position(BOTH_WORDS).alias("_both"), position(DATE_WORD).alias("_date"),
        position(TIME_WORD).alias("_time"),
        F.array_position("_heads", F.try_element_at(measured, F.lit(1))).cast("int").alias("_value"),
    ).where((F.col("_value") > 0) & ((F.col("_both") > 0) | ((F.col("_date") > 0) & (F.col("_time") > 0))))

    cells = F.transform(_each(_inside(F.col("_table"), "tbody"), "tr"), lambda row: _each(row, "t[dh]"))
    rows = placed.withColumn("_cells", F.explode(cells))

    def cell(index: str) -> Column:
        return F.when(F.col(index) > 0, _text(F.try_element_at("_cells", F.greatest(F.col(index), F.lit(1)))))

    stamp = F.coalesce(cell("_both"), F.concat_ws(" ", cell("_date"), cell("_time")))
    return (
        rows.select(*keys, gauge_wall_time(stamp).alias("wall"), decimal_comma(cell("_value")).alias("value"))
        .where(F.col("wall").isNotNull())
    )
