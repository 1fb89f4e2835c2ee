"""Exports for people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.functions.zones import to_local
from hindcast.schemas import LOCAL_ZONE


def readable(df: DataFrame, *, ts: str = "target_time", zone: str = LOCAL_ZONE) -> DataFrame:
    """Times as local wall-clock text without an offset."""
    return df.withColumn(ts, F.date_format(to_local(F.col(ts), zone), "yyyy-MM-dd HH:mm"))


def write_readable(df: DataFrame, path: str, *, ts: str = "target_time", zone: str = LOCAL_ZONE) -> None:
    readable(df, ts=ts, zone=zone).write.mode("overwrite").option("header", True).csv(path)
