"""Month-partitioned stores for forecasts, weather snapshots and observations."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.functions.scalars import as_utc, named, nan_to_null
from hindcast.operators.upserts import (
    require_known_kinds, stamp_forecast, stored_forecasts, stored_observations, stored_snapshots,
)
from hindcast.schemas import LEGACY_VERSION, SOURCE_LIVE
from hindcast.sources.deltas import DeltaTable


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def delta_table(spark: SparkSession, path: str, schema: T.StructType) -> DeltaTable:
    """The table of forecasts, weather snapshots or observations with that layout."""
    if "target_time" in schema.names:
        return DeltaTable(spark, path, schema, F.col("reference_time"), stored_forecasts)
    if "fetched_at" in schema.names:
        return DeltaTable(spark, path, schema, F.coalesce("reference_time", "fetched_at"), stored_snapshots)
    return DeltaTable(spark, path, schema, F.col("ts"), stored_observations)


def read_store(spark: SparkSession, path: str, schema: T.StructType, months: Sequence[str] | None = None,
               series: Sequence[str] | None = None) -> DataFrame:
    """Rows that count of some or all months and series; a store that does not exist yet is empty.

    Months and series are looked up in the version's list, so only their folders are listed and read.
    """
    return delta_table(spark, path, schema).read(months, series)


def read_csv_months(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Hand-readable monthly files whose columns may differ; missing or empty files count as no rows.

    Columns are matched by header name, times are read in either spelling as UTC, unreadable cells become null. One job
    reads the headers of all files; after that there is one scan per distinct header, however many files share it.
    """
    frames = []
    for names, files in csv_layouts(spark, paths).items():
        layout = T.StructType([T.StructField(name, T.StringType()) for name in names])
        raw = spark.read.schema(layout).option("header", True).csv(files)
        frames.append(raw.select(*[_cell(raw, f).alias(f.name) for f in schema.fields]))
    return reduce(DataFrame.unionByName, frames) if frames else empty(spark, schema)


def csv_layouts(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below ``paths`` by the column names of their first line that is not blank; files without one are left out.

    The driver gets one row per file. A repeated or missing name is numbered, so that the first of its kind keeps it.
    """
    found = [path for path in paths if _exists(spark, path)]
    if not found:
        return {}
    lines = spark.read.text(found).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    # The first block of a file is read by one task, in order.
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("path").agg(
        F.min_by("value", "line").alias("header")
    )
    layouts = defaultdict(list)
    for row in first.orderBy("path").collect():
        names, seen = [], set()
        for at, name in enumerate(next(csv.reader([row.header.removeprefix("\ufeff")]))):
            names.append(name if name and name.lower() not in seen else f"{name}#{at}")
            seen.add(name.lower())
        layouts[tuple(names)].append(unquote(row.path))
    return dict(layouts)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    met = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return bool(met)


def _cell(raw: DataFrame, field: T.StructField) -> Column:
    if field.name not in raw.columns:
        return F.lit(None).cast(field.dataType)
    text = named(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return as_utc(text)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return nan_to_null(text.try_cast(field.dataType))
    return text.try_cast(field.dataType)


def read_forecasts(spark: SparkSession, path: str, schema: T.StructType, kinds: Sequence[str] | None = None
                   ) -> DataFrame:
    """Every stored forecast, optionally of some kinds only."""
    df = read_store(spark, path, schema)
    return df if kinds is None else df.where(F.col("kind").isin(*kinds))


def _upsert(incoming: DataFrame, path: str, schema: T.StructType, empty_error: str | None = None, **batch) -> list[str]:
    months = delta_table(incoming.sparkSession, path, schema).append(incoming, **batch)
    if not months and empty_error:
        raise ValueError(empty_error)
    return months


def upsert_forecasts(incoming: DataFrame, path: str, schema: T.StructType, may_be_empty: bool = False, **batch) -> list[str]:
    """Store forecasts under the precedence rule; a forecast stays in the month of its reference time.

    All upserts add a batch to the store and return the months it touches. ``stream`` and ``batch_id`` name a batch of a
    stream, which counts once however often it is written.
    """
    return _upsert(require_known_kinds(incoming), path, schema,
                   None if may_be_empty else "a forecast batch to be stored has no rows", **batch)


def upsert_snapshots(incoming: DataFrame, path: str, schema: T.StructType, **batch) -> list[str]:
    """Store weather snapshots, one per anchor. Times of fetch are given as ``fetched_at``; a snapshot without an anchor is
    anchored at its fetch."""
    anchored = incoming.withColumn("reference_time", F.coalesce("reference_time", "fetched_at"))
    return _upsert(anchored, path, schema, "a snapshot batch to be stored has no rows", **batch)


def upsert_observations(incoming: DataFrame, path: str, schema: T.StructType, **batch) -> list[str]:
    """Store measurements, newest value per time, split over months."""
    return _upsert(incoming, path, schema, **batch)


def migrate_legacy(spark: SparkSession, legacy: str, path: str, schema: T.StructType,
                   series_id: str = "legacy") -> int:
    """Fold a flat forecast file into the partitioned store and return how many rows it held.

    All of it came from live runs; the reference time stands in for the issue time that was never recorded.
    """
    try:
        raw = spark.read.option("header", True).csv(legacy)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return 0
    times = ("reference_time", "target_time")
    if not set(times) <= set(raw.columns):
        return 0
    values = [c for c in raw.columns if c not in (*times, "series_id")]
    owner = F.col("series_id") if "series_id" in raw.columns else F.lit(series_id)
    rows = raw.select(
        owner.alias("series_id"), *[as_utc(F.col(c)).alias(c) for c in times],
        *[nan_to_null(named(c).try_cast("double")).alias(c) for c in values],
    )
    stamped = stamp_forecast(
        rows, kind="live", covariate_source=SOURCE_LIVE, issued_at=F.col("reference_time"),
        code_version=LEGACY_VERSION,
    )
    migrated = rows.count()
    if migrated:
        upsert_forecasts(stamped, path, schema)
    return migrated
