"""Incremental ingest: file streams that end in the batch upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hindcast.schemas import OBSERVATION
from hindcast.session import configure, ready_checkpoints
from hindcast.sources.archives import delta_table, upsert_forecasts, upsert_observations
from hindcast.sources.deltas import ABOVE


def file_stream(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet",
                glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _upsert_stream(stream: DataFrame, store: str, schema: T.StructType, checkpoint: str, write: Callable) -> StreamingQuery:
    """Each micro-batch is one batch of the store, named by the stream and its number, so a repeated one adds nothing.
    Partitions that lie in many batches are compacted."""
    def each(batch: DataFrame, batch_id: int) -> None:
        configure(batch.sparkSession)
        ordered = batch if "write_seq" in batch.columns else batch.withColumn("write_seq", F.lit(batch_id))
        write(ordered, stream=checkpoint, batch_id=batch_id)
        delta_table(batch.sparkSession, store, schema).compact(ABOVE)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_observations(stream: DataFrame, store: str, schema: T.StructType, checkpoint: str) -> StreamingQuery:
    """Upsert arriving measurements. A batch may be repeated after a failure: the upsert is idempotent."""
    return _upsert_stream(stream, store, schema, checkpoint, lambda batch, **of: upsert_observations(batch, store, schema, **of))


def ingest_forecasts(stream: DataFrame, store: str, schema: T.StructType, checkpoint: str) -> StreamingQuery:
    """Upsert arriving forecasts under the precedence rule."""
    return _upsert_stream(
        stream, store, schema, checkpoint, lambda batch, **of: upsert_forecasts(batch, store, schema, may_be_empty=True, **of))


def hourly_means(stream: DataFrame, *, value: str = "value", ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """Tumbling hourly mean per series. An hour is emitted once, when no reading may still be late for it."""
    return (
        stream.withWatermark(ts, late)
        .groupBy("series_id", F.window(ts, "1 hour").alias("_hour"))
        .agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("readings"))
        .select("series_id", F.col("_hour.start").alias(ts), value, "readings")
    )


HOURS = T.StructType([*OBSERVATION.fields, T.StructField("readings", T.LongType())])


def maintain_hours(stream: DataFrame, readings: str, hours: str, checkpoint: str) -> StreamingQuery:
    """Keep hourly means right however late a reading comes, also after its hour was closed and read by others.

    A micro-batch adds its readings to their store, then recomputes from that store the hours it touches, and those
    alone, and adds them to the store of hours, where the newer row of an hour counts. Both stores log the batch: one that
    is repeated after a failure adds what is missing and nothing twice. No state is kept but the stores, so no watermark
    bounds how late a reading may be.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        ready_checkpoints(spark)
        raw, view = delta_table(spark, readings, OBSERVATION), delta_table(spark, hours, HOURS)
        ordered = batch if "write_seq" in batch.columns else batch.withColumn("write_seq", F.lit(batch_id))
        # Written once, as three steps below read it: rows, folders and hours must be of the same data.
        ordered = ordered.checkpoint()
        raw.append(ordered, stream=checkpoint, batch_id=batch_id)
        hour = F.date_trunc("hour", "ts").alias("_hour")
        touched = ordered.where(F.col("ts").isNotNull()).select("series_id", hour).distinct()
        whole = raw.read_folders(raw.folders(ordered)).withColumn("_hour", hour)
        again = whole.join(
            touched, whole["series_id"].eqNullSafe(touched["series_id"]) & (whole["_hour"] == touched["_hour"]), "left_semi"
        ).groupBy("series_id", "_hour").agg(F.avg("value").alias("value"), F.count("value").alias("readings"))
        view.append(again.withColumnRenamed("_hour", "ts"), stream=checkpoint, batch_id=batch_id)
        for table in (raw, view):
            table.compact(ABOVE)

    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
