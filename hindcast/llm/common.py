"""What several operators of this folder share: words, tables written once, column guards."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.session import shared_dir

# Fixed value: a word is a run of characters other than blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage and outlives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that long texts travel in by bytes, not by rows alone."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def share_of(key: Column, share: float) -> Column:
    """True for about that share of the keys, the same ones in every run."""
    return F.pmod(F.xxhash64(key, F.lit("share")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
