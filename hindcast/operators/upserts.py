"""Archive maintenance as pure functions: what is stored plus what arrives gives what is stored next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.functions.scalars import month_key, named
from hindcast.operators.selection import keep_one, resolve_precedence
from hindcast.schemas import KIND_RANKS


def stamp_forecast(df: DataFrame, *, kind: str, covariate_source: str, issued_at: Column, model_id: str = "",
                   code_version: str = "") -> DataFrame:
    """Attach provenance to forecast rows that are about to be archived."""
    if kind not in KIND_RANKS:
        raise ValueError(f"kind {kind!r} has no precedence; known are {sorted(KIND_RANKS)}")
    return (
        df.withColumn("kind", F.lit(kind))
        .withColumn("covariate_source", F.lit(covariate_source))
        .withColumn("issued_at", issued_at)
        .withColumn("model_id", F.lit(model_id))
        .withColumn("code_version", F.lit(code_version))
    )


def require_known_kinds(df: DataFrame) -> DataFrame:
    """Fail the job when a row to be archived has a kind outside the precedence order."""
    known = F.coalesce(F.col("kind").isin(*KIND_RANKS), F.lit(False))
    fail = F.raise_error(F.concat(F.lit("kind without precedence: "), F.coalesce("kind", F.lit("null")))).cast("string")
    return df.withColumn("kind", F.when(known, F.col("kind")).otherwise(fail))


def in_write_order(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both sides with ``_seq``, the order in which rows were written.

    Stored rows keep the ``write_seq`` they came with, so a batch that was cut differently, or delivered late, meets the
    same order. A batch without any is the latest write; once stored, it gives way to every numbered one.
    """
    def ordered(df: DataFrame, missing: int) -> DataFrame:
        known = F.col("write_seq").cast("bigint") if "write_seq" in df.columns else F.lit(None).cast("bigint")
        return df.withColumn("_seq", F.coalesce(known, F.lit(missing)))

    both = ordered(existing, -1).unionByName(ordered(incoming, (1 << 63) - 1), allowMissingColumns=True)
    return both if "write_seq" in existing.columns else both.drop("write_seq")


def merge_forecasts(existing: DataFrame, incoming: DataFrame, *, long: bool = False) -> DataFrame:
    """Stored and new forecast rows under the precedence rule.

    A row that can be recomputed never replaces a genuine one; within a kind the newer issue wins, and on equal
    issue times the later write. ``long=True`` treats ``(channel, q)`` as part of the row's identity.
    """
    keys = ["series_id", "reference_time", "target_time", *(["channel", "q"] if long else [])]
    both = in_write_order(existing, require_known_kinds(incoming))
    return resolve_precedence(both, keys, tie=("_seq",)).drop("_seq")


def merge_snapshots(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored and new weather snapshots: one per anchor, and a repeated fetch replaces its earlier copy.

    Writing a snapshot removes stored rows of the same series and month that share its anchor *or* its fetch. Over a
    whole batch a snapshot therefore survives exactly when it is the last write of its anchor and of its fetch.
    ``incoming`` may carry ``write_seq`` to order several snapshots.
    """
    # A new snapshot without an anchor is anchored at its fetch; a stored one keeps its missing anchor.
    arriving = incoming.withColumn("reference_time", F.coalesce("reference_time", "fetched_at"))
    return surviving_snapshots(in_write_order(existing, arriving)).drop("_seq")


def surviving_snapshots(both: DataFrame) -> DataFrame:
    """Rows of the snapshots that are the last write, by ``_seq``, of their anchor and of their fetch."""
    both = both.withColumn("_month", month_key(F.coalesce("reference_time", "fetched_at")))

    identity = ["series_id", "reference_time", "fetched_at", "_seq"]
    heads = both.select(*identity, "_month").distinct()
    by_anchor = heads.where(F.col("reference_time").isNotNull()).groupBy("series_id", "reference_time").agg(
        F.max("_seq").alias("_last_anchor")
    )
    by_fetch = heads.groupBy("series_id", "_month", "fetched_at").agg(F.max("_seq").alias("_last_fetch"))
    alive = (
        heads.join(by_fetch, ["series_id", "_month", "fetched_at"])
        .join(by_anchor, ["series_id", "reference_time"], "left")
        .where(F.col("_seq") == F.col("_last_fetch"))
        .where(F.col("_last_anchor").isNull() | (F.col("_seq") == F.col("_last_anchor")))
        .select(*identity, F.lit(True).alias("_alive"))
    )
    match = (
        (both.series_id == alive.series_id)
        & both.reference_time.eqNullSafe(alive.reference_time)
        & (both.fetched_at == alive.fetched_at)
        & (both._seq == alive._seq)
    )
    return both.join(alive, match, "left_semi").drop("_month")


def stored_forecasts(rows: DataFrame) -> DataFrame:
    """What counts among all rows ever stored, which carry ``write_seq`` and ``write_no``."""
    keys = ["series_id", "reference_time", "target_time", *(["channel", "q"] if "channel" in rows.columns else [])]
    return resolve_precedence(rows, keys, tie=("write_seq", "write_no"))


def stored_snapshots(rows: DataFrame) -> DataFrame:
    return surviving_snapshots(rows.withColumn("_seq", F.struct("write_seq", "write_no"))).drop("_seq")


def stored_observations(rows: DataFrame) -> DataFrame:
    rest = [named(c).desc_nulls_last() for c in rows.columns if c not in ("series_id", "ts", "write_seq", "write_no")]
    return keep_one(rows, ["series_id", "ts"], [F.desc("write_seq"), F.desc("write_no"), *rest])


def merge_observations(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored and new measurements: the value of the latest batch wins for each time."""
    both = in_write_order(existing, incoming)
    # Two values of one batch for one time have no stated order; the larger is kept so that reruns agree.
    rest = [named(c).desc_nulls_last() for c in existing.columns if c not in ("series_id", "ts", "write_seq")]
    return keep_one(both, ["series_id", "ts"], [F.desc("_seq"), *rest]).drop("_seq")


def union_chunks(chunks: list[DataFrame], keys: list[str], order: str = "ts") -> DataFrame:
    """Overlapping downloads laid end to end; the earliest chunk keeps a repeated time."""
    parts = [c.withColumn("_chunk", F.lit(i)) for i, c in enumerate(chunks)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return keep_one(whole, keys, [F.asc("_chunk")]).drop("_chunk")
