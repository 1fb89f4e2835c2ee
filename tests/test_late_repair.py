from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import utc
from hindcast.schemas import OBSERVATION
from hindcast.sources.archives import delta_table, read_store
from hindcast.sources.deltas import DeltaTable
from hindcast.streaming import ingest

START = utc("2024-01-31 22:00")


def arrivals(spark, folder, batches):
    for i, rows in enumerate(batches):
        made = spark.createDataFrame([(s, START + timedelta(minutes=m), v) for s, m, v in rows], OBSERVATION)
        made.coalesce(1).write.parquet(f"{folder}/b{i}")
    return ingest.file_stream(spark, f"{folder}/*", OBSERVATION, files_per_batch=1)


def means(spark, path):
    return {(r.series_id, r.ts): (r.value, r.readings) for r in read_store(spark, path, ingest.HOURS).collect()}


BATCHES = [
    [("a", 0, 1.0), ("a", 30, 3.0), ("a", 130, 5.0), ("b", 10, 7.0)],
    [("a", 3000, 9.0)],  # far ahead: hours before are closed for any watermark
    [("a", 40, 8.0), ("a", 30, 5.0), ("b", 70, None), (None, 5, 2.0)],  # late, and a corrected reading
]


def expected():
    last = {}
    for batch in BATCHES:
        for s, m, v in batch:
            last[s, m] = v
    out = {}
    for (s, m), v in last.items():
        out.setdefault((s, (START + timedelta(hours=m // 60)).replace(tzinfo=None)), []).append(v)
    return {k: (sum(x for x in v if x is not None) / max(1, len([x for x in v if x is not None])) if any(x is not None for x in v) else None,
                len([x for x in v if x is not None])) for k, v in out.items()}


def test_late_readings_repair_closed_hours(spark, tmp_path):
    stream = arrivals(spark, tmp_path / "in", BATCHES)
    raw, hours = str(tmp_path / "raw"), str(tmp_path / "hours")
    ingest.maintain_hours(stream, raw, hours, str(tmp_path / "progress")).awaitTermination()
    assert means(spark, hours) == expected()
    # Only touched hours were recomputed: the last batch wrote rows for its own hours and no other.
    table = delta_table(spark, hours, ingest.HOURS)
    last = table.version().batches[-1][0]
    written = spark.read.parquet(f"{hours}/rows/batch={last}").select("ts").distinct().count()
    assert written == 2 and table.version(2).number == 2


@pytest.mark.parametrize("fails_at", [1, 3, 5])
def test_a_failure_between_the_stores_is_made_good(spark, tmp_path, monkeypatch, fails_at):
    stream = arrivals(spark, tmp_path / "in", BATCHES)
    raw, hours, progress = (str(tmp_path / n) for n in ("raw", "hours", "progress"))
    append, calls = DeltaTable.append, []

    def failing(self, *given, **how):
        calls.append(1)
        if len(calls) == fails_at + 1:
            raise RuntimeError("executor lost")
        return append(self, *given, **how)

    monkeypatch.setattr(DeltaTable, "append", failing)
    with pytest.raises(Exception, match="executor lost"):
        ingest.maintain_hours(stream, raw, hours, progress).awaitTermination()
    monkeypatch.setattr(DeltaTable, "append", append)
    ingest.maintain_hours(stream, raw, hours, progress).awaitTermination()
    assert means(spark, hours) == expected()
    assert delta_table(spark, raw, OBSERVATION).version().number == 3


def test_compaction_while_streaming(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "ABOVE", 1)
    stream = arrivals(spark, tmp_path / "in", BATCHES)
    hours = str(tmp_path / "hours")
    ingest.maintain_hours(stream, str(tmp_path / "raw"), hours, str(tmp_path / "progress")).awaitTermination()
    assert means(spark, hours) == expected()
    assert read_store(spark, hours, ingest.HOURS).where(F.col("series_id").isNull()).count() == 1
