import random
import re
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import hours, utc
from hindcast.schemas import OBSERVATION
from hindcast.sources.archives import delta_table, read_store, upsert_observations
from hindcast.sources.deltas import Conflict

START = utc("2023-10-31 20:00")
NUMBERED = "series_id string, ts timestamp, value double, write_seq long"


def rows(spark, series, values, start=START):
    return spark.createDataFrame([(s, t, float(v)) for s in series for t, v in zip(hours(start, len(values)), values)], OBSERVATION)


def files(path):
    return {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def test_a_batch_of_one_series_touches_one_bucket_and_reads_no_other(spark, path):
    upsert_observations(rows(spark, [f"s{i}" for i in range(40)], range(8)), path, OBSERVATION)
    before = files(path)
    assert upsert_observations(rows(spark, ["s3"], [9]), path, OBSERVATION) == ["2023-10"]
    new = files(path) - before
    assert before < files(path) and len({re.search(r"ref_month=[^/]+/bucket=\d+", f)[0] for f in new}) == 1
    bucket = re.search(r"bucket=\d+", next(iter(new)))[0]
    read = read_store(spark, path, OBSERVATION, months=["2023-10"], series=["s3"])
    assert all(bucket in f and "2023-10" in f for f in read.inputFiles())
    assert sorted(r.value for r in read.collect()) == [1, 2, 3, 9]
    assert read_store(spark, path, OBSERVATION, series=["absent"]).count() == 0


def test_readers_keep_the_version_they_began_with(spark, path):
    table = delta_table(spark, path, OBSERVATION)
    upsert_observations(rows(spark, ["a", "b"], [1, 2]), path, OBSERVATION)
    held = table.read()
    upsert_observations(rows(spark, ["a"], [5, 6, 7]), path, OBSERVATION)
    table.compact()
    assert sorted((r.series_id, r.value) for r in held.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert sorted((r.series_id, r.value) for r in table.read().collect()) == [("a", 5), ("a", 6), ("a", 7), ("b", 1), ("b", 2)]
    assert table.read(version=1).count() == 4


def test_compaction_changes_no_row_and_lessens_files(spark, path):
    rng = random.Random(5)
    table, expected, seq = delta_table(spark, path, OBSERVATION), {}, {}
    for batch in range(6):
        some = [(rng.choice("abc"), START + timedelta(hours=rng.randrange(9)), float(rng.randrange(99)), rng.randrange(50) * 10 + batch) for _ in range(20)]
        some = list({(s, t): (s, t, v, n) for s, t, v, n in some}.values())
        for s, t, v, n in some:
            if n > seq.get((s, t), -1):
                expected[s, t.replace(tzinfo=None)], seq[s, t] = v, n
        upsert_observations(spark.createDataFrame(some, NUMBERED), path, OBSERVATION)
        if batch in (2, 5):
            table.compact()
            assert len({f.split("/")[1] for f in files(path)}) >= 1 and max(map(list(p[1:] for p in table.version().parts).count, [p[1:] for p in table.version().parts])) == 1
        assert {(r.series_id, r.ts): r.value for r in table.read().collect()} == expected
    assert table.compact() is None
    count = table.read().count()
    table.vacuum(keep=1)
    assert table.read().count() == count and len({f.split("/")[1] for f in files(path)}) == len({p[0] for p in table.version().parts})


def test_unnumbered_batches_are_written_after_all_others(spark, path):
    upsert_observations(spark.createDataFrame([("a", START, 1.0, 7)], NUMBERED), path, OBSERVATION)
    upsert_observations(rows(spark, ["a"], [2]), path, OBSERVATION)
    late = spark.createDataFrame([("a", START, 3.0, 6)], NUMBERED)
    for step in range(2):
        upsert_observations(late, path, OBSERVATION)
        assert [r.value for r in read_store(spark, path, OBSERVATION).collect()] == [2.0]
        delta_table(spark, path, OBSERVATION).compact()
    upsert_observations(spark.createDataFrame([("a", START, 4.0, 8)], NUMBERED), path, OBSERVATION)
    assert [r.value for r in read_store(spark, path, OBSERVATION).collect()] == [4.0]


def test_a_repeated_stream_batch_counts_once(spark, path):
    table = delta_table(spark, path, OBSERVATION)
    for batch_id in (0, 1, 1, 0):
        upsert_observations(rows(spark, ["a"], [batch_id]), path, OBSERVATION, stream="s", batch_id=batch_id)
    assert table.version().number == 2 and [r.value for r in table.read().collect()] == [1.0]
    upsert_observations(rows(spark, ["a"], []), path, OBSERVATION, stream="s", batch_id=2)
    assert dict(table.version().streams) == {"s": 2}


def test_two_writers(spark, path):
    one, two = (delta_table(spark, path, OBSERVATION) for _ in range(2))
    one.append(rows(spark, ["a"], [1]))
    stale = two.version()
    one.append(rows(spark, ["a"], [2]))
    assert not two._publish(stale.__class__(stale.number + 1))
    two.append(rows(spark, ["b"], [3]))
    assert sorted(r.value for r in one.read().collect()) == [2.0, 3.0]
    # A compaction between the reading and the commit of another one takes its parts away.
    write = two._write

    def overtaken(*given):
        one.compact()
        return write(*given)

    two._write = overtaken
    with pytest.raises(Conflict):
        two.compact()
    assert sorted(r.value for r in one.read().collect()) == [2.0, 3.0]


def test_nulls_empty_batches_and_odd_series(spark, path):
    table = delta_table(spark, path, OBSERVATION)
    assert table.read().count() == 0 and upsert_observations(rows(spark, ["a"], []), path, OBSERVATION) == []
    odd = spark.createDataFrame([(None, START, 1.0, 5), ("", START, None, 6), ("a/b=c", START, 2.0, 7)], "series_id string, ts timestamp, value double, batch int")
    table.append(odd)
    assert sorted(map(str, (tuple(r) for r in table.read().select("series_id", "value").collect()))) == sorted(
        map(str, [(None, 1.0), ("", None), ("a/b=c", 2.0)]))
    assert table.read().where(F.col("series_id") == "a/b=c").count() == 1
