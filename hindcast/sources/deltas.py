"""Merge-on-read tables: batches are only ever added, readers pick the rows that count.

A batch is written once, as Parquet below ``rows/batch=<id>/ref_month=<month>/bucket=<k>``, where the bucket is a hash of
the series. It touches the partitions it has rows for and reads none. A version is one small file that lists the
partitions of all batches that count; it appears under its number by one rename that fails where the number is taken, so
of two writers one starts again from the other's version, and a reader works on the one version it began with. The
list holds folders, not rows: it grows with months, buckets and batches since the last compaction.

Every row keeps ``write_seq``, the order of writes, and ``write_no``, the number of its version. A batch without numbers
is written after everything the table held: it takes the highest order known, and on equal order the later version wins.
So the rows that count are told by a total order, however writes were cut into batches, and compaction may drop the
others at any time.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.functions.scalars import month_key, named

MONTH, BUCKET, BATCH = "ref_month", "bucket", "batch"
BUCKETS = 64
ORDER = ("write_seq", "write_no")
RETRIES = 20
ABOVE = 16  # batches of one partition before a stream compacts it

Resolve = Callable[[DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Another writer's version took away what this one was made from."""


@dataclass(frozen=True)
class Version:
    """What counts at one moment: partitions as (batch, month, bucket), the version and the order of writes that the rows of
    a batch have by default, the highest order of writes, and the last batch of each stream."""

    number: int = 0
    buckets: int = BUCKETS
    last_seq: int = -1
    parts: tuple[tuple[str, str, int], ...] = ()
    batches: tuple[tuple[str, int, int], ...] = ()
    streams: tuple[tuple[str, int], ...] = ()


def bucket_of(series: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(series), F.lit(buckets)).cast("int")


class DeltaTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, time: Column, resolve: Resolve):
        self.spark, self.path, self.time, self.resolve = spark, path.rstrip("/"), time, resolve
        self.schema = T.StructType([f for f in schema.fields if f.name not in ORDER])
        self.stored = T.StructType([*self.schema.fields, *[T.StructField(c, T.LongType()) for c in ORDER]])
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs
        self._root = self._fs.Path(self.path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._root.getFileSystem(conf)
        self._context = self._fs.FileContext.getFileContext(self._files.getUri(), conf)

    # ---- versions

    def _names(self, folder: str) -> list[str]:
        place = self._fs.Path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._files.listStatus(place)] if self._files.exists(place) else []

    def version(self, number: int | None = None) -> Version:
        """The newest version, or that one; a table that does not exist yet has version 0 without rows."""
        if number is None:
            number = max((int(n[:-5]) for n in self._names("versions") if n.endswith(".json")), default=0)
        if not number:
            return Version()
        text = self.spark.read.text(f"{self.path}/versions/{number:012d}.json", wholetext=True).first()[0]
        held = json.loads(text)
        lists = [tuple(map(tuple, held[name])) for name in ("parts", "batches", "streams")]
        return Version(number, held["buckets"], held["last_seq"], *lists)

    def _publish(self, version: Version) -> bool:
        """Whether the version's number was still free."""
        text = json.dumps(asdict(version))
        draft = self._fs.Path(f"{self.path}/versions/.draft-{uuid.uuid4().hex}")
        out = self._files.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._fs.Options.Rename, 0)
        try:
            self._context.rename(draft, self._fs.Path(f"{self.path}/versions/{version.number:012d}.json"), options)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _commit(self, change: Callable[[Version], Version]) -> Version:
        for _ in range(RETRIES):
            now = self.version()
            new = replace(change(now), number=now.number + 1)
            if self._publish(new):
                return new
        raise Conflict(f"{self.path}: no free version after {RETRIES} tries")

    # ---- writing

    def _write(self, rows: DataFrame, buckets: int) -> tuple[str, list[tuple[str, str, int]], int | None]:
        """One batch of files: its id, its partitions, none without rows, and its highest order."""
        batch = uuid.uuid4().hex
        folder = f"{self.path}/rows/{BATCH}={batch}"
        seen = Observation()
        stamped = rows.withColumn(MONTH, month_key(self.time)).withColumn(BUCKET, bucket_of(F.col("series_id"), buckets))
        # Rebalancing splits a partition too big for one task and packs small ones together.
        (
            stamped.observe(seen, F.max("write_seq").alias("seq"))
            .hint("rebalance", MONTH, BUCKET).write.partitionBy(MONTH, BUCKET).parquet(folder)
        )
        parts = []
        for month in (n for n in self._names(f"rows/{BATCH}={batch}") if n.startswith(MONTH)):
            for bucket in (n for n in self._names(f"rows/{BATCH}={batch}/{month}") if n.startswith(BUCKET)):
                parts.append((batch, month.split("=")[1], int(bucket.split("=")[1])))
        return batch, parts, seen.get["seq"] if parts else None

    def append(self, rows: DataFrame, stream: str | None = None, batch_id: int = 0) -> list[str]:
        """Add a batch and return the months it touches. A stream's batch that was added before is not added again."""
        before = self.version()
        if stream and dict(before.streams).get(stream, -1) >= batch_id:
            return []
        seq = F.col("write_seq").cast("long") if "write_seq" in rows.columns else F.lit(None).cast("long")
        chosen = [
            (named(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields]
        batch, parts, top = self._write(rows.select(*chosen, seq.alias("write_seq"), F.lit(None).cast("long").alias("write_no")),
                                           before.buckets)

        def added(now: Version) -> Version:
            known = dict(now.streams)
            if stream and known.get(stream, -1) >= batch_id:
                return now
            if stream:
                known[stream] = batch_id
            return replace(
                now, last_seq=max(now.last_seq, -1 if top is None else top), parts=(*now.parts, *parts),
                batches=(*now.batches, (batch, now.number + 1, now.last_seq)), streams=tuple(sorted(known.items())))

        if parts or stream:
            self._commit(added)
        return sorted({m for _, m, _ in parts})

    def compact(self, above: int = 1) -> Version | None:
        """Rewrite the partitions that lie in more than ``above`` batches to the rows that count, as one batch.

        Batches that others add meanwhile stay; where another compaction was faster, nothing changes and Conflict is raised.
        """
        before = self.version()
        lying = Counter((m, k) for _, m, k in before.parts)
        chosen = {part for part, n in lying.items() if n > above}
        if not chosen:
            return None
        old = tuple(p for p in before.parts if p[1:] in chosen)
        _, parts, _ = self._write(self._resolved(before, old), before.buckets)

        def replaced(now: Version) -> Version:
            if not set(old) <= set(now.parts):
                raise Conflict(f"{self.path}: another compaction came first")
            gone = set(old)
            left = tuple(p for p in now.parts if p not in gone)
            used = {b for b, _, _ in left}
            return replace(now, parts=(*left, *parts), batches=tuple(b for b in now.batches if b[0] in used))

        return self._commit(replaced)

    def vacuum(self, keep: int = 2) -> None:
        """Delete the files that none of the last ``keep`` versions needs. Readers of older versions must be done, and no
        batch may be in the making."""
        last = self.version().number
        needed = {b for n in range(max(1, last - keep + 1), last + 1) for b, _, _ in self.version(n).parts}
        for name in self._names("rows"):
            if name.split("=")[1] not in needed:
                self._files.delete(self._fs.Path(f"{self.path}/rows/{name}"), True)
        for name in self._names("versions"):
            if name.endswith(".json") and int(name[:-5]) <= last - keep:
                self._files.delete(self._fs.Path(f"{self.path}/versions/{name}"), False)

    # ---- reading

    def _resolved(self, version: Version, parts: Sequence[tuple[str, str, int]]) -> DataFrame:
        """The rows of those partitions that count, with their order."""
        if not parts:
            return self.spark.createDataFrame([], self.stored)
        layout = T.StructType([*self.stored.fields, T.StructField(BATCH, T.StringType()), T.StructField(MONTH, T.StringType()),
                               T.StructField(BUCKET, T.IntegerType())])
        folders = [f"{self.path}/rows/{BATCH}={b}/{MONTH}={m}/{BUCKET}={k}" for b, m, k in parts]
        rows = self.spark.read.schema(layout).option("basePath", f"{self.path}/rows").parquet(*folders)
        # A list of batches since the last compaction, never of rows.
        if version.batches:
            known = self.spark.createDataFrame(version.batches, f"{BATCH} string, _no long, _seq long")
            rows = rows.join(F.broadcast(known), BATCH, "left").withColumns({
                "write_no": F.coalesce("write_no", "_no"), "write_seq": F.coalesce("write_seq", "_seq")})
        columns = [named(c) for c in self.stored.names]
        return self.resolve(rows.select(*columns)).select(*columns)

    def folders(self, rows: DataFrame) -> set[tuple[str, int]]:
        """The (month, bucket) pairs that ``rows`` belong to: as many as folders, however many rows."""
        at = rows.select(month_key(self.time).alias(MONTH), bucket_of(F.col("series_id"), self.version().buckets).alias(BUCKET))
        return {(r[0], r[1]) for r in at.distinct().collect()}

    def read_folders(self, wanted: set[tuple[str, int]]) -> DataFrame:
        """Rows that count in those folders, and no other is read."""
        held = self.version()
        return self._resolved(held, [p for p in held.parts if p[1:] in wanted]).select(*[named(c) for c in self.schema.names])

    def read(self, months: Sequence[str] | None = None, series: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows that count, in the table's columns; only folders of those months and of those series' buckets are read."""
        held = self.version(version)
        parts = held.parts
        if months is not None:
            parts = [p for p in parts if p[1] in set(months)]
        if series is not None:
            wanted = self.spark.createDataFrame([(s,) for s in series], "series_id string")
            at = {r[0] for r in wanted.select(bucket_of(F.col("series_id"), held.buckets)).collect()}
            parts = [p for p in parts if p[2] in at]
        rows = self._resolved(held, parts).select(*[named(c) for c in self.schema.names])
        return rows if series is None else rows.where(F.col("series_id").isin(*series))

